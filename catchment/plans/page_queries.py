"""Menu and content profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions.text import url_host, url_path, url_query_keys
from catchment.operators import menu, profiling
from catchment.plans.adapters import driver_table, menu_pages, responses, spread
from catchment.plans.registry import query

# ---- menus. The SQL twins spell out the documents' content per part.


def _state(spark, sf_dir):
    pages, documents = menu_pages(spark, sf_dir)
    return menu.attach_documents(menu.page_state(pages), documents)


_HEAD = "CAST(p_partkey AS STRING) AS restaurant_id, p_name AS restaurant_name"


@query(
    "page_state",
    """SELECT p_partkey AS page_id, 'https://menus.example' AS cdn_base, CASE WHEN p_size = 50 OR p_partkey = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS restaurant_id,
    CASE WHEN p_size = 50 THEN '' ELSE p_name END AS restaurant_name, CASE WHEN p_size <> 50 AND p_size % 3 <> 0 THEN 'items/' || p_partkey ELSE '' END AS items_url,
    CASE WHEN p_size <> 50 THEN 'details/' || p_partkey ELSE '' END AS item_details_url, '' AS truncated_url,
    CASE WHEN p_size = 50 THEN 'no menu state in page' END AS error FROM part""",
)
def page_state(spark, sf_dir):
    pages, _ = menu_pages(spark, sf_dir)
    return menu.page_state(pages).drop("menus", "inline_items")


_ID = "CASE WHEN p_partkey = 0 THEN '' ELSE CAST(p_partkey AS STRING) END AS restaurant_id"
_POSITIONS = f"""m AS (SELECT *, unnest(range(1, 2 + p_size % 3)) AS m FROM part WHERE p_size <> 50), c AS (SELECT *, unnest([1, 2]) AS c FROM m),
    n AS (SELECT *, unnest(range(m, m + c + 1)) AS n FROM c),
    k AS (SELECT *, CASE WHEN p_size % 3 <> 0 THEN n BETWEEN 2 AND 4 ELSE n BETWEEN 1 AND 3 END AS known FROM n)"""


@query(
    "menu_items",
    f"""WITH {_POSITIONS} SELECT p_partkey AS page_id, {_ID}, p_name AS restaurant_name, m - 1 AS menu_index, 'm' || m AS menu_id, 'Menu ' || m AS menu_name,
    CAST(c - 1 AS BIGINT) AS category_index, 'c' || c AS category_id, 'Category ' || c AS category_name, n - m AS position_in_category, 'i' || n AS item_id,
    'Item ' || n AS item_name, CASE WHEN n % 2 = 0 THEN 'Tasty' ELSE '' END AS item_description, 'food' AS item_type, 'L' || n || '|x' AS labels,
    p_retailprice + n AS min_price, p_retailprice + n + 2 AS max_price, 'v' || n || '|w' || n AS variation_ids, CAST(2 AS BIGINT) AS variation_count,
    'g1|g2' AS modifier_group_ids, 'd1' AS deal_group_ids, n || ' kcal' AS energy_display, 'kcal' AS energy_units, 'img/' || n AS image_0,
    '[{{"z":' || n || ',"a":"age"}}]' AS restrictions_json FROM k WHERE known""",
)
def menu_items(spark, sf_dir):
    return menu.menu_items(_state(spark, sf_dir))


@query(
    "menu_modifiers",
    f"""WITH g AS (SELECT part.*, v.* FROM part, (VALUES ('g1', 'Group 1', '0', 0, '1', 1), ('g1', 'Group 1', '0', 1, '2', 2), ('g1', 'Group 1', '0', 2, '9', 9), ('g2', 'Group 2', '1', 0, '3', 3))
        v(gid, gname, gmin, pos, sid, s))
    SELECT p_partkey AS page_id, CASE WHEN p_size = 50 THEN '' ELSE {_ID.removesuffix(' AS restaurant_id')} END AS restaurant_id, CASE WHEN p_size = 50 THEN '' ELSE p_name END AS restaurant_name,
    gid AS modifier_group_id, gname AS modifier_group_name, gmin AS group_min_choices, CASE WHEN gid = 'g1' THEN CAST(p_size AS STRING) ELSE '1' END AS group_max_choices,
    CAST(pos AS BIGINT) AS position_in_group, sid AS modifier_set_id, CASE WHEN s < 9 THEN 'mod' || s ELSE '' END AS modifier_id,
    CASE WHEN s < 9 THEN 'Modifier ' || s ELSE '' END AS modifier_name, CASE WHEN s < 9 THEN CAST(s + 1 AS STRING) ELSE '' END AS addition_price, '' AS remove_price,
    '' AS default_choices, '' AS modifier_min_choices, '' AS modifier_max_choices, CASE WHEN s < 9 THEN '{{"kcal":' || s || '}}' ELSE '' END AS nutrition_json FROM g""",
)
def menu_modifiers(spark, sf_dir):
    return menu.menu_modifiers(_state(spark, sf_dir))


@query(
    "menu_deals",
    f"""WITH g AS (SELECT part.*, v.* FROM part, (VALUES (0, 'v2', '1'), (1, 'nope', '0')) v(pos, vid, lo)),
    k AS (SELECT *, pos = 0 AND NOT (p_size = 50 AND p_size % 3 = 0) AS known FROM g)
    SELECT p_partkey AS page_id, CASE WHEN p_size = 50 THEN '' ELSE {_ID.removesuffix(' AS restaurant_id')} END AS restaurant_id, CASE WHEN p_size = 50 THEN '' ELSE p_name END AS restaurant_name,
    'd1' AS deal_group_id, 'Deal' AS deal_group_name, CAST(p_size AS STRING) AS number_of_choices, CAST(pos AS BIGINT) AS position_in_group, vid AS deal_item_variation_id,
    CASE WHEN known THEN 'i2' ELSE '' END AS item_id, CASE WHEN known THEN 'Item 2' ELSE '' END AS item_name, CASE WHEN known THEN 'Var 2' ELSE '' END AS variation_name,
    CASE WHEN known THEN p_retailprice + 2 END AS base_price, CASE WHEN known THEN 'g2|g1' ELSE '' END AS modifier_group_ids, lo AS min_choices, '' AS max_choices,
    CASE WHEN pos = 0 THEN p_retailprice ELSE 0.5::DOUBLE END AS addition_price, '' AS servings_display FROM k""",
)
def menu_deals(spark, sf_dir):
    rows = menu.menu_deals(_state(spark, sf_dir))
    return rows.withColumns({name: F.col(name).try_cast("double") for name in ("base_price", "addition_price")})


@query(
    "menu_summary",
    f"""WITH {_POSITIONS}, lost AS (SELECT p_partkey, count(*) FILTER (NOT known) AS lost FROM k GROUP BY ALL)
    SELECT p.p_partkey AS page_id, CASE WHEN p_size = 50 OR p.p_partkey = 0 THEN '' ELSE CAST(p.p_partkey AS STRING) END AS restaurant_id, CASE WHEN p_size = 50 THEN '' ELSE p_name END AS restaurant_name,
    'https://menus.example' AS cdn_base, CASE WHEN p_size <> 50 AND p_size % 3 <> 0 THEN 'items/' || p.p_partkey ELSE '' END AS items_url,
    CASE WHEN p_size <> 50 THEN 'details/' || p.p_partkey ELSE '' END AS item_details_url, '' AS truncated_url,
    CAST(CASE WHEN p_size = 50 THEN 0 ELSE 1 + p_size % 3 END AS BIGINT) AS menus, CAST(CASE WHEN p_size = 50 THEN 0 ELSE 3 END AS BIGINT) AS items,
    coalesce(lost, 0) AS missing_item_details, CAST(2 AS BIGINT) AS modifier_groups, CAST(4 AS BIGINT) AS modifier_options, CAST(1 AS BIGINT) AS deal_groups, CAST(2 AS BIGINT) AS deal_options
    FROM part p LEFT JOIN lost ON lost.p_partkey = p.p_partkey""",
)
def menu_summary(spark, sf_dir):
    return menu.menu_summary(_state(spark, sf_dir))


# ---- saved pages

_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_SCRIPT = r"(?is)<script\b([^>]*)>(.*?)</script\s*>"


def clean_sql(expression: str) -> str:
    return f"trim(regexp_replace({expression}, '{_SPACE}', ' ', 'g'))"


@query(
    "script_inventory",
    f"""WITH s AS (SELECT page_id, unnest(regexp_extract_all(html, '{_SCRIPT}', 2)) AS body, generate_subscripts(regexp_extract_all(html, '{_SCRIPT}', 2), 1) - 1 AS index FROM pages)
    SELECT page_id, CAST(index AS BIGINT) AS index, CAST(NULL AS STRING) AS id, CAST(NULL AS STRING) AS type, CAST(NULL AS STRING) AS src, length(body) AS text_length, contains(lower({clean_sql('body')}), 'restaurant') AS has_restaurant_sample,
    CAST(NULL AS STRING) AS json_keys, {clean_sql('body')} AS sample FROM s WHERE {clean_sql('body')} <> ''""",
)
def script_inventory(spark, sf_dir):
    return profiling.script_inventory(spread(driver_table(spark, sf_dir, "pages")))


_WORDS = ("track(", "CHARSET", "</article>", 'href="/THE', "vertical")


@query(
    "keyword_snippets",
    f"""WITH p AS (SELECT page_id, html, pattern, string_split_regex(html, '(?i)\\Q' || pattern || '\\E') AS parts FROM pages, (VALUES {", ".join(f"('{word}')" for word in _WORDS)}) v(pattern)),
    h AS (SELECT *, unnest(range(1, len(parts))) AS i FROM p),
    q AS (SELECT page_id, html, pattern, CAST(list_sum([length(x) FOR x IN parts[1:i]]) + (i - 1) * length(pattern) AS BIGINT) AS position FROM h),
    b AS (SELECT *, greatest(position - 350, 0) AS first FROM q)
    SELECT page_id, pattern, position, {clean_sql('substring(html, first + 1, position + length(pattern) + 650 - first)')} AS snippet FROM b""",
)
def keyword_snippets(spark, sf_dir):
    return profiling.keyword_snippets(spread(driver_table(spark, sf_dir, "pages")), "html", _WORDS)


@query(
    "interesting_pages",
    "SELECT page_id, url FROM pages WHERE contains(lower(url || ' ' || html), '/de/') OR contains(lower(url || ' ' || html), 'nicht')",
)
def interesting_pages(spark, sf_dir):
    return profiling.interesting(driver_table(spark, sf_dir, "pages"), ("/DE/", "nicht"), ("url", "html")).select("page_id", "url")


_HOST = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)"
_PATH = r"regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)"
_KEYS = r"array_to_string([string_split(x, '=')[1] FOR x IN string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&') IF regexp_matches(x, '^[^=]*=.')], ',')"


@query("url_parts", f"SELECT page_id, {_HOST} AS host, {_PATH} AS path, {_KEYS} AS query_keys, string_split(url, '/')[-1] AS last_part FROM pages")
def url_parts(spark, sf_dir):
    url = F.col("url")
    return driver_table(spark, sf_dir, "pages").select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), url_query_keys(url).alias("query_keys"), profiling.last_segment(url).alias("last_part")
    )


# ---- saved responses

RESPONSES_SQL = """r AS (SELECT 'e' || event_id AS response_id, CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method, 'application/json' AS content_type,
    'https://api.example.com/' || event_type || '/' || (user_id % 40) || '?page=' || (event_id % 9) || '&blank=&q=a%20b' AS url,
    CASE WHEN event_type = 'purchase' THEN ' body  ' || (event_id % 5) END AS post_data,
    '{"type":"' || event_type || '","list":[' || array_to_string(['{"name":"N' || n || '","rating":' || value || '}' FOR n IN range(1, 2 + user_id % 8)], ',') || '],"more":{"k":[1,2,' || user_id || ']}}' AS body,
    ts AS arrived_at, 1 + user_id % 8 AS n, event_type, value FROM events
    UNION ALL SELECT 'p' || page_id, 'GET', 'text/html', url, NULL, html, make_timestamp(page_id * 1000000), NULL, NULL, NULL FROM pages),
    f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY method, url, coalesce(post_data, '') ORDER BY arrived_at, response_id) = 1)"""
_EVENTS = "FROM r WHERE n IS NOT NULL"


@query("response_dedupe", f"WITH {RESPONSES_SQL} SELECT response_id, method, url, post_data FROM f")
def response_dedupe(spark, sf_dir):
    return profiling.first_responses(responses(spark, sf_dir)).select("response_id", "method", "url", "post_data")


@query(
    "response_log",
    f"""WITH {RESPONSES_SQL} SELECT response_id, method, CAST(200 AS BIGINT) AS status, content_type, url, {_HOST} AS url_host, {_PATH} AS url_path, {_KEYS} AS query_keys, {clean_sql('post_data')} AS post_data,
    strlen(body) AS body_bytes, CASE WHEN n IS NOT NULL THEN 'dict' END AS top_level_type, CASE WHEN n IS NOT NULL THEN 'type,list,more' END AS top_level_keys,
    CASE WHEN n IS NOT NULL THEN '$.list:' || n || '; $.more.k:3' END AS list_lengths, coalesce(n, 0) AS restaurant_like_count, CAST(NULL AS STRING) AS error
    FROM f WHERE regexp_matches(lower(url || ' ' || content_type || ' ' || body), 'restaurant|grocer|delivery|eta|rating|postcode|vertical|search|discovery|places')""",
)
def response_log(spark, sf_dir):
    return profiling.response_log(responses(spark, sf_dir)).drop("body_text")


def _bodies(spark, sf_dir):
    return responses(spark, sf_dir).filter(F.col("content_type") == "application/json").select("response_id", "body")


@query(
    "json_profile",
    f"""WITH {RESPONSES_SQL} SELECT response_id, 'dict' AS top_level_type, 'type,list,more' AS top_level_keys, '$.list:' || n || '; $.more.k:3' AS list_lengths,
    n AS restaurant_like_count, CAST(NULL AS STRING) AS error {_EVENTS}""",
)
def json_profile(spark, sf_dir):
    return profiling.json_profile(_bodies(spark, sf_dir), "body", ("response_id",))


_FIRST = """'{"name": "N1", "rating": ' || value || '}'"""


@query(
    "json_lists",
    f"""WITH {RESPONSES_SQL} SELECT response_id, '$.list' AS path, n AS length, n AS strong, 'name,rating' AS first_keys, {_FIRST} AS first_sample, CAST(NULL AS STRING) AS error {_EVENTS} AND n >= 5""",
)
def json_lists(spark, sf_dir):
    return profiling.json_lists(_bodies(spark, sf_dir), "body", ("response_id",))


@query(
    "json_top_lists",
    f"WITH {RESPONSES_SQL} SELECT response_id, '$.list' AS path, n AS length, n AS strong {_EVENTS} AND n >= 5 ORDER BY n DESC, response_id LIMIT 20",
)
def json_top_lists(spark, sf_dir):
    """A top-k report: its limit is the feature."""
    found = profiling.json_lists(_bodies(spark, sf_dir), "body", ("response_id",))
    return profiling.top_lists(found).select("response_id", "path", "length", "strong")


@query(
    "json_keyword_paths",
    f"""WITH {RESPONSES_SQL} SELECT response_id, '$.list' AS path, 'list' AS kind, n AS size,
        '[' || array_to_string(['{{"name": "N' || i || '", "rating": ' || value || '}}' FOR i IN range(1, 1 + n)], ', ') || ']' AS sample, CAST(NULL AS STRING) AS error {_EVENTS}
    UNION ALL SELECT response_id, '$.list', 'list', n, {_FIRST}, NULL {_EVENTS} AND n >= 5
    UNION ALL SELECT response_id, '$.type', 'str', 4, '"view"', NULL {_EVENTS} AND event_type = 'view'""",
)
def json_keyword_paths(spark, sf_dir):
    return profiling.json_keyword_paths(_bodies(spark, sf_dir), "body", ("list", "view"), ("response_id",))


@query(
    "json_named_lists",
    f"WITH {RESPONSES_SQL} SELECT response_id, '$.list' AS path, n AS length, n AS hits, CAST(NULL AS STRING) AS error {_EVENTS}",
)
def json_named_lists(spark, sf_dir):
    return profiling.json_named_lists(_bodies(spark, sf_dir), "body", ("response_id",))
