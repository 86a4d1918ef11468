"""Listing, grocery and release queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment import workflows
from catchment.functions.loose import number
from catchment.functions.text import format_money, parse_place_count, parse_rating, parse_verticals, partition_label
from catchment.functions.text import clean_postcode, clean_text
from catchment.operators import grocery, listing
from catchment.operators.ordered import global_ordinal
from catchment.plans.adapters import LINE_KEY, TAGS, TASK_ROWS, WINDOW_OF_LINE, cte, domain, driver_table, envelopes, odd_envelopes
from catchment.plans.registry import SQL, query, scratch_dir, sql_time, time_text
from catchment.sources import readers, writers
from catchment.sources.schemas import COVERAGE, PROFILE, SNAPSHOTS, conform_to_schema

TAG_LIST = ", ".join(f"'{tag}'" for tag in TAGS)

# Local hours of the collection tags, keyed by tag.
TAG_HOURS = {
    "weekday_afternoon": ("14:00", "18:00"),
    "weekday_evening": ("18:30", "22:30"),
    "weekday_early_hours": ("00:00", "04:00"),
    "saturday_peak": ("14:00", "22:00"),
}
HOURS_SQL = ", ".join(f"('{tag}', '{start}', '{end}')" for tag, (start, end) in TAG_HOURS.items())

# ---- brand rules restated for the SQL twins. The names and patterns of brands, grocers and tags.
_N = "lower(coalesce(restaurant_name, ''))"
_END = r"\b"
BRAND_SQL = f"""CASE
    WHEN regexp_matches({_N}, '^\\s*co[- ]?op{_END}') THEN 'coop'
    WHEN regexp_matches({_N}, '^\\s*morrisons{_END}') THEN 'morrisons'
    WHEN regexp_matches({_N}, '^\\s*sainsbury[^a-z0-9]?s{_END}') THEN 'sainsburys'
    WHEN regexp_matches({_N}, '^\\s*asda{_END}') AND NOT regexp_matches({_N}, '^\\s*asda\\s+cafe{_END}') THEN 'asda'
    WHEN regexp_matches({_N}, '^\\s*iceland{_END}') THEN 'iceland'
    WHEN regexp_matches({_N}, '^\\s*waitrose{_END}') THEN 'waitrose' END"""
GENERAL_SQL = f"""(regexp_matches({_N}, '^\\s*(co[- ]?op|morrisons|sainsbury[^a-z0-9]?s|asda|iceland|waitrose|londis|one stop|spar|premier|nisa|budgens|costcutter|best[- ]?one|gopuff|family shopper|lifestyle express|go local|shop ?n ?drive){_END}')
    AND NOT regexp_matches({_N}, '^\\s*asda\\s+cafe{_END}'))"""
TAGGED_SQL = """(regexp_matches(lower(coalesce(cuisine_names, '')), '(^|,\\s*)groceries?(\\s*,|$)')
    AND NOT regexp_matches(lower(coalesce(cuisine_names, '')), '(^|,\\s*)(convenience|supermarket)(\\s*,|$)'))"""
CLASSIFIED = f"c AS (SELECT restaurant_id, {BRAND_SQL} AS big_brand, {GENERAL_SQL} AS is_general_grocery, {TAGGED_SQL} AS has_groceries_tag FROM d_profile)"
STATIC_SQL = """st AS (SELECT DISTINCT 'static_map' AS source_dataset, 'full_coverage' AS source_tag, m.postcode, c.*
    FROM d_coverage m JOIN c ON m.restaurant_id = c.restaurant_id WHERE m.is_delivery)"""
TEMPORAL_SQL = f"""te AS (SELECT DISTINCT 'temporal_snapshot' AS source_dataset, s.planned_window AS source_tag, s.postcode, c.*
    FROM d_snapshots s JOIN c ON s.ListingId = c.restaurant_id WHERE s.planned_window IN ({TAG_LIST}))"""
_BRANDS = ("coop", "morrisons", "sainsburys", "asda", "iceland", "waitrose")
AGGREGATE_SQL = f"""agg AS (SELECT source_dataset, source_tag, postcode,
    count(DISTINCT CASE WHEN big_brand IS NOT NULL THEN restaurant_id END) AS big_brand_grocery_count,
    count(DISTINCT CASE WHEN is_general_grocery THEN restaurant_id END) AS general_grocery_count,
    count(DISTINCT CASE WHEN has_groceries_tag THEN restaurant_id END) AS groceries_cuisine_tag_count,
    {", ".join(f"CASE WHEN count(DISTINCT CASE WHEN big_brand = '{b}' THEN restaurant_id END) > 0 THEN 'yes' ELSE 'no' END AS has_{b}" for b in _BRANDS)}
    FROM (SELECT * FROM st UNION ALL SELECT * FROM te) GROUP BY ALL)"""
GROCERY_CTE = f"{cte('profile', 'coverage', 'snapshots')}, {CLASSIFIED}, {STATIC_SQL}, {TEMPORAL_SQL}, {AGGREGATE_SQL}"
GEO_CTE = f"""geo AS (SELECT DISTINCT lower(regexp_replace(postcode, '\\s+', '', 'g')) AS postcode, geo_code, geo_type FROM (
    SELECT postcode, geo_code, 'lsoa' AS geo_type FROM d_geography_ew UNION ALL SELECT postcode, geo_code, 'dz' FROM d_geography_sc)
    WHERE geo_code IS NOT NULL AND postcode IS NOT NULL)"""


def _grocery_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(domain(spark, sf_dir, name) for name in ("coverage", "snapshots", "profile"))


def _geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.read_geography(
        domain(spark, sf_dir, "geography_ew"), domain(spark, sf_dir, "geography_sc"), ("geo_code", "postcode"), ("geo_code", "postcode")
    )


def observed_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval rows per observed day and tag: a JSON settings document per day of the orders, read as settings are."""
    days = driver_table(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).distinct()
    parts = [
        F.concat(F.lit(f'"{tag}":[["'), F.col("day"), F.lit(f'T{start}:00","'), F.col("day"), F.lit(f'T{end}:00"]]'))
        for tag, (start, end) in TAG_HOURS.items()
    ]
    payload = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("payload")
    return readers.window_config_rows(days.select(payload), TAGS)


OBSERVED_SQL = f"""iv AS (SELECT tag, CAST(0 AS INTEGER) AS ordinal, strftime(day, '%Y-%m-%d') || 'T' || opens || ':00' AS local_start,
    strftime(day, '%Y-%m-%d') || 'T' || closes || ':00' AS local_end
    FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), (VALUES {HOURS_SQL}) h(tag, opens, closes))"""


@query("grocery_aggregate", f"{GROCERY_CTE} SELECT * FROM agg")
def grocery_aggregate(spark, sf_dir):
    coverage, snapshots, profile = _grocery_inputs(spark, sf_dir)
    return grocery.grocery_availability(coverage, snapshots, profile, TAGS)


@query(
    "grocery_grid",
    f"""{GROCERY_CTE.replace("WITH", cte("geography_ew", "geography_sc") + ",", 1)}, {GEO_CTE},
    keys AS (SELECT 'static_map' AS source_dataset, 'full_coverage' AS source_tag, NULL AS window_start_local, NULL AS window_end_local
        UNION ALL SELECT 'temporal_snapshot', tag, opens, closes FROM (VALUES {HOURS_SQL}) h(tag, opens, closes))
    SELECT g.postcode, g.geo_code, g.geo_type, k.*, coalesce(big_brand_grocery_count, 0) AS big_brand_grocery_count,
    coalesce(general_grocery_count, 0) AS general_grocery_count, coalesce(groceries_cuisine_tag_count, 0) AS groceries_cuisine_tag_count,
    {", ".join(f"coalesce(has_{b}, 'no') AS has_{b}" for b in _BRANDS)}
    FROM geo g CROSS JOIN keys k LEFT JOIN agg a ON a.source_dataset = k.source_dataset AND a.source_tag = k.source_tag AND a.postcode = g.postcode""",
)
def grocery_grid(spark, sf_dir):
    coverage, snapshots, profile = _grocery_inputs(spark, sf_dir)
    aggregates = grocery.grocery_availability(coverage, snapshots, profile, TAGS)
    return grocery.grocery_grid(_geography(spark, sf_dir), grocery.source_keys(observed_intervals(spark, sf_dir)), aggregates)


@query("grocery_csv", f"SELECT *, row_number() OVER (ORDER BY source_dataset, source_tag, postcode, geo_code) - 1 AS ordinal FROM ({SQL['grocery_grid']})")
def grocery_csv(spark, sf_dir):
    """The exported report, read back from its CSV files in the order in which it stands there."""
    folder = scratch_dir(spark, "grocery")
    coverage, snapshots, profile = _grocery_inputs(spark, sf_dir)
    grid = workflows.export_grocery(coverage, snapshots, profile, _geography(spark, sf_dir), observed_intervals(spark, sf_dir), folder)
    back = spark.read.csv(folder, header=True)
    named = readers.with_input_order(back).withColumnRenamed(back.columns[0], grid.columns[0])
    placed = global_ordinal(named, F.struct("source_file", "source_offset"), list(readers.INPUT_ORDER))
    return placed.select(*[F.col(name).cast(kind).alias(name) for name, kind in grid.dtypes], "ordinal")


@query(
    "static_deliverable",
    f"{cte('profile', 'coverage')}, {CLASSIFIED}, {STATIC_SQL} SELECT * FROM st",
)
def static_deliverable(spark, sf_dir):
    return grocery.static_restaurants(domain(spark, sf_dir, "coverage"), domain(spark, sf_dir, "profile"))


@query(
    "temporal_restaurants",
    f"{cte('profile', 'snapshots')}, {CLASSIFIED}, {TEMPORAL_SQL} SELECT * FROM te",
)
def temporal_restaurants(spark, sf_dir):
    return grocery.temporal_restaurants(domain(spark, sf_dir, "snapshots"), domain(spark, sf_dir, "profile"), TAGS)


@query("brand_classify", f"{cte('profile')}, {CLASSIFIED} SELECT * FROM c")
def brand_classify(spark, sf_dir):
    return grocery.classify_profiles(domain(spark, sf_dir, "profile"))


@query("geography_map", f"{cte('geography_ew', 'geography_sc')}, {GEO_CTE} SELECT * FROM geo")
def geography_map(spark, sf_dir):
    return _geography(spark, sf_dir)


@query("rows_by_tag", f"{GROCERY_CTE} SELECT source_dataset, source_tag, count(*) AS rows FROM agg GROUP BY ALL")
def rows_by_tag(spark, sf_dir):
    return grocery.rows_by_tag(grocery_aggregate(spark, sf_dir))


@query("label_check", f"{cte('coverage')} SELECT DISTINCT snapshot_label FROM d_coverage")
def label_check(spark, sf_dir):
    return grocery.static_label(domain(spark, sf_dir, "coverage"))


@query("window_intervals", f"WITH {OBSERVED_SQL} SELECT * FROM iv")
def window_intervals(spark, sf_dir):
    return observed_intervals(spark, sf_dir)


@query(
    "window_consistency",
    f"""WITH {OBSERVED_SQL} SELECT 'temporal_snapshot' AS source_dataset, tag AS source_tag, min(local_start[12:16]) AS window_start_local,
    max(local_end[12:16]) AS window_end_local FROM iv GROUP BY tag""",
)
def window_consistency(spark, sf_dir):
    return grocery.window_bounds(observed_intervals(spark, sf_dir))


@query(
    "postcode_input",
    f"{cte('postcodes')} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, lower(regexp_replace(raw, '\\s+', '', 'g')) AS postcode FROM d_postcodes",
)
def postcode_input(spark, sf_dir):
    """Written as CSV in customer order, then read back in file order."""
    return readers.read_postcodes(spark, _written_postcodes(spark, sf_dir))


def _written_postcodes(spark: SparkSession, sf_dir: str) -> str:
    folder = scratch_dir(spark, "postcodes")
    raw = domain(spark, sf_dir, "postcodes").select("ordinal", F.col("raw").alias("postcode"))
    raw.repartitionByRange("ordinal").sortWithinPartitions("ordinal").select("postcode").write.mode("overwrite").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder, header=True)
    return folder


@query(
    "first_postcodes",
    f"""{cte('postcodes')} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS ordinal, lower(regexp_replace(raw, '\\s+', '', 'g')) AS postcode
    FROM d_postcodes ORDER BY ordinal LIMIT 100""",
)
def first_postcodes(spark, sf_dir):
    """The first postcodes of a list in file order: its limit is the feature."""
    return readers.read_postcodes(spark, _written_postcodes(spark, sf_dir), limit=100)


@query(
    "postcode_union",
    f"""{cte('geography_ew', 'geography_sc')} SELECT DISTINCT lower(regexp_replace(postcode, '\\s+', '', 'g')) AS postcode
    FROM (SELECT postcode FROM d_geography_ew UNION ALL SELECT postcode FROM d_geography_sc)""",
)
def postcode_union(spark, sf_dir):
    return readers.combine_postcodes(domain(spark, sf_dir, "geography_ew"), domain(spark, sf_dir, "geography_sc"))


# ---- raw listings. The SQL twins work from the order lines that the documents were made of.

_K = LINE_KEY
LISTING_SQL = f"""a AS (SELECT l.*, 's-' || {_K} AS snapshot_id, 'j-' || {_K} AS job_id, 'listing' AS provider, 'pc' || CAST(l_suppkey AS STRING) AS postcode,
    {WINDOW_OF_LINE} AS planned_window, strftime(l_shipdate, '%Y-01-01T07:00:00') AS scheduled_at, strftime(l_shipdate, '%Y-01-01T08:00:00') AS captured_at,
    CAST(l_partkey AS STRING) AS pid, CAST(l_suppkey AS STRING) AS sid, CAST(l_linenumber AS STRING) AS ln FROM lineitem l)"""
_STAMP = "snapshot_id, job_id, provider, postcode, planned_window, scheduled_at, captured_at"
_FIRST_ROW = f"""SELECT {_STAMP}, 'Outlet ' || pid AS Name, l_quantity / 10 AS Rating, l_suppkey AS ReviewCount,
    CASE WHEN l_quantity < 25 THEN 'Pizza, Groceries, Alcohol' ELSE 'Pizza, Alcohol' END AS Categories,
    CASE WHEN l_linenumber <> 2 THEN (l_linenumber * 5) || '-' || (l_linenumber * 5 + 10) || ' mins' ELSE '25 mins' END AS DeliveryTime,
    CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 OR l_extendedprice <= 0 THEN 'Free' ELSE '£' || printf('%.2f', l_extendedprice) END AS DeliveryFee,
    CASE WHEN l_linenumber = 5 THEN 'ask us' ELSE '£' || ln || '.00' END AS MinimumOrder,
    CASE WHEN l_tax > 0.04 THEN '10% off; Free  drink' ELSE 'Free  drink' END AS Offer,
    CASE WHEN l_tax > 0.02 THEN 'New, Top ' || ln END AS Tags,
    CASE WHEN l_linenumber <> 1 AND l_partkey <> 0 THEN 'https://listings.example/restaurants-outlet-' || pid || '/menu' END AS Url,
    CASE WHEN l_quantity < 25 THEN 'groceries' ELSE 'restaurants' END AS Vertical, pid AS ListingId,
    CASE WHEN l_quantity < 30 THEN 'alcohol, groceries, pizza' ELSE 'alcohol, pizza' END AS CuisineIds FROM a"""
_SECOND_ROW = f"""SELECT {_STAMP}, 'Supplier ' || sid, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN l_quantity < 10 AND l_partkey = 0 THEN 'groceries' ELSE 'restaurants' END,
    CASE WHEN l_quantity < 10 THEN '0' END, NULL FROM a"""
_SECOND_KEY = "CASE WHEN l_quantity < 30 THEN 's' || sid WHEN l_linenumber % 2 = 1 THEN 'supplier-' || sid END"
KEYED_SQL = f"k AS (SELECT a.*, pid AS restaurant_id, 0 AS position FROM a UNION ALL SELECT a.*, {_SECOND_KEY}, 1 FROM a)"


def _raw(spark: SparkSession, sf_dir: str, reads: tuple[str, ...]) -> DataFrame:
    return readers.parse_envelopes(envelopes(spark, sf_dir), keep=("raw_uri",), reads=reads)


def _grouped_raw(spark: SparkSession, sf_dir: str, reads: tuple[str, ...]) -> DataFrame:
    """The raw documents for a job that sorts a task's outlets before it groups them: so many that they stay in memory."""
    return readers.parse_envelopes(envelopes(spark, sf_dir, 2 * TASK_ROWS), keep=("raw_uri",), reads=reads)


@query("listing_normalise", f"WITH {LISTING_SQL} {_FIRST_ROW} UNION ALL {_SECOND_ROW}")
def listing_normalise(spark, sf_dir):
    return listing.listing_rows(_raw(spark, sf_dir, listing.LISTING_READS))


@query(
    "open_now",
    f"WITH {LISTING_SQL} {_FIRST_ROW} WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND l_quantity <= 40 UNION ALL {_SECOND_ROW}",
)
def open_now(spark, sf_dir):
    return listing.open_now(_raw(spark, sf_dir, listing.OPEN_READS))


@query(
    "coverage_build",
    f"""WITH {LISTING_SQL}, {KEYED_SQL} SELECT 'full_2026' AS snapshot_label, postcode, restaurant_id,
    CASE WHEN position = 1 THEN TRUE WHEN l_returnflag = 'A' THEN TRUE WHEN l_returnflag = 'R' THEN FALSE END AS is_delivery,
    CASE WHEN position = 1 OR l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 0 ELSE l_extendedprice END AS delivery_fee,
    CASE WHEN position = 0 AND l_linenumber <> 5 THEN CAST(l_linenumber AS DOUBLE) END AS minimum_delivery_value,
    CASE WHEN position = 0 AND l_linenumber <> 2 THEN CAST(l_linenumber * 5 AS BIGINT) END AS delivery_eta_lower_minutes,
    CASE WHEN position = 0 THEN CAST(l_linenumber * 5 + 10 AS BIGINT) END AS delivery_eta_upper_minutes,
    CASE WHEN position = 0 THEN l_suppkey * 10 END AS drive_distance_meters
    FROM k WHERE restaurant_id IS NOT NULL""".replace("k AS (SELECT a.*, pid AS restaurant_id", "k AS (SELECT a.*, CASE WHEN l_partkey = 0 THEN CASE WHEN l_linenumber <> 1 THEN 'outlet-0' END ELSE pid END AS restaurant_id"),
)
def coverage_build(spark, sf_dir):
    return conform_to_schema(listing.coverage_rows(_raw(spark, sf_dir, listing.COVERAGE_READS), "full_2026"), COVERAGE)


_KEYED = KEYED_SQL.replace("pid AS restaurant_id", "CASE WHEN l_partkey = 0 THEN CASE WHEN l_linenumber <> 1 THEN 'outlet-0' END ELSE pid END AS restaurant_id")
# The last seen profile per restaurant; equal arrivals hold equal documents apart from the fields compared last.
PROFILE_SQL = f"""p AS (SELECT restaurant_id, unnest(max_by({{
    'restaurant_name': CASE WHEN position = 0 THEN 'Outlet ' || pid ELSE 'Supplier ' || sid END,
    'restaurant_unique_name': CASE WHEN position = 0 AND l_linenumber <> 1 THEN 'outlet-' || pid WHEN position = 1 AND l_linenumber % 2 = 1 THEN 'supplier-' || sid END,
    'address_first_line': CASE WHEN position = 0 THEN ln || ' High St' END,
    'city': CASE WHEN position = 0 THEN 'Leeds' END,
    'postal_code': CASE WHEN position = 0 THEN 'LS' || sid END,
    'latitude': CASE WHEN position = 0 AND l_linenumber <> 6 THEN 53.25::DOUBLE + l_linenumber END,
    'longitude': CASE WHEN position = 0 AND l_linenumber <> 6 THEN -1.5::DOUBLE END,
    'cuisine_names': CASE WHEN position = 0 THEN CASE WHEN l_quantity < 25 THEN 'Pizza, Groceries, Alcohol' ELSE 'Pizza, Alcohol' END END,
    'cuisine_unique_names': CASE WHEN position = 0 THEN CASE WHEN l_quantity < 30 THEN 'pizza, groceries, alcohol' ELSE 'pizza, pizza, alcohol' END END,
    'rating_count': CASE WHEN position = 0 THEN l_suppkey END,
    'rating_star': CASE WHEN position = 0 THEN l_quantity / 10 END,
    'logo_url': CASE WHEN position = 0 AND l_linenumber > 2 THEN 'logo-' || pid END}},
    {{'c': captured_at, 'u': 'raw/' || {_K}, 'q': l_quantity, 'e': l_extendedprice, 'p': position}}))
    FROM k WHERE restaurant_id IS NOT NULL GROUP BY restaurant_id)"""


def _ordered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw documents with a total arrival order: capture, address, then what tells equal addresses apart."""
    raw = _grouped_raw(spark, sf_dir, (*listing.PROFILE_READS, "response.restaurants.deliveryCost"))
    first = F.get("response.restaurants", 0)
    return raw.withColumns({"quantity": number(first["rating"]["starRating"]), "price": number(first["deliveryCost"])})


@query(
    "profile_build",
    f"""WITH {LISTING_SQL}, {_KEYED}, {PROFILE_SQL.replace("'e': l_extendedprice", "'e': CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 0 ELSE l_extendedprice END")}
    SELECT *, 'https://listings.example/restaurants-' || restaurant_unique_name || '/menu' AS restaurant_url FROM p""",
)
def profile_build(spark, sf_dir):
    rows = listing.profile_rows(_ordered_raw(spark, sf_dir), ("captured_at", "raw_uri", "quantity", "price"))
    return conform_to_schema(rows, PROFILE)


@query(
    "profile_new_rows",
    f"""WITH {LISTING_SQL}, {_KEYED}, known AS (SELECT CAST(p_partkey AS STRING) AS id FROM part WHERE p_size > 25)
    SELECT DISTINCT restaurant_id FROM k WHERE restaurant_id IS NOT NULL AND restaurant_id NOT IN (SELECT id FROM known)""",
)
def profile_new_rows(spark, sf_dir):
    known = driver_table(spark, sf_dir, "part").filter("p_size > 25").selectExpr("CAST(p_partkey AS STRING) AS restaurant_id")
    return listing.new_profiles(listing.profile_rows(_raw(spark, sf_dir, listing.PROFILE_READS)), known).select("restaurant_id")


@query(
    "backfill_stats",
    f"""WITH {LISTING_SQL}, {_KEYED}, known AS (SELECT CAST(p_partkey AS STRING) AS id FROM part WHERE p_size > 25),
    named AS (SELECT * FROM k WHERE restaurant_id IS NOT NULL)
    SELECT (SELECT count(*) FROM named) AS map_rows, (SELECT count(*) FROM named) AS profiles_seen,
    (SELECT count(DISTINCT restaurant_id) FROM named) AS profiles_unique, (SELECT count(*) FROM k WHERE restaurant_id IS NULL) AS skipped_without_id,
    (SELECT count(DISTINCT restaurant_id) FROM named WHERE restaurant_id IN (SELECT id FROM known)) AS profiles_existing,
    (SELECT count(DISTINCT restaurant_id) FROM named WHERE restaurant_id NOT IN (SELECT id FROM known)) AS profiles_new""",
)
def backfill_stats(spark, sf_dir):
    known = driver_table(spark, sf_dir, "part").filter("p_size > 25").selectExpr("CAST(p_partkey AS STRING) AS restaurant_id")
    return listing.backfill_stats(_raw(spark, sf_dir, listing.KEY_READS), known)


@query(
    "raw_roundtrip",
    f"""WITH {LISTING_SQL} SELECT provider, planned_window, postcode, snapshot_id, job_id, scheduled_at, captured_at, CAST(2 AS BIGINT) AS restaurants,
    'Outlet ' || pid AS first_name FROM a""",
)
def raw_roundtrip(spark, sf_dir):
    """Land the documents as gzip JSON lines under folders, then read them back."""
    folder = scratch_dir(spark, "raw")
    landing = ("provider", "planned_window", "captured_at")
    writers.write_raw_landing(readers.parse_envelopes(envelopes(spark, sf_dir), keep=("value",), reads=landing), folder, text="value")
    back = readers.read_raw_listings(spark, folder, (*listing.PROVENANCE, "response.restaurants.name"))
    return back.select(
        "provider", "planned_window", "postcode", "snapshot_id", "job_id", "scheduled_at", "captured_at",
        F.size("response.restaurants").cast("long").alias("restaurants"), F.get("response.restaurants", 0)["name"].alias("first_name"),
    )


@query(
    "reparse_audit",
    f"""WITH {LISTING_SQL} SELECT snapshot_id, pid AS ListingId, 'Outlet ' || pid AS Name, 'reparsed' AS only_in, count(*) AS copies FROM a
    WHERE l_tax > 0.05 GROUP BY ALL
    UNION ALL SELECT snapshot_id, pid, 'Changed ' || pid, 'stored', count(*) FROM a WHERE l_tax > 0.05 GROUP BY ALL""",
)
def reparse_audit(spark, sf_dir):
    """The stored side comes from the order lines, with other names where the tax is high."""
    parsed = listing.listing_rows(_raw(spark, sf_dir, listing.LISTING_READS), ("snapshot_id",)).filter("Name LIKE 'Outlet%'").select("snapshot_id", "ListingId", "Name")
    stored = driver_table(spark, sf_dir, "lineitem").selectExpr(
        f"'s-' || {_K} AS snapshot_id", "CAST(l_partkey AS STRING) AS ListingId",
        "CASE WHEN l_tax > 0.05 THEN 'Changed ' || l_partkey ELSE 'Outlet ' || l_partkey END AS Name",
    )
    return listing.reparse_audit(parsed, stored)


# ---- documents of a careless provider (`odd_envelopes`), by the order's number modulo eight

@query(
    "raw_rejects",
    f"""SELECT 'raw/' || {_K} AS raw_uri, CASE WHEN l_orderkey % 8 IN (0, 1, 6) THEN 'unreadable' ELSE 'odd field' END AS flaw
    FROM lineitem WHERE l_orderkey % 8 IN (0, 1, 4, 5, 6)""",
)
def raw_rejects(spark, sf_dir):
    return readers.envelope_rejects(odd_envelopes(spark, sf_dir), keep=("raw_uri",)).select("raw_uri", "flaw")


@query(
    "odd_open_now",
    f"""WITH {LISTING_SQL}, o AS ({_FIRST_ROW} WHERE l_returnflag = 'A' AND l_linestatus = 'O' AND l_quantity <= 40 UNION ALL {_SECOND_ROW})
    SELECT o.* REPLACE (CASE WHEN CAST(split_part(snapshot_id, '-', 2) AS BIGINT) % 8 <> 5 THEN Rating END AS Rating,
        CASE WHEN CAST(split_part(snapshot_id, '-', 2) AS BIGINT) % 8 <> 5 THEN ReviewCount END AS ReviewCount)
    FROM o WHERE CAST(split_part(snapshot_id, '-', 2) AS BIGINT) % 8 NOT IN (0, 1, 6)""",
)
def odd_open_now(spark, sf_dir):
    """Flags that are numbers, texts or lists count by their truth; numbers may come as text."""
    return listing.open_now(readers.parse_envelopes(odd_envelopes(spark, sf_dir), reads=listing.OPEN_READS))


@query(
    "odd_coverage",
    f"""WITH {LISTING_SQL}, {KEYED_SQL} SELECT postcode, restaurant_id,
    CASE WHEN position = 1 THEN TRUE WHEN l_returnflag = 'A' THEN TRUE WHEN l_returnflag = 'R' THEN FALSE END AS is_delivery,
    CASE WHEN position = 0 AND l_orderkey % 8 = 3 THEN l_suppkey * 10 + 0.5::DOUBLE WHEN position = 0 AND l_orderkey % 8 <> 4 THEN CAST(l_suppkey * 10 AS DOUBLE) END AS drive_distance_meters
    FROM k WHERE restaurant_id IS NOT NULL AND l_orderkey % 8 NOT IN (0, 1, 6)""".replace("k AS (SELECT a.*, pid AS restaurant_id", "k AS (SELECT a.*, CASE WHEN l_partkey = 0 THEN CASE WHEN l_linenumber <> 1 THEN 'outlet-0' END ELSE pid END AS restaurant_id"),
)
def odd_coverage(spark, sf_dir):
    rows = listing.coverage_rows(readers.parse_envelopes(odd_envelopes(spark, sf_dir), reads=listing.COVERAGE_READS), "odd")
    return rows.select("postcode", "restaurant_id", "is_delivery", "drive_distance_meters")


@query(
    "schema_conform",
    f"""{cte('snapshots')} SELECT CAST(NULL AS STRING) AS snapshot_id, job_id, CAST(NULL AS STRING) AS provider, postcode, planned_window, CAST(NULL AS STRING) AS scheduled_at,
    {sql_time('captured_at')} AS captured_at, CAST(NULL AS STRING) AS Name, CAST(NULL AS DOUBLE) AS Rating, CAST(NULL AS BIGINT) AS ReviewCount, CAST(NULL AS STRING) AS Categories, CAST(NULL AS STRING) AS DeliveryTime,
    CAST(NULL AS STRING) AS DeliveryFee, CAST(NULL AS STRING) AS MinimumOrder, CAST(NULL AS STRING) AS Offer, CAST(NULL AS STRING) AS Tags, CAST(NULL AS STRING) AS Url, CAST(NULL AS STRING) AS Vertical, ListingId, CAST(NULL AS STRING) AS CuisineIds FROM d_snapshots""",
)
def schema_conform(spark, sf_dir):
    rows = conform_to_schema(domain(spark, sf_dir, "snapshots"), SNAPSHOTS, check_required=False)
    return rows.withColumns({"captured_at": time_text(F.col("captured_at")), "scheduled_at": time_text(F.col("scheduled_at"))})


# ---- release

OBSERVED = writers.RELEASE["observed_availability"]


@query(
    "release_partitions",
    f"""{cte('snapshots')} SELECT 'observed_availability' AS dataset, planned_window AS partition, count(*) AS rows FROM d_snapshots
    WHERE planned_window IN ({TAG_LIST}) GROUP BY ALL""",
)
def release_partitions(spark, sf_dir):
    return writers.release_partitions(domain(spark, sf_dir, "snapshots"), OBSERVED)


@query(
    "release_summary",
    f"""{cte('snapshots')} SELECT 'observed_availability' AS dataset, 'restaurant_snapshots' AS source_table,
    'Outlets seen open at collection time.' AS description, count(*) AS source_rows,
    count(*) FILTER (planned_window IN ({TAG_LIST})) AS exported_rows, count(*) FILTER (planned_window NOT IN ({TAG_LIST})) AS excluded_rows,
    'planned_window' AS partition_field, FALSE AS is_sample_export FROM d_snapshots""",
)
def release_summary(spark, sf_dir):
    return writers.release_summary(domain(spark, sf_dir, "snapshots"), OBSERVED)


@query(
    "release_sample",
    f"""{cte('snapshots')} SELECT postcode, ListingId, {sql_time('captured_at')} AS captured_at, planned_window AS partition_label FROM d_snapshots
    WHERE planned_window IN ({TAG_LIST}) QUALIFY row_number() OVER (PARTITION BY planned_window ORDER BY postcode, ListingId, captured_at) <= 100""",
)
def release_sample(spark, sf_dir):
    """A sampling operator: the first rows of each partition are the result."""
    rows = writers.release_sample(domain(spark, sf_dir, "snapshots"), OBSERVED, 100)
    return rows.select("postcode", "ListingId", time_text(F.col("captured_at")).alias("captured_at"), "partition_label")


def _released(spark: SparkSession, sf_dir: str, out: str | None = None) -> DataFrame:
    tables = {
        "restaurant_snapshots": domain(spark, sf_dir, "snapshots"),
        "postcode_restaurant_delivery_map": domain(spark, sf_dir, "coverage"),
        "restaurant_profile": domain(spark, sf_dir, "profile"),
    }
    return writers.export_release(tables, out or scratch_dir(spark, "release") + "/out", ["profile", "static_coverage", "observed_availability"], rows_per_file=200_000, sample_rows=100)


@query(
    "file_manifest",
    f"""{cte('snapshots', 'coverage', 'profile')} SELECT 'observed_availability' AS dataset, planned_window AS partition, count(*) AS rows, TRUE AS same_bytes, TRUE AS same_hashes
    FROM d_snapshots WHERE planned_window IN ({TAG_LIST}) GROUP BY ALL
    UNION ALL SELECT 'static_coverage', '', count(*), TRUE, TRUE FROM d_coverage UNION ALL SELECT 'restaurant_profile', '', count(*), TRUE, TRUE FROM d_profile""",
)
def file_manifest(spark, sf_dir):
    """Rows per partition by the footers, and whether all files have the bytes and hashes that Spark itself reads."""
    folder = scratch_dir(spark, "release") + "/out"
    files = _released(spark, sf_dir, folder)
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    own = read.select(
        F.substring_index("path", "/out/", -1).alias("relative_path"), F.length("content").cast("long").alias("own_bytes"), F.sha2("content", 256).alias("own_sha256")
    )
    both = files.join(own, "relative_path", "left")
    return both.groupBy("dataset", "partition").agg(
        F.sum("rows").alias("rows"),
        F.bool_and(F.col("bytes").eqNullSafe(F.col("own_bytes"))).alias("same_bytes"),
        F.bool_and(F.col("sha256").eqNullSafe(F.col("own_sha256"))).alias("same_hashes"),
    )


@query(
    "release_limited",
    f"""{cte('coverage', 'profile')} SELECT 'static_coverage' AS dataset, least(count(*), 500) AS rows FROM d_coverage
    UNION ALL SELECT 'restaurant_profile', least(count(*), 500) FROM d_profile""",
)
def release_limited(spark, sf_dir):
    """An export of so many rows of each table: its limit is the feature."""
    tables = {"postcode_restaurant_delivery_map": domain(spark, sf_dir, "coverage"), "restaurant_profile": domain(spark, sf_dir, "profile")}
    files = writers.export_release(tables, scratch_dir(spark, "limited") + "/out", ["profile", "static_coverage"], max_rows=500)
    return files.groupBy("dataset").agg(F.sum("rows").alias("rows"))


@query(
    "append_roundtrip",
    f"""{cte('manifest')}, m AS (SELECT * REPLACE (date_trunc('month', scheduled_at) AS scheduled_at) FROM d_manifest),
    two AS (SELECT * FROM m WHERE scheduled_at < TIMESTAMP '1997-01-01' UNION ALL SELECT * FROM m)
    SELECT job_id, run_id, provider, postcode, planned_window, {sql_time('scheduled_at')} AS scheduled_at FROM two
    WHERE run_id = 'run-F' AND CAST(scheduled_at AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'""",
)
def append_roundtrip(spark, sf_dir):
    """Rows appended in two steps, some of them twice, and read back by run and day; all are due on the first of a month."""
    folder = scratch_dir(spark, "manifest")
    rows = domain(spark, sf_dir, "manifest").withColumn("scheduled_at", F.date_trunc("month", "scheduled_at"))
    for some in (rows.filter("scheduled_at < TIMESTAMP '1997-01-01'"), rows):
        writers.append_rows(some, folder, "job_manifest")
    back = writers.read_table(spark, folder, "job_manifest", ["run-F"], ("1996-03-01", "1998-06-30"))
    return back.select("job_id", "run_id", "provider", "postcode", "planned_window", time_text(F.col("scheduled_at")).alias("scheduled_at"))


@query(
    "partition_manifest",
    f"""{cte('snapshots', 'coverage', 'profile')} SELECT 'observed_availability' AS dataset, planned_window AS partition, count(*) AS rows FROM d_snapshots
    WHERE planned_window IN ({TAG_LIST}) GROUP BY ALL
    UNION ALL SELECT 'static_coverage', 'all', count(*) FROM d_coverage UNION ALL SELECT 'restaurant_profile', 'all', count(*) FROM d_profile""",
)
def partition_manifest(spark, sf_dir):
    """Rows per partition, read back from the released files."""
    return writers.partition_manifest(_released(spark, sf_dir)).select("dataset", "partition", "rows")


_FIELDS = (("job_id", "string", "NULLABLE"), ("postcode", "string", "NULLABLE"), ("planned_window", "string", "REQUIRED"), ("captured_at", "timestamp", "NULLABLE"), ("ListingId", "string", "NULLABLE"))


@query(
    "data_dictionary",
    f"{cte('snapshots')} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS field_name, 'observed_availability' AS dataset, 'restaurant_snapshots' AS source_table, '{kind}' AS field_type, '{mode}' AS mode, '' AS description, count({name}) AS filled_rows FROM d_snapshots"
        for name, kind, mode in _FIELDS
    ),
)
def data_dictionary(spark, sf_dir):
    """The columns of the stored snapshots, with the number of rows that fill each of them."""
    snapshots = domain(spark, sf_dir, "snapshots")
    described = writers.data_dictionary(snapshots, "observed_availability", "restaurant_snapshots")
    counts = snapshots.select([F.count(F.col(name)).alias(name) for name in snapshots.columns])
    filled = counts.unpivot([], snapshots.columns, "field_name", "filled_rows")
    return described.join(filled, "field_name")


# ---- scalar expressions over whole columns


@query(
    "scalar_text",
    """SELECT c_custkey, lower(regexp_replace(c_name || ' ' || c_mktsegment, '\\s+', '', 'g')) AS postcode,
    trim(regexp_replace('  ' || c_mktsegment || chr(9) || ' x ' || c_name || ' ', '\\s+', ' ', 'g')) AS cleaned,
    coalesce(nullif(trim(regexp_replace('/' || c_mktsegment || ' #' || c_nationkey || '/', '[^A-Za-z0-9_.\\-]+', '_', 'g'), '_'), ''), 'empty') AS label,
    CASE c_nationkey % 4 WHEN 0 THEN 'groceries' WHEN 1 THEN 'restaurants,groceries' WHEN 2 THEN 'restaurants' ELSE 'restaurants,groceries' END AS verticals
    FROM customer""",
)
def scalar_text(spark, sf_dir):
    raw = driver_table(spark, sf_dir, "customer").withColumn(
        "v", F.expr("CASE c_nationkey % 4 WHEN 0 THEN ' Grocery ' WHEN 1 THEN 'restaurants, GROCERIES' WHEN 2 THEN 'restaurants' ELSE ' ' END")
    )
    return raw.select(
        "c_custkey",
        clean_postcode(F.concat_ws(" ", "c_name", "c_mktsegment")).alias("postcode"),
        clean_text(F.concat(F.lit("  "), "c_mktsegment", F.lit("\t x "), "c_name", F.lit(" "))).alias("cleaned"),
        partition_label(F.concat(F.lit("/"), "c_mktsegment", F.lit(" #"), "c_nationkey", F.lit("/"))).alias("label"),
        F.array_join(parse_verticals(F.col("v")), ",").alias("verticals"),
    )


@query(
    "scalar_money",
    "SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'Free' ELSE '£' || printf('%.2f', c_acctbal) END AS price FROM customer",
)
def scalar_money(spark, sf_dir):
    return driver_table(spark, sf_dir, "customer").select("c_custkey", format_money(F.col("c_acctbal")).alias("price"))


@query(
    "scalar_ratings",
    """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS DOUBLE) / 10 END AS stars,
    CASE WHEN p_size % 5 <> 0 THEN p_partkey * 7 END AS reviews, CASE WHEN p_size % 5 <> 0 THEN p_partkey * 3 END AS places FROM part""",
)
def scalar_ratings(spark, sf_dir):
    part = driver_table(spark, sf_dir, "part")
    label = F.expr(
        "CASE WHEN p_size % 5 <> 0 THEN CAST(p_size / 10D AS STRING) || ' stars from ' || format_number(p_partkey * 7, 0) || ' reviews' ELSE 'no rating' END"
    )
    body = F.expr("CASE WHEN p_size % 5 <> 0 THEN 'Open now: ' || format_number(p_partkey * 3, 0) || ' Places near you' ELSE 'none' END")
    stars, reviews = parse_rating(label)
    return part.select("p_partkey", stars.alias("stars"), reviews.alias("reviews"), parse_place_count(body).alias("places"))
