"""Domain tables out of the driver tables.

Each table is one SELECT that both Spark and DuckDB read; `{name}` stands for a driver table. The queries run the
package's jobs over these tables, the SQL twins compute the same results from them on their own.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = ("weekday_afternoon", "weekday_evening", "weekday_early_hours", "saturday_peak")

_WINDOW = """CASE o_orderpriority WHEN '1-URGENT' THEN 'weekday_afternoon' WHEN '2-HIGH' THEN 'weekday_evening'
    WHEN '3-MEDIUM' THEN 'weekday_early_hours' WHEN '5-LOW' THEN 'saturday_peak' ELSE 'smoke_temporal' END"""

_EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'started' WHEN 'purchase' THEN 'succeeded' WHEN 'error' THEN 'failed'
    WHEN 'click' THEN 'deferred' ELSE 'rejected' END"""

_LINE_KEY = "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)"

TABLES = {
    "postcodes": "SELECT c_custkey AS ordinal, ' Pc ' || CAST(c_custkey AS STRING) || ' ' AS raw, 'pc' || CAST(c_custkey AS STRING) AS postcode FROM {customer}",
    "profile": """SELECT CAST(p_partkey AS STRING) AS restaurant_id,
    CASE p_partkey % 16 WHEN 0 THEN 'Co-op Food' WHEN 1 THEN 'Coop Local' WHEN 2 THEN 'Morrisons Daily'
        WHEN 3 THEN 'Morrisonson' WHEN 4 THEN 'Sainsbury''s Local' WHEN 5 THEN 'Sainsburys' WHEN 6 THEN 'ASDA Express'
        WHEN 7 THEN 'Asda  Cafe' WHEN 8 THEN 'Iceland' WHEN 9 THEN '  Waitrose & Partners' WHEN 10 THEN 'SPAR'
        WHEN 11 THEN 'Shop N Drive' WHEN 12 THEN 'Best-One' WHEN 13 THEN NULL WHEN 14 THEN 'Premier Grill'
        ELSE p_name END AS restaurant_name,
    CASE WHEN p_size % 9 = 0 THEN '' WHEN p_size % 11 = 0 THEN NULL ELSE replace(p_name, ' ', '-') END AS restaurant_unique_name,
    'https://listings.example/' || CAST(p_partkey AS STRING) AS restaurant_url,
    CASE p_partkey % 7 WHEN 0 THEN 'Groceries' WHEN 1 THEN 'Groceries, Convenience' WHEN 2 THEN 'Pizza, Grocery'
        WHEN 3 THEN 'Alcohol' WHEN 4 THEN NULL WHEN 5 THEN 'Groceriesx' ELSE 'grocery , Supermarket' END AS cuisine_names
    FROM {part}""",
    "coverage": """SELECT 'full_coverage_2026' AS snapshot_label, 'pc' || CAST(o_custkey AS STRING) AS postcode,
    CAST(l_partkey AS STRING) AS restaurant_id,
    CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'R' THEN FALSE ELSE NULL END AS is_delivery,
    l_extendedprice AS delivery_fee
    FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "snapshots": f"""SELECT CAST(o_orderkey AS STRING) AS job_id, 'pc' || CAST(o_custkey AS STRING) AS postcode,
    {_WINDOW} AS planned_window, CAST(l_shipdate AS TIMESTAMP) AS captured_at, CAST(l_partkey AS STRING) AS ListingId
    FROM {{lineitem}} JOIN {{orders}} ON l_orderkey = o_orderkey""",
    "geography_ew": """SELECT 'E' || CAST(c_nationkey AS STRING) || '-' || CAST(c_custkey AS STRING) AS geo_code, ' Pc ' || CAST(c_custkey AS STRING) AS postcode
    FROM {customer} WHERE c_nationkey % 2 = 0
    UNION ALL SELECT 'E-second-' || CAST(c_custkey AS STRING) AS geo_code, 'PC' || CAST(c_custkey AS STRING) AS postcode
    FROM {customer} WHERE c_acctbal > 5000
    UNION ALL SELECT NULL AS geo_code, 'PC' || CAST(c_custkey AS STRING) AS postcode FROM {customer} WHERE c_acctbal < 0""",
    "geography_sc": """SELECT 'S' || CAST(c_custkey AS STRING) AS geo_code, 'p C' || CAST(c_custkey AS STRING) AS postcode
    FROM {customer} WHERE c_nationkey % 2 = 1""",
    "manifest": f"""SELECT CAST(o_custkey AS STRING) AS job_id, 'run-' || o_orderstatus AS run_id, 'listing' AS provider,
    'pc' || CAST(o_custkey AS STRING) AS postcode, {_WINDOW} AS planned_window,
    CAST(o_orderdate AS TIMESTAMP) AS scheduled_at,
    CAST(o_orderdate AS TIMESTAMP) AS created_at,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 1 + o_orderkey % 4 END AS max_attempts, o_orderkey AS tie
    FROM {{orders}}""",
    "events": f"""SELECT CAST(event_id AS STRING) AS event_id, CAST(user_id AS STRING) AS job_id, {_EVENT_TYPE} AS event_type,
    CAST(ts AS TIMESTAMP) AS event_time,
    CASE WHEN event_type = 'purchase' AND event_id % 7 <> 0 THEN 'raw/' || CAST(event_id AS STRING) || '.json.gz' END AS raw_uri,
    CASE WHEN event_type = 'purchase' THEN event_id % 50 END AS processed_rows
    FROM {{events}}""",
    "tasks": """SELECT CASE WHEN c_custkey % 13 = 0 THEN 'x' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) END AS job_id,
    CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_nationkey % 2 = 0 THEN 'run-F' ELSE 'run-O' END AS run_id,
    'listing' AS provider, 'PC ' || CAST(c_custkey AS STRING) AS postcode,
    CASE WHEN c_nationkey % 3 = 0 THEN 'weekday_afternoon' WHEN c_nationkey % 3 = 1 THEN 'weekday_evening' ELSE 'smoke_temporal' END AS planned_window,
    CAST('2024-01-10 00:00:00' AS TIMESTAMP) AS scheduled_at,
    CASE WHEN c_acctbal < 1000 THEN CAST('2024-01-15 10:00:00' AS TIMESTAMP) WHEN c_acctbal < 6000 THEN CAST('2024-02-15 10:00:00' AS TIMESTAMP) END AS window_end_at,
    CASE WHEN c_mktsegment = 'BUILDING' THEN 'k0' ELSE 'k1' END AS limiter_key
    FROM {customer}""",
    "bans": """SELECT 'k' || CAST(user_id % 2 AS STRING) AS limiter_key, CAST(ts AS TIMESTAMP) AS ban_until FROM {events}
    WHERE event_type = 'error' AND user_id % 2 = 0""",
    "diagnostics": """SELECT event_id AS diagnostic_id, CAST(user_id AS STRING) AS job_id, user_id % 3 AS limiter_key,
    CAST(ts AS TIMESTAMP) AS event_time, CAST(floor(value * 10) AS BIGINT) AS latency_ms, event_type AS outcome, props FROM {events}""",
    "openings": """SELECT o_orderkey AS page_id, o_orderkey, o_custkey, o_totalprice, o_orderstatus, o_orderdate FROM {orders}""",
}

_NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A domain table as a lazy frame."""
    text = TABLES[name]
    used = {table: driver_table(spark, sf_dir, table) for table in set(re.findall(r"\{(\w+)\}", text))}
    return spark.sql(text, **used)


def cte(*names: str) -> str:
    """The same tables as DuckDB common table expressions, prefixed d_."""
    parts = [f"d_{name} AS ({TABLES[name].format(**{table: table for table in _NAMES})})" for name in names]
    return "WITH " + ",\n".join(parts)


#: Rows of a table that one task makes documents of, where what it does with them is held in memory or takes long.
TASK_ROWS = 1 << 18


def spread(df: DataFrame, key: str | None = None, most: int = TASK_ROWS) -> DataFrame:
    """Deal the rows out over the cores where a small table comes as fewer splits than cores; large ones stay as read.

    With a key, large tables are cut into its stretches too, of about `most` rows, so that a task's share doesn't grow with
    the table. Neighbours stay together, as jobs that group do more before their shuffle where keys come again soon.
    """
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    wanted = -(-df.count() // most) if key else 0
    if wanted > max(splits, cores):
        return df.repartitionByRange(wanted, key)
    return df.repartition(cores) if splits < cores else df


def diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request diagnostics with millisecond clocks and a status out of the event's properties."""
    base = domain(spark, sf_dir, "diagnostics")
    k = F.get_json_object("props", "$.k").cast("long") % 10
    start = F.unix_millis("event_time")
    return base.select(
        *[name for name in base.columns if name != "props"],
        F.when(k == 0, 429).when(k == 1, 403).when(k == 2, 503).otherwise(200).cast("long").alias("http_status"),
        start.alias("start_ms"),
        (start + F.col("latency_ms")).alias("finish_ms"),
    )


DIAGNOSTICS_SQL = (
    cte("diagnostics")
    + """, d AS (SELECT diagnostic_id, job_id, limiter_key, event_time, latency_ms, outcome,
    CAST(CASE CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 WHEN 0 THEN 429 WHEN 1 THEN 403 WHEN 2 THEN 503 ELSE 200 END AS BIGINT) AS http_status,
    epoch_us(event_time) // 1000 AS start_ms, epoch_us(event_time) // 1000 + latency_ms AS finish_ms FROM d_diagnostics)"""
)

# Raw listing documents: two outlets per order line, one by part and one by supplier, with gaps of every kind.
LINE_KEY = _LINE_KEY
WINDOW_OF_LINE = """CASE l_linenumber % 5 WHEN 0 THEN 'weekday_afternoon' WHEN 1 THEN 'weekday_evening'
    WHEN 2 THEN 'weekday_early_hours' WHEN 3 THEN 'saturday_peak' ELSE 'smoke_temporal' END"""


def envelopes(spark: SparkSession, sf_dir: str, most: int | None = None) -> DataFrame:
    """One raw JSON document per order line, as (value, raw_uri); with `most`, about so many in a task at most."""
    e = F.expr
    first = F.struct(
        e("l_partkey").alias("id"),
        e("'Outlet ' || l_partkey").alias("name"),
        e("CASE WHEN l_linenumber <> 1 THEN 'outlet-' || l_partkey END").alias("uniqueName"),
        e("CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'R' THEN FALSE END").alias("isDelivery"),
        e("l_linestatus = 'O'").alias("isOpenNowForDelivery"),
        e("CASE WHEN l_quantity > 40 THEN TRUE WHEN l_quantity > 20 THEN FALSE END").alias("isTemporarilyOffline"),
        e(
            "array(named_struct('name', 'Pizza', 'uniqueName', 'pizza'),"
            " named_struct('name', CASE WHEN l_quantity < 25 THEN 'Groceries' END, 'uniqueName', CASE WHEN l_quantity < 30 THEN 'groceries' ELSE 'pizza' END),"
            " named_struct('name', 'Alcohol', 'uniqueName', 'alcohol'))"
        ).alias("cuisines"),
        e("named_struct('starRating', l_quantity / 10, 'count', l_suppkey)").alias("rating"),
        e(
            "named_struct('rangeLower', CASE WHEN l_linenumber <> 2 THEN l_linenumber * 5 END, 'rangeUpper', l_linenumber * 5 + 10,"
            " 'approximate', CASE WHEN l_linenumber = 2 THEN 25 END)"
        ).alias("deliveryEtaMinutes"),
        e("CASE WHEN l_linenumber = 3 THEN NULL WHEN l_linenumber = 4 THEN 0 ELSE l_extendedprice END").alias("deliveryCost"),
        e("CASE WHEN l_linenumber = 5 THEN ' ask  us ' ELSE CAST(l_linenumber AS STRING) END").alias("minimumDeliveryValue"),
        e("array(named_struct('description', '  '), named_struct('description', CASE WHEN l_tax > 0.04 THEN '10% off' END), named_struct('description', 'Free  drink'))").alias("deals"),
        e("CASE WHEN l_tax > 0.02 THEN array('New', 'Top ' || l_linenumber) END").alias("tags"),
        e(
            "named_struct('firstLine', l_linenumber || ' High St', 'city', 'Leeds', 'postalCode', 'LS' || l_suppkey, 'location',"
            " named_struct('coordinates', CASE WHEN l_linenumber = 6 THEN array(1.5D) ELSE array(-1.5D, 53.25D + l_linenumber) END))"
        ).alias("address"),
        e("CASE WHEN l_linenumber > 2 THEN 'logo-' || l_partkey END").alias("logoUrl"),
        e("l_suppkey * 10").alias("driveDistanceMeters"),
    )
    second = F.struct(
        e("CASE WHEN l_quantity < 10 THEN 0 END").alias("id"),
        e("CASE WHEN l_quantity < 30 THEN 's' || l_suppkey END").alias("restaurantId"),
        e("'Supplier ' || l_suppkey").alias("name"),
        e("CASE WHEN l_linenumber % 2 = 1 THEN 'supplier-' || l_suppkey END").alias("uniqueName"),
        F.lit(True).alias("isDelivery"),
        F.lit(True).alias("isOpenNowForDelivery"),
    )
    document = F.struct(
        e(f"'s-' || {_LINE_KEY}").alias("snapshot_id"),
        e(f"'j-' || {_LINE_KEY}").alias("job_id"),
        F.lit("listing").alias("provider"),
        e("'pc' || l_suppkey").alias("postcode"),
        e(WINDOW_OF_LINE).alias("planned_window"),
        e("date_format(l_shipdate, \"yyyy-'01-01T'07:00:00\")").alias("scheduled_at"),
        e("date_format(l_shipdate, \"yyyy-'01-01T'08:00:00\")").alias("captured_at"),
        F.struct(
            F.struct(F.struct(e("array(CASE WHEN l_quantity < 25 THEN CAST(l_partkey AS STRING) END, 'zzz')").alias("restaurantIds")).alias("groceries")).alias("filters"),
            F.array().alias("restaurants"),
        ).alias("response"),
    )
    # The two outlets differ in shape, so they are spliced in as text.
    whole = F.to_json(document)
    lines = driver_table(spark, sf_dir, "lineitem")
    lines = spread(lines, "l_orderkey", most) if most else spread(lines)
    outlets = F.concat(F.lit('"restaurants":['), F.to_json(first), F.lit(","), F.to_json(second), F.lit("]"))
    head = F.substring_index(whole, '"restaurants":', 1)
    return lines.select(F.concat(head, outlets, F.lit("}}")).alias("value"), e(f"'raw/' || {_LINE_KEY}").alias("raw_uri"))


#: What `odd_envelopes` does to a document, by the order's number modulo eight; each is a (pattern, text in its place).
_ODD = {
    2: [('"isOpenNowForDelivery":true', '"isOpenNowForDelivery":1'), ('"isDelivery":true', '"isDelivery":"yes"'), ('"isTemporarilyOffline":false', '"isTemporarilyOffline":0')],
    3: [(r'"driveDistanceMeters":(\d+)', '"driveDistanceMeters":$1.5'), (r'"count":(\d+)', '"count":"$1"')],
    4: [(r'"driveDistanceMeters":\d+', '"driveDistanceMeters":"far"')],
    5: [(r'"rating":\{[^}]*\}', '"rating":"good"')],
    7: [('"isDelivery":true', '"isDelivery":"false"'), ('"isTemporarilyOffline":false', '"isTemporarilyOffline":[]')],
}


def odd_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw documents as a careless provider sends them: cut off, in a list, blank, or with values of other types."""
    raw = envelopes(spark, sf_dir).withColumn("kind", F.regexp_extract("raw_uri", r"raw/(\d+)-", 1).cast("long") % 8)
    value = F.col("value")
    odd = F.when(F.col("kind") == 0, F.left("value", F.length("value") - 2)).when(F.col("kind") == 1, F.concat(F.lit("["), "value", F.lit("]"))).when(F.col("kind") == 6, "")
    for kind, changes in _ODD.items():
        text = value
        for pattern, other in changes:
            text = F.regexp_replace(text, pattern, other)
        odd = odd.when(F.col("kind") == kind, text)
    return raw.select(odd.alias("value"), "raw_uri")


def menu_pages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Saved menu pages, one per part, and their item and detail documents."""
    e = F.expr
    part = spread(driver_table(spark, sf_dir, "part"))
    item = "named_struct('Id', 'i' || i, 'Name', 'Item ' || i, 'Description', CASE WHEN i % 2 = 0 THEN 'Tasty' END, 'Type', 'food', 'Labels', array('L' || i, 'x'), 'Variations', array(named_struct('Id', 'v' || i, 'Name', 'Var ' || i, 'BasePrice', p_retailprice + i, 'ModifierGroupsIds', array('g2', 'g1'), 'DealGroupsIds', array('d1')), named_struct('Id', 'w' || i, 'Name', 'Big ' || i, 'BasePrice', p_retailprice + i + 2, 'ModifierGroupsIds', array('g1'), 'DealGroupsIds', CAST(NULL AS array<string>))), 'EnergyContent', named_struct('EnergyDisplay', i || ' kcal'), 'EnergyUnits', 'kcal', 'ImageSources', array(named_struct('Path', 'img/' || i)), 'Restrictions', array(named_struct('z', i, 'a', 'age')))"
    state = F.struct(
        e("p_partkey").alias("restaurantId"),
        e("named_struct('id', p_partkey, 'name', p_name)").alias("restaurantInfo"),
        e("CASE WHEN p_size % 3 <> 0 THEN 'items/' || p_partkey END").alias("itemsUrl"),
        e("'details/' || p_partkey").alias("itemDetailsUrl"),
        e(
            "transform(sequence(1, 1 + p_size % 3), m -> named_struct('menuGroupId', 'm' || m, 'description', 'Menu ' || m, 'categories',"
            " transform(sequence(1, 2), c -> named_struct('id', 'c' || c, 'name', 'Category ' || c, 'itemIds', transform(sequence(m, m + c), n -> 'i' || n)))))"
        ).alias("menus"),
    )
    inline = e(f"transform(sequence(1, 3), i -> {item})")
    cdn = F.struct(state.alias("restaurant"), inline.alias("items"))
    document = F.struct(
        F.struct(
            F.struct(F.struct(F.struct(F.struct(cdn.alias("cdn")).alias("restaurant")).alias("menu")).alias("preloadedState"),).alias("appProps")
        ).alias("props")
    )
    html = F.concat(
        F.lit('<html><script src="x.js"></script><script id="__NEXT_DATA__" type="application/json">'), F.to_json(document), F.lit("</script></html>")
    )
    pages = part.select(
        e("p_partkey").alias("page_id"), F.when(e("p_size = 50"), F.lit("<html><p>no state</p></html>")).otherwise(html).alias("html")
    )
    items = F.to_json(F.struct(e(f"CASE WHEN p_size % 3 <> 0 THEN transform(sequence(2, 4), i -> {item}) END").alias("Items")))
    details = F.to_json(
        F.struct(
            e("transform(sequence(1, 3), s -> named_struct('Id', s, 'Modifier', named_struct('Id', 'mod' || s, 'Name', 'Modifier ' || s, 'AdditionPrice', s + 1, 'NutritionalInfo', named_struct('kcal', s))))").alias("ModifierSets"),
            e("array(named_struct('Id', 'g1', 'Name', 'Group 1', 'MinChoices', 0, 'MaxChoices', p_size, 'Modifiers', array(1, 2, 9)), named_struct('Id', 'g2', 'Name', 'Group 2', 'MinChoices', 1, 'MaxChoices', 1, 'Modifiers', array(3)))").alias("ModifierGroups"),
            e("array(named_struct('Id', 'd1', 'Name', 'Deal', 'NumberOfChoices', p_size, 'DealItemVariations', array(named_struct('DealItemVariationId', 'v2', 'MinChoices', 1, 'AdditionPrice', p_retailprice), named_struct('DealItemVariationId', 'nope', 'MinChoices', 0, 'AdditionPrice', 0.5D))))").alias("DealGroups"),
        )
    )
    documents = part.select(e("p_partkey").alias("page_id"), items.alias("items_json"), details.alias("details_json"))
    return pages, documents


def manifest_log(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Menu tasks, one per order, and a fetch log with up to two attempts each."""
    e = F.expr
    orders = spread(driver_table(spark, sf_dir, "orders"), "o_orderkey")
    tasks = orders.select(
        e("CAST(o_orderkey AS STRING)").alias("task_id"),
        F.lit("run-1").alias("run_id"),
        e("CAST(o_custkey AS STRING)").alias("restaurant_id"),
        e("'Outlet ' || o_custkey").alias("restaurant_name"),
        e("' outlet-' || o_custkey || ' '").alias("restaurant_unique_name"),
        F.lit(None).cast("string").alias("restaurant_url"),
        F.lit(None).cast("string").alias("cuisine_names"),
    )
    times = (
        "transform(sequence(1, 1 + o_orderkey % 3), n -> named_struct('FromLocalTime', CASE WHEN o_custkey % 10 <> 0 THEN lpad(8 + n * 3, 2, '0') || ':00' END,"
        " 'ToLocalTime', CASE WHEN n = 3 THEN '02:00' WHEN n = 2 THEN '14:00' ELSE '12:30' END))"
    )
    body = F.to_json(
        F.struct(
            e("o_custkey").alias("RestaurantId"),
            e("'items/' || o_custkey").alias("ItemsUrl"),
            e("array(named_struct('Id', 'm1'), named_struct('Id', 'm2'))").alias("Menus"),
            e(
                "named_struct('Name', 'Outlet ' || o_custkey, 'TimeZone', 'Europe/London', 'IsOffline', o_orderstatus = 'P', 'RestaurantOpeningTimes',"
                f" array(named_struct('ServiceType', 'Delivery', 'TimesPerDay', array(named_struct('DayOfWeek', 'Monday', 'Times', {times}), named_struct('DayOfWeek', 'Friday', 'Times', {times}))),"
                f" named_struct('ServiceType', 'Collection', 'TimesPerDay', array(named_struct('DayOfWeek', 'Sunday', 'Times', {times})))))"
            ).alias("RestaurantInfo"),
        )
    )
    when = e("CAST(o_orderdate AS TIMESTAMP)")
    ok_first, ok_second = e("o_orderstatus <> 'F'"), e("o_orderkey % 4 <> 0")
    entry = lambda attempt, source, ok, path, shift: F.struct(
        F.lit(attempt).alias("attempt"),
        F.lit(source).alias("source"),
        F.concat(F.lit(path), F.col("o_custkey").cast("string")).alias("url"),
        F.when(ok, 200).when(e("o_orderkey % 3 = 0"), 404).otherwise(F.lit(None)).cast("long").alias("status"),
        e(f"100 + o_custkey + {shift}").alias("latency_ms"),
        when.alias("finished_at"),
        F.when(ok, body).alias("body"),
    )
    log = orders.select(
        e("CAST(o_orderkey AS STRING)").alias("task_id"),
        F.inline(
            F.when(ok_first, F.array(entry(1, "original", ok_first, "m/", 0))).otherwise(
                F.array(entry(1, "original", ok_first, "m/", 0), entry(2, "v2_2", ok_second, "v2_2/m/", 7))
            )
        ),
    )
    return tasks, log


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved responses: one JSON body per event, repeated addresses, and the saved pages as HTML bodies."""
    e = F.expr
    events = spread(driver_table(spark, sf_dir, "events"), "event_id").select(
        e("'e' || event_id").alias("response_id"),
        e("CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END").alias("method"),
        F.lit(200).cast("long").alias("status"),
        F.lit("application/json").alias("content_type"),
        e("'https://api.example.com/' || event_type || '/' || (user_id % 40) || '?page=' || (event_id % 9) || '&blank=&q=a%20b'").alias("url"),
        e("CASE WHEN event_type = 'purchase' THEN ' body  ' || (event_id % 5) END").alias("post_data"),
        e(
            "to_json(named_struct('type', event_type, 'list', transform(sequence(1, 1 + user_id % 8), n -> named_struct('name', 'N' || n, 'rating', value)),"
            " 'more', named_struct('k', array(1, 2, user_id))))"
        ).alias("body"),
        e("CAST(ts AS TIMESTAMP)").alias("arrived_at"),
    )
    pages = driver_table(spark, sf_dir, "pages").select(
        e("'p' || page_id").alias("response_id"),
        F.lit("GET").alias("method"),
        F.lit(200).cast("long").alias("status"),
        F.lit("text/html").alias("content_type"),
        "url",
        F.lit(None).cast("string").alias("post_data"),
        F.col("html").alias("body"),
        e("timestamp_seconds(page_id)").alias("arrived_at"),
    )
    return events.unionByName(pages)
