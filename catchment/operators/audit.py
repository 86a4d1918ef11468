"""Run audits: latency, spacing, bans, concurrency, outcomes, spillover, keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catchment.operators.ordered import BUCKET, earlier, exact_percentiles, in_bucket, running, stretch, with_carries

# Request spacing, start guard and ban length.
SPACING_MS = 1300
GUARD_MS = 1000
BAN_SECONDS = 3600
#: Milliseconds of a key's time that are put in order together.
BUCKET_MS = 600_000

PERCENTILES = {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def millis(instant: Column) -> Column:
    return F.unix_millis(instant)


def diagnostics_enriched(diagnostics: DataFrame) -> DataFrame:
    """Add the reserved instant and the queue, limiter and request times in milliseconds."""
    return diagnostics.select(
        "*",
        F.timestamp_millis("limiter_token_reserved_for_ms").alias("reserved_for"),
        (millis(F.col("worker_started_at")) - millis(F.col("worker_received_at"))).alias("queue_delay_ms"),
        (millis(F.col("limiter_acquire_finished_at")) - millis(F.col("limiter_acquire_started_at"))).alias("limiter_acquire_ms"),
        (millis(F.col("api_request_finished_at")) - millis(F.col("api_request_started_at"))).alias("request_ms"),
    )


def status_class(status: Column) -> Column:
    return (
        F.when(status.isNull(), "none")
        .when(status.isin(403, 429), status.cast("string"))
        .when(status >= 500, "5xx")
        .when(status >= 400, "4xx")
        .otherwise("ok")
    )


def http_outcomes(diagnostics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Requests per status class and outcome."""
    classed = diagnostics.withColumn("status_class", status_class(F.col("http_status")))
    return classed.groupBy(*(keys or []), "status_class", "outcome").agg(F.count(F.lit(1)).alias("requests"))


def latency_percentiles(diagnostics: DataFrame, keys: list[str], value: str = "api_latency_ms", points: dict[str, float] | None = None) -> DataFrame:
    return exact_percentiles(diagnostics, keys, value, points or PERCENTILES)


def start_gaps(diagnostics: DataFrame, key: str = "limiter_key", start: str = "start_ms", tie: str = "diagnostic_id") -> DataFrame:
    """Milliseconds since the previous request start of the key; NULL for the first."""
    starts = diagnostics.filter(F.col(start).isNotNull()).select(key, start, tie)
    # In start order the previous start is the largest one before the row.
    placed = running(starts, [key], stretch(F.col(start), BUCKET_MS), [start, tie], {"previous_ms": ("max", F.col(start))}, inclusive=False)
    return placed.select(key, tie, start, (F.col(start) - F.col("previous_ms")).alias("gap_ms"))


def request_gaps(diagnostics: DataFrame, key: str = "limiter_key", start: str = "start_ms", tie: str = "diagnostic_id", points: dict[str, float] | None = None) -> DataFrame:
    """Smallest gap and gap percentiles per key."""
    return exact_percentiles(start_gaps(diagnostics, key, start, tie), [key], "gap_ms", points or PERCENTILES)


def spacing_replay(arrivals: DataFrame, key: str = "limiter_key", arrival: str = "arrival_ms", tie: str = "diagnostic_id", spacing_ms: int = SPACING_MS, guard_ms: int = GUARD_MS) -> DataFrame:
    """The start each request would be given: the later of arrival plus guard and previous start plus spacing.

    With n the position in the key, that is the running maximum of (arrival + guard - n * spacing), plus n * spacing. A
    bucket's share of both goes on as one pair: how many requests it has, and its maximum as if it were the first; moved
    by the requests before, that is its part in the maximum of all.
    """
    order, spacing = [arrival, tie], F.lit(spacing_ms).cast("long")
    rows = arrivals.filter(F.col(arrival).isNotNull()).withColumn(BUCKET, stretch(F.col(arrival), BUCKET_MS))
    inside = Window.partitionBy(key, BUCKET).orderBy(*order)
    floor = (F.col(arrival) + F.lit(guard_ms)).cast("long")
    own = rows.select(key, BUCKET, (floor - (F.row_number().over(inside) - 1) * spacing).alias("_floor"))
    pairs = own.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("_n"), F.max("_floor").alias("_floor"))
    moved = pairs.withColumn("_n", F.coalesce(F.sum("_n").over(earlier([key])), F.lit(0))).withColumn("_floor", F.col("_floor") - F.col("_n") * spacing)
    carries = moved.select(key, BUCKET, "_n", F.max("_floor").over(earlier([key])).alias("_floor"))
    both = with_carries(rows.withColumn("_n", F.lit(1).cast("long")).withColumn("_floor", floor), carries)
    counted = both.withColumn("position", F.coalesce(F.sum("_n").over(in_bucket([key], order, inclusive=False)), F.lit(0).cast("long")))
    base = F.when(F.col("_row") == 0, F.col("_floor")).otherwise(F.col("_floor") - F.col("position") * spacing)
    placed = counted.withColumn("floor_ms", F.max(base).over(in_bucket([key], order))).filter("_row = 1")
    reserved = F.col("floor_ms") + F.col("position") * spacing
    return placed.select(
        *arrivals.columns,
        "position",
        reserved.alias("reserved_ms"),
        (reserved - F.col(arrival)).alias("wait_ms"),
    )


def ban_audit(diagnostics: DataFrame, key: str = "limiter_key", start: str = "start_ms", finish: str = "finish_ms", tie: str = "diagnostic_id", ban_seconds: int = BAN_SECONDS) -> DataFrame:
    """Whether each request started while a ban was open, and until when.

    A 429 opens the ban when its response is back, so finish and start instants share one timeline and the latest
    finish is a running maximum. At equal instants the start comes first.
    """
    request = diagnostics.filter(F.col(start).isNotNull()).select(
        key, F.col(start).alias("at_ms"), F.lit(0).alias("kind"), F.col(tie).cast("string").alias("tie"), F.lit(None).cast("long").alias("ban_ms"), F.col("http_status")
    )
    bans = diagnostics.filter((F.col("http_status") == 429) & F.col(finish).isNotNull()).select(key, F.col(finish).alias("at_ms"))
    opened = bans.distinct().select(
        key, "at_ms", F.lit(1).alias("kind"), F.lit("").alias("tie"), F.col("at_ms").alias("ban_ms"), F.lit(429).cast("long").alias("http_status")
    )
    order = ["at_ms", "kind", "tie"]
    timeline = request.withColumn("http_status", F.col("http_status").cast("long")).unionByName(opened)
    placed = running(timeline, [key], stretch(F.col("at_ms"), BUCKET_MS), order, {"last_ban_ms": ("max", F.col("ban_ms"))})
    until = F.col("last_ban_ms") + F.lit(ban_seconds * 1000)
    is_open = F.coalesce(F.col("at_ms") < until, F.lit(False))
    return placed.filter("kind = 0").select(
        key,
        F.col("tie").alias(tie),
        F.col("at_ms").alias(start),
        "http_status",
        is_open.alias("circuit_open"),
        F.when(is_open, until).alias("ban_until_ms"),
    )


def in_flight(diagnostics: DataFrame, key: str = "limiter_key", start: str = "start_ms", finish: str = "finish_ms") -> DataFrame:
    """Requests open after each instant at which the number changes, per key."""
    whole = diagnostics.filter(F.col(start).isNotNull() & F.col(finish).isNotNull())
    steps = whole.select(
        key, F.inline(F.array(F.struct(F.col(start).alias("at_ms"), F.lit(1).alias("step")), F.struct(F.col(finish).alias("at_ms"), F.lit(-1).alias("step"))))
    )
    changes = steps.groupBy(key, "at_ms").agg(F.sum("step").alias("step"))
    at = stretch(F.col("at_ms"), BUCKET_MS)
    return running(changes, [key], at, ["at_ms"], {"open_requests": ("sum", F.col("step"))}).select(key, "at_ms", "open_requests")


def peak_in_flight(diagnostics: DataFrame, key: str = "limiter_key", start: str = "start_ms", finish: str = "finish_ms") -> DataFrame:
    return in_flight(diagnostics, key, start, finish).groupBy(key).agg(F.max("open_requests").alias("peak_open"))


def spillover(snapshots: DataFrame, intervals: DataFrame, captured: str = "captured_at") -> DataFrame:
    """Snapshots per tag, inside and outside the tag's intervals, as (planned_window, rows, inside, outside).

    `intervals` holds (tag, opens_at, closes_at) in UTC, end excluded. Rows are counted per (tag, second) first; the
    interval is then found by the days it touches, so the lookup is an equi-join.
    """
    seconds = snapshots.groupBy("planned_window", F.unix_seconds(captured).alias("second")).agg(F.count(F.lit(1)).alias("rows"))
    day = F.floor(F.col("second") / 86_400)
    opens, closes = F.unix_seconds("opens_at"), F.unix_seconds("closes_at")
    slots = intervals.select(
        F.col("tag").alias("planned_window"), opens.alias("opens"), closes.alias("closes"),
        F.explode(F.sequence(F.floor(opens / 86_400), F.floor((closes - 1) / 86_400))).alias("day"),
    ).distinct()
    left = seconds.withColumn("day", day).alias("s")
    right = slots.alias("i")
    hit = left.join(
        right,
        (F.col("s.planned_window") == F.col("i.planned_window"))
        & (F.col("s.day") == F.col("i.day"))
        & (F.col("s.second") >= F.col("i.opens"))
        & (F.col("s.second") < F.col("i.closes")),
        "left_semi",
    ).select("planned_window", F.lit(True).alias("is_inside"), "rows")
    totals = seconds.select("planned_window", F.lit(False).alias("is_inside"), "rows")
    return (
        totals.unionByName(hit)
        .groupBy("planned_window")
        .agg(
            F.sum(F.when(~F.col("is_inside"), F.col("rows"))).alias("rows"),
            F.coalesce(F.sum(F.when(F.col("is_inside"), F.col("rows"))), F.lit(0).cast("long")).alias("inside"),
        )
        .withColumn("outside", F.col("rows") - F.col("inside"))
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def key_summary(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Rows, distinct keys and surplus rows of a table's key."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    ).select("table_name", "rows", "distinct_keys", "repeated_keys", (F.col("rows") - F.col("distinct_keys")).alias("surplus_rows"))


def fk_audit(frames: dict[str, DataFrame], edges: list[tuple[str, str, str, str]]) -> DataFrame:
    """Per edge (child, child key, parent, parent key): child rows, rows without a parent, and NULL keys.

    Child keys are counted before the join, so a hot key is one row there.
    """
    reports = []
    for child, child_key, parent, parent_key in edges:
        keys = frames[child].groupBy(F.col(child_key).cast("string").alias("k")).agg(F.count(F.lit(1)).alias("n"))
        known = frames[parent].select(F.col(parent_key).cast("string").alias("k"), F.lit(True).alias("known")).distinct()
        joined = keys.join(known, "k", "left")
        zero = F.lit(0).cast("long")
        reports.append(
            joined.agg(
                F.lit(child).alias("child"),
                F.lit(parent).alias("parent"),
                F.coalesce(F.sum("n"), zero).alias("child_rows"),
                F.coalesce(F.sum(F.when(F.col("known").isNull() & F.col("k").isNotNull(), F.col("n"))), zero).alias("orphan_rows"),
                F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("n"))), zero).alias("null_rows"),
            )
        )
    return reduce(lambda left, right: left.unionByName(right), reports)
