"""Collection planning: windows, schedules, job and task tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catchment.functions.clock import CALENDAR_RULES, epoch_seconds, iso_text, to_utc, wall_time
from catchment.functions.ids import job_id, key_of, menu_task_id, task_name, uuid5
from catchment.operators.ordered import STRETCH, global_ordinal, keyed_ordinal, stretch
from catchment.session import pin

# Fixed value: seconds kept free before the end of each interval.
END_GUARD_SECONDS = 60
# Most jobs in one lookup block of the slot join.
MAX_BLOCK = 65_536


@dataclass(frozen=True)
class Run:
    """Settings of one planned run; `created_at` is an ISO instant, so that a rerun gives the same rows."""

    run_id: str
    provider: str
    created_at: str
    max_attempts: int = 3

    def instant(self) -> Column:
        return F.to_timestamp(F.lit(self.created_at))


def calendar_days(days: DataFrame) -> DataFrame:
    """Windows of the weekly rules over (`day`) rows: tag, local start and end."""
    weekday = F.weekday("day")
    rules = []
    for tag, weekdays, start, end in CALENDAR_RULES:
        rules.append(
            F.when(
                weekday.isin(list(weekdays)),
                F.struct(F.lit(tag).alias("tag"), F.lit(start).alias("opens"), F.lit(end).alias("closes")),
            )
        )
    hit = days.select("day", F.inline(F.array_compact(F.array(*rules))))
    return hit.select("tag", "day", *_on_day("opens", "closes"))


def _on_day(opens: str, closes: str) -> list[Column]:
    day = F.date_format("day", "yyyy-MM-dd")
    return [
        F.concat(day, F.lit("T"), F.col(opens), F.lit(":00")).alias("local_start"),
        F.concat(day, F.lit("T"), F.col(closes), F.lit(":00")).alias("local_end"),
    ]


def _days(spark: SparkSession, start_date: str, count: int) -> DataFrame:
    """Consecutive days; the count is a setting, so the rows are spelled out in one array."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(start_date)), F.date_add(F.to_date(F.lit(start_date)), count - 1))).alias("day")
    )


def numbered(intervals: DataFrame) -> DataFrame:
    """Number the intervals of each tag by day; a tag has at most one interval a day."""
    return intervals.select(
        "tag", F.datediff("day", F.lit("1970-01-01").cast("date")).alias("ordinal"), "local_start", "local_end"
    )


def calendar_windows(spark: SparkSession, weeks: int, start_date: str) -> DataFrame:
    return numbered(calendar_days(_days(spark, start_date, max(1, int(weeks) * 7))))


def daily_windows(spark: SparkSession, names: Iterable[str], start_date: str, days: int, start_time: str, end_time: str) -> DataFrame:
    """The same local hours on consecutive days for every name; seconds are dropped."""
    if days <= 0:
        raise ValueError("days must be positive")
    start, end = start_time[:5], end_time[:5]
    if any(mark in text for text in (start_time, end_time) for mark in "+Zz"):
        raise ValueError("daily local times must not carry an offset")
    if end <= start:
        raise ValueError("the end time must be later than the start time")
    return numbered(daily_hours(_days(spark, start_date, days), names, start, end))


def daily_hours(days: DataFrame, names: Iterable[str], start: str, end: str) -> DataFrame:
    tagged = days.select(
        "day", F.explode(F.array(*[F.lit(name) for name in names])).alias("tag"), F.lit(start).alias("o"), F.lit(end).alias("c")
    )
    return tagged.select("tag", "day", *_on_day("o", "c"))


def custom_windows(spark: SparkSession, names: Iterable[str], start: str, end: str) -> DataFrame:
    from catchment.sources.readers import interval_rows

    rows = [(name, 0, start, end) for name in names]
    return interval_rows(spark.createDataFrame(rows, "tag string, ordinal int, local_start string, local_end string"))


def explicit_windows(spark: SparkSession, path_or_json: str | dict, names: Iterable[str]) -> DataFrame:
    from catchment.sources.readers import read_window_config

    return read_window_config(spark, path_or_json, names)


def window_problems(requested: DataFrame, intervals: DataFrame) -> DataFrame:
    """Requested tags without any interval."""
    return requested.select("tag").distinct().join(intervals.select("tag").distinct(), "tag", "left_anti")


def check_windows(intervals: DataFrame, names: list[str]) -> None:
    """Raise on requested names that the intervals do not cover; both are settings of a few rows."""
    wanted = intervals.sparkSession.createDataFrame([(name,) for name in names], "tag string")
    unknown = sorted(row.tag for row in window_problems(wanted, intervals).collect())
    if unknown:
        raise ValueError(f"Unknown or empty windows: {', '.join(unknown)}")


def _lookup(values: dict[str, int], name: str) -> Column:
    """A setting per window name as a literal map."""
    pairs = [part for key, value in values.items() for part in (F.lit(key), F.lit(value).cast("long"))]
    return F.try_element_at(F.create_map(*pairs), F.col(name))


def interval_offsets(intervals: DataFrame, counts: dict[str, int], guard_seconds: int = END_GUARD_SECONDS) -> DataFrame:
    """Per interval: wall start, guarded length, seconds before it in its tag, and the step between jobs.

    Lengths are wall-clock, so a clock change inside an interval does not count.
    """
    if guard_seconds < 0:
        raise ValueError("the window end guard must not be negative")
    start, end = wall_time(F.col("local_start")), wall_time(F.col("local_end"))
    length = epoch_seconds(end) - epoch_seconds(start) - F.lit(guard_seconds)
    checked = F.when(
        length <= 0, F.raise_error(F.lit("window intervals must be longer than the end guard")).cast("long")
    ).otherwise(length)
    timed = intervals.filter(F.col("tag").isin(list(counts))).select(
        "tag",
        F.col("ordinal").alias("interval"),
        epoch_seconds(start).alias("start_seconds"),
        epoch_seconds(end).alias("end_seconds"),
        checked.cast("double").alias("length"),
    )
    earlier = Window.partitionBy("tag").orderBy("interval").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("tag")
    return timed.select(
        "*",
        F.coalesce(F.sum("length").over(earlier), F.lit(0.0)).alias("before"),
        (F.sum("length").over(whole) / _lookup(counts, "tag")).alias("step"),
    )


def schedule(jobs: DataFrame, intervals: DataFrame, guard_seconds: int = END_GUARD_SECONDS, counts: dict[str, int] | None = None) -> DataFrame:
    """Spread jobs evenly over their tag's intervals.

    `jobs` holds (planned_window, ordinal, ...) with dense 0-based ordinals per window. Adds `scheduled_at` and
    `window_end_at` in UTC. Offsets are doubles on purpose: they decide which side of a boundary a job falls on.

    The interval of a job is found by an equi-join on blocks of ordinals about as long as one interval holds, so a job
    meets two or three candidates, and a window with many jobs has many blocks.
    """
    if counts is None:
        # One row per window name, which are settings.
        rows = jobs.groupBy("planned_window").agg(F.count(F.lit(1)).alias("jobs")).collect()
        counts = {row.planned_window: row.jobs for row in rows}
    counts = {name: total for name, total in counts.items() if total > 0}
    at, instant = F.lit(None), "timestamp"
    if not counts:
        return jobs.filter(F.lit(False)).select("*", at.cast(instant).alias("scheduled_at"), at.cast(instant).alias("window_end_at"))
    spans = {row.tag: row.n for row in intervals.groupBy("tag").agg(F.count(F.lit(1)).alias("n")).collect()}
    unknown = sorted(set(counts) - set(spans))
    if unknown:
        raise ValueError(f"No intervals for windows: {', '.join(unknown)}")
    sizes = {name: min(MAX_BLOCK, max(1, total // max(1, spans.get(name, 1)))) for name, total in counts.items()}
    offsets = interval_offsets(intervals, counts, guard_seconds)
    first = F.greatest(F.floor(F.col("before") / F.col("step")) - 1, F.lit(0))
    last = F.ceil((F.col("before") + F.col("length")) / F.col("step")) + 1
    block = _lookup(sizes, "tag")
    slots = offsets.select(
        F.col("tag").alias("planned_window"),
        "start_seconds",
        "end_seconds",
        "length",
        "before",
        "step",
        F.explode(F.sequence(F.floor(first / block), F.floor(last / block))).alias("block"),
    )
    placed = jobs.withColumn("block", F.floor(F.col("ordinal") / _lookup(sizes, "planned_window"))).join(
        slots, ["planned_window", "block"]
    )
    offset = F.col("ordinal") * F.col("step")
    placed = placed.filter((F.col("before") <= offset) & (offset < F.col("before") + F.col("length")))
    remaining = offset - F.col("before")
    whole = F.floor(remaining)
    # Microseconds round half to even and may carry into the next second.
    carry = F.when(F.rint((remaining - whole) * 1_000_000) >= 1_000_000, 1).otherwise(0)
    seconds = (F.col("start_seconds") + whole + carry).cast("long")
    return placed.select(
        *jobs.columns,
        to_utc(F.timestamp_seconds(seconds)).alias("scheduled_at"),
        to_utc(F.timestamp_seconds(F.col("end_seconds"))).alias("window_end_at"),
    )


def per_window(postcodes: DataFrame, windows: list[str]) -> DataFrame:
    """Every postcode once for each requested window name."""
    names = F.array(*[F.lit(name) for name in windows])
    return postcodes.select(F.explode(names).alias("planned_window"), "*")


def immediate_schedule(items: DataFrame, now: str, ordinal: str = "ordinal") -> DataFrame:
    """One item a second from `now` on, without a window end."""
    base = F.to_timestamp(F.lit(now))
    return items.select(
        "*",
        F.timestamp_add("SECOND", F.col(ordinal).cast("int"), base).alias("scheduled_at"),
        F.lit(None).cast("timestamp").alias("window_end_at"),
    )


def task_rows(scheduled: DataFrame, run: Run) -> DataFrame:
    """Task payloads: identity, schedule and window end."""
    return scheduled.select(
        job_id(F.lit(run.run_id), F.lit(run.provider), F.col("planned_window"), F.col("postcode")).alias("job_id"),
        F.lit(run.run_id).alias("run_id"),
        F.lit(run.provider).alias("provider"),
        "postcode",
        "planned_window",
        "scheduled_at",
        "window_end_at",
    )


def manifest_rows(tasks: DataFrame, run: Run) -> DataFrame:
    """Manifest rows of tasks: pending, no attempts, without the window end."""
    instant, text, number = F.lit(None).cast("timestamp"), F.lit(None).cast("string"), F.lit(None).cast("long")
    return tasks.drop("window_end_at").select(
        "*",
        run.instant().alias("created_at"),
        task_name(F.col("job_id")).alias("task_name"),
        F.lit("pending").alias("status"),
        F.lit(0).cast("long").alias("attempt_count"),
        F.lit(run.max_attempts).cast("long").alias("max_attempts"),
        instant.alias("started_at"),
        instant.alias("finished_at"),
        text.alias("raw_uri"),
        number.alias("processed_rows"),
        text.alias("error"),
    )


def plan_jobs(postcodes: DataFrame, windows: list[str], intervals: DataFrame | None, run: Run, guard_seconds: int = END_GUARD_SECONDS) -> DataFrame:
    """Task rows for every (window, postcode); `postcodes` holds (ordinal, postcode). No intervals means at once."""
    jobs = per_window(postcodes, windows)
    if intervals is None:
        return task_rows(immediate_schedule(jobs, run.created_at), run)
    counts = dict.fromkeys(windows, postcodes.count())
    return task_rows(schedule(jobs, intervals, guard_seconds, counts), run)


def missing_jobs(postcodes: DataFrame, windows: list[str], manifest: DataFrame, run: Run) -> DataFrame:
    """(window, postcode) pairs the manifest lacks for the run, renumbered in input order per window."""
    known = manifest.filter((F.col("run_id") == run.run_id) & F.col("planned_window").isin(windows)).select(
        "planned_window", "postcode"
    )
    open_pairs = per_window(postcodes, windows).join(known.distinct(), ["planned_window", "postcode"], "left_anti")
    renamed = open_pairs.withColumnRenamed("ordinal", "input_ordinal")
    return keyed_ordinal(renamed, ["planned_window"], stretch(F.col("input_ordinal"), STRETCH), ["input_ordinal"])


def plan_resume(postcodes: DataFrame, windows: list[str], intervals: DataFrame | None, run: Run, manifest: DataFrame, guard_seconds: int = END_GUARD_SECONDS) -> DataFrame:
    """Task rows of the missing pairs only; fewer jobs are spread over the same intervals."""
    jobs = missing_jobs(postcodes, windows, manifest, run).select("planned_window", "ordinal", "postcode")
    if intervals is None:
        return task_rows(immediate_schedule(jobs, run.created_at), run)
    jobs = pin(jobs)
    return task_rows(schedule(jobs, intervals, guard_seconds), run)


def skipped_counts(postcodes: DataFrame, windows: list[str], manifest: DataFrame, run: Run) -> DataFrame:
    """Per window, how many postcodes the manifest already holds."""
    known = (
        manifest.filter((F.col("run_id") == run.run_id) & F.col("planned_window").isin(windows))
        .select("planned_window", "postcode")
        .distinct()
        .withColumn("known", F.lit(1))
    )
    pairs = per_window(postcodes.select("postcode"), windows)
    # Equal postcodes are counted first, so a repeated one does not load one task of the join.
    pairs = pairs.groupBy("planned_window", "postcode").agg(F.count(F.lit(1)).alias("n"))
    joined = pairs.join(known, ["planned_window", "postcode"], "left")
    return joined.groupBy("planned_window").agg(
        F.sum("n").alias("postcodes"),
        F.coalesce(F.sum(F.when(F.col("known") == 1, F.col("n"))), F.lit(0).cast("long")).alias("skipped_existing"),
    )


def new_manifest_rows(rows: DataFrame, manifest: DataFrame, run_id: str) -> DataFrame:
    """Rows whose job the manifest does not hold for the run."""
    known = manifest.filter(F.col("run_id") == run_id).select("job_id").distinct()
    return rows.join(known, "job_id", "left_anti")


def plan_summary(tasks: DataFrame) -> DataFrame:
    """Jobs and first and last start per window."""
    return tasks.groupBy("planned_window").agg(
        F.count(F.lit(1)).alias("jobs"),
        iso_text(F.min("scheduled_at")).alias("first_scheduled"),
        iso_text(F.max("scheduled_at")).alias("last_scheduled"),
    )


def scrape_jobs(scheduled: DataFrame, run: Run) -> DataFrame:
    """Rows of the older mutable job table; the id is stable here, so a rerun repeats it."""
    rows = manifest_rows(task_rows(scheduled, run), run)
    identifier = uuid5(key_of(F.lit("scrape-job"), F.col("job_id"), F.col("scheduled_at")))
    return rows.withColumn("job_id", identifier).drop("run_id", "task_name")


def seeded_sample(df: DataFrame, seed: str, n: int | None, id_column: str = "restaurant_id", slug_column: str = "restaurant_unique_name") -> DataFrame:
    """The first n rows (all without n), with a slug, in the order of a seeded hash; adds `rank_key` to sort by."""
    rank = F.sha2(F.concat(F.col(id_column).cast("string"), F.lit(seed)), 256)
    ranked = df.filter(F.col(slug_column) != "").withColumn("rank_key", rank)
    return ranked if n is None else ranked.orderBy("rank_key", id_column).limit(n)


def menu_tasks(restaurants: DataFrame, run_id: str, now: str) -> DataFrame:
    """Menu tasks, one a second from `now`, in the order of `rank_key`."""
    ordered = global_ordinal(restaurants, F.left("rank_key", F.lit(3)), ["rank_key", "restaurant_id"])
    timed = immediate_schedule(ordered, now)
    identifier = menu_task_id(F.lit(run_id), F.col("restaurant_id"), F.col("restaurant_unique_name"))
    return timed.select(
        identifier.alias("task_id"),
        F.lit(run_id).alias("run_id"),
        F.col("restaurant_id").cast("string").alias("restaurant_id"),
        "restaurant_name",
        "restaurant_unique_name",
        "restaurant_url",
        "cuisine_names",
        "scheduled_at",
        F.to_timestamp(F.lit(now)).alias("created_at"),
        task_name(identifier, "menu-manifest").alias("task_name"),
    )
