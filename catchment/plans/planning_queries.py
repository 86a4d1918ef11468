"""Planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions.clock import LOCAL_ZONE, to_utc, wall_time, wall_text
from catchment.functions.ids import menu_task_id
from catchment.operators import listing, planning
from catchment.operators.planning import Run
from catchment.plans.adapters import cte, domain, driver_table
from catchment.plans.listing_queries import OBSERVED_SQL, observed_intervals
from catchment.plans.registry import query, sql_time, sql_uuid5, time_text

CALENDAR_TAGS = ["weekday_morning", "weekday_evening", "weekend_morning", "weekend_evening"]
RUN = Run("run-P", "listing", "2024-03-01T09:00:00+00:00")

_DAYS = "days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"
_RULES = """(VALUES ('weekday_morning', [1,2,3], '07:00', '10:00'), ('weekday_evening', [1,2,3], '17:00', '21:00'),
    ('weekend_morning', [5,6], '07:00', '10:00'), ('weekend_evening', [4,5,6], '17:00', '21:00')) r(tag, wd, opens, closes)"""
CALENDAR_SQL = f"""{_DAYS}, cal AS (SELECT tag, day, strftime(day, '%Y-%m-%d') || 'T' || opens || ':00' AS local_start,
    strftime(day, '%Y-%m-%d') || 'T' || closes || ':00' AS local_end FROM days, {_RULES} WHERE list_contains(wd, isodow(day) - 1))"""


def order_days(spark, sf_dir):
    return driver_table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()


def calendar(spark, sf_dir):
    """Weekly windows over the days of the orders."""
    return planning.numbered(planning.calendar_days(order_days(spark, sf_dir)).withColumn("day", F.to_date(F.left("local_start", F.lit(10)))))


def utc(expression: str) -> str:
    """Local London time as UTC, in DuckDB."""
    return f"timezone('UTC', timezone('{LOCAL_ZONE}', {expression}))"


def slot_sql(jobs: str) -> str:
    """Schedule of `jobs` (planned_window, ordinal, n, ...) over `cal`, by a range join on running lengths."""
    return f"""iv2 AS (SELECT tag, CAST(local_start AS TIMESTAMP) AS s, CAST(local_end AS TIMESTAMP) AS e,
        CAST(epoch(CAST(local_end AS TIMESTAMP)) - epoch(CAST(local_start AS TIMESTAMP)) - 60 AS DOUBLE) AS len FROM cal),
    iv3 AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY tag ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(len) OVER (PARTITION BY tag) AS total FROM iv2),
    placed AS (SELECT j.*, {utc("s + to_seconds(CAST(floor(j.ordinal * (total / n) - before) AS BIGINT) + CASE WHEN round_even((j.ordinal * (total / n) - before - floor(j.ordinal * (total / n) - before)) * 1000000, 0) >= 1000000 THEN 1 ELSE 0 END)")} AS scheduled_at,
        {utc('e')} AS window_end_at
        FROM {jobs} j JOIN iv3 ON iv3.tag = j.planned_window AND before <= j.ordinal * (total / n) AND j.ordinal * (total / n) < before + len)"""


_PAIRS = f"""pairs AS (SELECT planned_window, postcode, row_number() OVER (PARTITION BY planned_window ORDER BY ordinal) - 1 AS ordinal,
    count(*) OVER (PARTITION BY planned_window) AS n FROM d_postcodes, (VALUES ('weekday_morning'), ('weekday_evening'), ('weekend_morning'), ('weekend_evening')) w(planned_window))"""
_JOB_KEY = "'run-P|listing|' || planned_window || '|' || postcode"
_TASK_SQL = f"""SELECT {sql_uuid5(_JOB_KEY)} AS job_id, 'run-P' AS run_id, 'listing' AS provider, postcode, planned_window,
    {sql_time('scheduled_at')} AS scheduled_at, {sql_time('window_end_at')} AS window_end_at FROM placed"""


def _shown(tasks):
    return tasks.withColumns({name: time_text(F.col(name)) for name in ("scheduled_at", "window_end_at")})


def _postcodes(spark, sf_dir):
    return domain(spark, sf_dir, "postcodes").select("ordinal", "postcode")


@query("calendar_windows", f"WITH {CALENDAR_SQL} SELECT tag, CAST(day - DATE '1970-01-01' AS INTEGER) AS ordinal, local_start, local_end FROM cal")
def calendar_windows(spark, sf_dir):
    return calendar(spark, sf_dir)


@query(
    "daily_windows",
    f"""WITH {_DAYS} SELECT tag, CAST(day - DATE '1970-01-01' AS INTEGER) AS ordinal, strftime(day, '%Y-%m-%d') || 'T09:30:00' AS local_start,
    strftime(day, '%Y-%m-%d') || 'T17:15:00' AS local_end FROM days, (VALUES ('day_a'), ('day_b')) v(tag)""",
)
def daily_windows(spark, sf_dir):
    return planning.numbered(planning.daily_hours(order_days(spark, sf_dir), ["day_a", "day_b"], "09:30", "17:15"))


@query(
    "window_check",
    f"WITH {CALENDAR_SQL} SELECT DISTINCT o_orderpriority AS tag FROM orders WHERE o_orderpriority NOT IN (SELECT tag FROM cal)",
)
def window_check(spark, sf_dir):
    asked = driver_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("tag"))
    asked = asked.unionByName(calendar(spark, sf_dir).select("tag"))
    return planning.window_problems(asked, calendar(spark, sf_dir))


@query(
    "local_to_utc",
    f"""SELECT o_orderkey, {sql_time(utc("o_orderdate + to_hours(CAST(6 + o_orderkey % 12 AS BIGINT))"))} AS naive_utc,
    strftime(timezone('{LOCAL_ZONE}', timezone('UTC', o_orderdate + to_hours(CAST(4 + o_orderkey % 12 AS BIGINT)))), '%Y-%m-%dT%H:%M:%S') AS offset_local FROM orders""",
)
def local_to_utc(spark, sf_dir):
    """Naive text is local; text with an offset is moved to local time."""
    orders = driver_table(spark, sf_dir, "orders")
    clock = F.date_format(F.col("o_orderdate").cast("timestamp") + F.expr("make_interval(0, 0, 0, 0, CAST(6 + o_orderkey % 12 AS INT))"), "yyyy-MM-dd'T'HH:mm:ss")
    return orders.select(
        "o_orderkey",
        time_text(to_utc(wall_time(clock))).alias("naive_utc"),
        wall_text(wall_time(F.concat(clock, F.lit("+02:00")))).alias("offset_local"),
    )


@query(
    "plan_schedule",
    f"""{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {slot_sql('pairs')}
    SELECT planned_window, postcode, ordinal, {sql_time('scheduled_at')} AS scheduled_at, {sql_time('window_end_at')} AS window_end_at FROM placed""",
)
def plan_schedule(spark, sf_dir):
    """Ordinals are worked out again from the input order, as for a file."""
    ordered = planning.global_ordinal(_postcodes(spark, sf_dir).withColumnRenamed("ordinal", "input_order"), planning.stretch(F.col("input_order"), planning.STRETCH), ["input_order"])
    jobs = planning.per_window(ordered.select("ordinal", "postcode"), CALENDAR_TAGS)
    return _shown(planning.schedule(jobs, calendar(spark, sf_dir)))


_RUSH = ("2024-03-04T14:00:00", "2024-03-04T18:30:00")


@query(
    "custom_plan",
    f"""{cte('postcodes')}, w AS (SELECT unnest(['rush', 'late']) AS tag), cal AS (SELECT tag, '{_RUSH[0]}' AS local_start, '{_RUSH[1]}' AS local_end FROM w),
    pairs AS (SELECT tag AS planned_window, postcode, row_number() OVER (PARTITION BY tag ORDER BY ordinal) - 1 AS ordinal, count(*) OVER (PARTITION BY tag) AS n FROM d_postcodes, w),
    {slot_sql('pairs')} SELECT planned_window, postcode, ordinal, {sql_time('scheduled_at')} AS scheduled_at, {sql_time('window_end_at')} AS window_end_at FROM placed""",
)
def custom_plan(spark, sf_dir):
    """All postcodes over one custom window under two names."""
    names = ["rush", "late"]
    jobs = planning.per_window(_postcodes(spark, sf_dir), names)
    return _shown(planning.schedule(jobs, planning.custom_windows(spark, names, *_RUSH)))


@query(
    "stable_ids",
    f"""{cte('events')} SELECT event_id, {sql_uuid5("'snapshot|' || job_id || '|' || " + sql_time('event_time'))} AS snapshot_id,
    {sql_uuid5("'run-P|' || job_id || '|' || coalesce(raw_uri, 'None')")} AS task_id FROM d_events""",
)
def stable_ids(spark, sf_dir):
    events = domain(spark, sf_dir, "events")
    return events.select(
        "event_id",
        listing.snapshot_id(F.col("job_id"), time_text(F.col("event_time"))).alias("snapshot_id"),
        menu_task_id(F.lit("run-P"), F.col("job_id"), F.col("raw_uri")).alias("task_id"),
    )


@query("plan_jobs", f"{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {slot_sql('pairs')} {_TASK_SQL}")
def plan_jobs(spark, sf_dir):
    return _shown(planning.plan_jobs(_postcodes(spark, sf_dir), CALENDAR_TAGS, calendar(spark, sf_dir), RUN))


@query(
    "plan_immediate",
    f"""{cte('postcodes')}, {_PAIRS}, placed AS (SELECT *, TIMESTAMP '2024-03-01 09:00:00' + to_seconds(ordinal) AS scheduled_at, CAST(NULL AS TIMESTAMP) AS window_end_at FROM pairs) {_TASK_SQL}""",
)
def plan_immediate(spark, sf_dir):
    return _shown(planning.plan_jobs(_postcodes(spark, sf_dir), CALENDAR_TAGS, None, RUN))


_HELD = "held AS (SELECT CASE WHEN c_nationkey % 2 = 0 THEN 'weekday_morning' ELSE 'weekend_evening' END AS planned_window, 'pc' || CAST(c_custkey AS STRING) AS postcode FROM customer WHERE c_acctbal > 3000)"
_MISSING = """missing AS (SELECT planned_window, postcode, row_number() OVER (PARTITION BY planned_window ORDER BY ordinal) - 1 AS ordinal,
    count(*) OVER (PARTITION BY planned_window) AS n FROM pairs p WHERE NOT EXISTS (SELECT 1 FROM held h WHERE h.planned_window = p.planned_window AND h.postcode = p.postcode))"""


def _held(spark, sf_dir):
    """A manifest that already holds some (window, postcode) pairs of the run."""
    rows = driver_table(spark, sf_dir, "customer").filter("c_acctbal > 3000").selectExpr(
        "CASE WHEN c_nationkey % 2 = 0 THEN 'weekday_morning' ELSE 'weekend_evening' END AS planned_window",
        "'pc' || c_custkey AS postcode",
        "'run-P' AS run_id",
    )
    return rows.withColumn("job_id", planning.job_id(F.lit("run-P"), F.lit("listing"), F.col("planned_window"), F.col("postcode")))


@query("plan_resume", f"{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {_HELD}, {_MISSING}, {slot_sql('missing')} {_TASK_SQL}")
def plan_resume(spark, sf_dir):
    return _shown(planning.plan_resume(_postcodes(spark, sf_dir), CALENDAR_TAGS, calendar(spark, sf_dir), RUN, _held(spark, sf_dir)))


@query(
    "plan_skipped",
    f"""{cte('postcodes')}, {_PAIRS}, {_HELD} SELECT p.planned_window, count(*) AS postcodes, count(h.postcode) AS skipped_existing FROM pairs p
    LEFT JOIN held h ON h.planned_window = p.planned_window AND h.postcode = p.postcode GROUP BY ALL""",
)
def plan_skipped(spark, sf_dir):
    return planning.skipped_counts(_postcodes(spark, sf_dir), CALENDAR_TAGS, _held(spark, sf_dir), RUN)


@query(
    "manifest_new_rows",
    f"""{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {_HELD}, {slot_sql('pairs')}, t AS ({_TASK_SQL}),
    h2 AS (SELECT {sql_uuid5(_JOB_KEY)} AS job_id FROM held)
    SELECT job_id, run_id, provider, postcode, planned_window, scheduled_at, 'job-' || job_id AS task_name, 'pending' AS status,
    CAST(0 AS BIGINT) AS attempt_count, CAST(3 AS BIGINT) AS max_attempts FROM t WHERE job_id NOT IN (SELECT job_id FROM h2)""",
)
def manifest_new_rows(spark, sf_dir):
    tasks = planning.plan_jobs(_postcodes(spark, sf_dir), CALENDAR_TAGS, calendar(spark, sf_dir), RUN)
    rows = planning.new_manifest_rows(planning.manifest_rows(tasks, RUN), _held(spark, sf_dir), RUN.run_id)
    return rows.withColumn("scheduled_at", time_text(F.col("scheduled_at"))).select(
        "job_id", "run_id", "provider", "postcode", "planned_window", "scheduled_at", "task_name", "status", "attempt_count", "max_attempts"
    )


@query(
    "plan_summary",
    f"""{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {slot_sql('pairs')} SELECT planned_window, count(*) AS jobs,
    strftime(min(scheduled_at), '%Y-%m-%dT%H:%M:%SZ') AS first_scheduled, strftime(max(scheduled_at), '%Y-%m-%dT%H:%M:%SZ') AS last_scheduled FROM placed GROUP BY ALL""",
)
def plan_summary(spark, sf_dir):
    return planning.plan_summary(planning.plan_jobs(_postcodes(spark, sf_dir), CALENDAR_TAGS, calendar(spark, sf_dir), RUN))


_RANK = "sha256(restaurant_id || 'seed-1')"


@query(
    "seeded_sample",
    f"""{cte('profile')} SELECT restaurant_id, restaurant_unique_name, {_RANK} AS rank_key FROM d_profile WHERE restaurant_unique_name <> ''
    ORDER BY rank_key, restaurant_id LIMIT 1000""",
)
def seeded_sample(spark, sf_dir):
    """A sampling operator: its limit is the size of the sample."""
    return planning.seeded_sample(domain(spark, sf_dir, "profile"), "seed-1", 1000).select("restaurant_id", "restaurant_unique_name", "rank_key")


@query(
    "menu_plan",
    f"""{cte('profile')}, o AS (SELECT *, row_number() OVER (ORDER BY {_RANK}, restaurant_id) - 1 AS i FROM d_profile WHERE restaurant_unique_name <> '')
    SELECT {sql_uuid5("'run-M|' || restaurant_id || '|' || restaurant_unique_name")} AS task_id, 'run-M' AS run_id, restaurant_id, restaurant_name,
    restaurant_unique_name, {sql_time("TIMESTAMP '2024-03-01 09:00:00' + to_seconds(i)")} AS scheduled_at FROM o""",
)
def menu_plan(spark, sf_dir):
    """Tasks for every outlet with a slug, in the seeded order."""
    profile = domain(spark, sf_dir, "profile").filter(F.col("restaurant_unique_name") != "")
    ranked = profile.withColumn("rank_key", F.sha2(F.concat("restaurant_id", F.lit("seed-1")), 256))
    tasks = planning.menu_tasks(ranked, "run-M", "2024-03-01T09:00:00+00:00")
    return tasks.withColumn("scheduled_at", time_text(F.col("scheduled_at"))).select(
        "task_id", "run_id", "restaurant_id", "restaurant_name", "restaurant_unique_name", "scheduled_at"
    )


@query(
    "scrape_jobs",
    f"""{cte('postcodes')}, {CALENDAR_SQL}, {_PAIRS}, {slot_sql('pairs')} SELECT provider, postcode, planned_window, scheduled_at, 'pending' AS status,
    CAST(0 AS BIGINT) AS attempt_count, CAST(3 AS BIGINT) AS max_attempts FROM ({_TASK_SQL})""",
)
def scrape_jobs(spark, sf_dir):
    jobs = planning.per_window(_postcodes(spark, sf_dir), CALENDAR_TAGS)
    rows = planning.scrape_jobs(planning.schedule(jobs, calendar(spark, sf_dir)), RUN)
    return rows.withColumn("scheduled_at", time_text(F.col("scheduled_at"))).select(
        "provider", "postcode", "planned_window", "scheduled_at", "status", "attempt_count", "max_attempts"
    )
