"""Job state and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catchment.functions.clock import to_utc, wall_time
from catchment.operators import audit, jobs
from catchment.plans.adapters import DIAGNOSTICS_SQL, cte, diagnostics, domain, driver_table, manifest_log
from catchment.plans.listing_queries import OBSERVED_SQL, observed_intervals
from catchment.plans.planning_queries import utc
from catchment.plans.registry import query, sql_time, time_text
from catchment.sources import readers
from catchment.streaming import streams
from catchment.streaming.streams import late_flag, outcome_windows

_MANIFEST_ORDER = "created_at, run_id, provider, postcode, planned_window, scheduled_at, max_attempts"
LATEST_SQL = f"""lm AS (SELECT job_id, run_id, provider, postcode, planned_window, scheduled_at, CAST(coalesce(max_attempts, 3) AS BIGINT) AS max_attempts
    FROM d_manifest QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY created_at DESC, run_id DESC, provider DESC, postcode DESC, planned_window DESC,
    scheduled_at DESC, max_attempts DESC NULLS LAST) = 1)"""


@query("latest_manifest", f"{cte('manifest')}, {LATEST_SQL} SELECT job_id, run_id, provider, postcode, planned_window, {sql_time('scheduled_at')} AS scheduled_at, max_attempts FROM lm")
def latest_manifest(spark, sf_dir):
    return jobs.latest_manifest(domain(spark, sf_dir, "manifest")).withColumn("scheduled_at", time_text(F.col("scheduled_at")))


@query(
    "latest_success",
    f"""{cte('events')} SELECT job_id, {sql_time('event_time')} AS event_time, raw_uri, processed_rows FROM d_events WHERE event_type = 'succeeded'
    QUALIFY row_number() OVER (PARTITION BY job_id ORDER BY event_time DESC) = 1""",
)
def latest_success(spark, sf_dir):
    return jobs.latest_success(domain(spark, sf_dir, "events")).withColumn("event_time", time_text(F.col("event_time")))


@query("job_attempts", f"{cte('events')} SELECT job_id, count(*) AS attempts FROM d_events WHERE event_type = 'started' GROUP BY ALL")
def job_attempts(spark, sf_dir):
    return jobs.job_attempts(domain(spark, sf_dir, "events"))


@query(
    "job_status",
    f"""{cte('events')} SELECT job_id, CASE WHEN bool_or(event_type = 'succeeded') THEN 'succeeded' ELSE max_by(event_type, event_time) END AS status,
    count(*) FILTER (event_type = 'started') AS attempts, count(*) AS events, {sql_time('max(event_time)')} AS last_event_time FROM d_events GROUP BY job_id""",
)
def job_status(spark, sf_dir):
    return jobs.job_status(domain(spark, sf_dir, "events")).withColumn("last_event_time", time_text(F.col("last_event_time")))


@query(
    "running_attempts",
    f"""{cte('events')}, j AS (SELECT job_id, least(count(DISTINCT event_id) FILTER (event_type = 'started'), 3) AS attempts,
    bool_or(event_type = 'succeeded') AS has_succeeded FROM d_events GROUP BY job_id)
    SELECT job_id, CAST(attempts AS INTEGER) AS attempts, has_succeeded,
    CASE WHEN has_succeeded THEN 'succeeded' WHEN attempts >= 3 THEN 'exhausted' ELSE 'open' END AS state FROM j""",
)
def running_attempts(spark, sf_dir):
    return streams.running_attempts(domain(spark, sf_dir, "events"))


@query(
    "one_result",
    f"""{cte('events')} SELECT job_id, arg_min(event_id, (event_time, event_id)) AS event_id, {sql_time('min(event_time)')} AS event_time
    FROM d_events WHERE event_type = 'succeeded' GROUP BY job_id""",
)
def one_result(spark, sf_dir):
    results = domain(spark, sf_dir, "events").filter("event_type = 'succeeded'")
    return streams.one_result(results, "event_time", "event_id").select("job_id", "event_id", time_text(F.col("event_time")).alias("event_time"))


_NOW = "2024-01-20 12:00:00"


@query(
    "admission",
    f"""{cte('manifest', 'events', 'tasks', 'bans')}, {LATEST_SQL}, ev AS (SELECT job_id, count(*) FILTER (event_type = 'started') AS attempts,
        bool_or(event_type = 'succeeded') AS won FROM d_events GROUP BY job_id),
    b AS (SELECT limiter_key, max(ban_until) AS ban_until FROM d_bans GROUP BY ALL),
    j AS (SELECT t.*, m.job_id AS m_job, m.max_attempts, coalesce(ev.attempts, 0) AS attempts, coalesce(won, FALSE) AS won, ban_until,
        [x FOR x IN [CASE WHEN m.run_id <> t.run_id THEN 'run_id' END, CASE WHEN m.provider <> t.provider THEN 'provider' END,
        CASE WHEN m.postcode <> lower(replace(t.postcode, ' ', '')) THEN 'postcode' END, CASE WHEN m.planned_window <> t.planned_window THEN 'planned_window' END] IF x IS NOT NULL] AS mm
        FROM d_tasks t LEFT JOIN lm m ON m.job_id = t.job_id LEFT JOIN ev ON ev.job_id = t.job_id LEFT JOIN b ON b.limiter_key = t.limiter_key),
    r AS (SELECT *, CASE WHEN run_id IS NULL THEN 0 WHEN m_job IS NULL THEN 1 WHEN len(mm) > 0 THEN 2 WHEN won THEN 3 WHEN attempts >= max_attempts THEN 4
        WHEN coalesce(TIMESTAMP '{_NOW}' >= window_end_at, FALSE) THEN 5 WHEN coalesce(ban_until > TIMESTAMP '{_NOW}', FALSE) THEN 6 ELSE 7 END AS d FROM j)
    SELECT job_id, run_id, planned_window, attempts,
    ['missing_fields', 'rejected', 'rejected', 'already_succeeded', 'max_attempts_reached', 'window_expired', 'deferred', 'run'][d + 1] AS decision,
    CAST([400, 404, 409, 200, 200, 200, 503, 200][d + 1] AS INTEGER) AS status_code,
    CASE d WHEN 0 THEN 'Missing fields: run_id' WHEN 1 THEN 'Job is not in job_manifest' WHEN 2 THEN 'Task payload does not match job_manifest: ' || array_to_string(mm, ', ')
        WHEN 4 THEN 'Max attempts reached' WHEN 5 THEN 'Observation window ended at ' || strftime(window_end_at, '%Y-%m-%dT%H:%M:%S+00:00') WHEN 6 THEN 'Ban circuit active' END AS message FROM r""",
)
def admission(spark, sf_dir):
    decided = jobs.admission(
        domain(spark, sf_dir, "tasks"), domain(spark, sf_dir, "manifest"), domain(spark, sf_dir, "events"), domain(spark, sf_dir, "bans"),
        F.lit(_NOW).cast("timestamp"),
    )
    return decided.select("job_id", "run_id", "planned_window", "attempts", "decision", "status_code", "message")


@query(
    "late_tasks",
    f"{cte('tasks')} SELECT job_id, {sql_time('window_end_at')} AS window_end_at, coalesce(TIMESTAMP '{_NOW}' >= window_end_at, FALSE) AS is_expired FROM d_tasks",
)
def late_tasks(spark, sf_dir):
    tasks = domain(spark, sf_dir, "tasks").withColumn("received_at", F.lit(_NOW).cast("timestamp"))
    return late_flag(tasks).select("job_id", time_text(F.col("window_end_at")).alias("window_end_at"), "is_expired")


@query(
    "succeeded_uris",
    f"{cte('events')} SELECT raw_uri, {sql_time('event_time')} AS event_time FROM d_events WHERE event_type = 'succeeded' AND raw_uri IS NOT NULL",
)
def succeeded_uris(spark, sf_dir):
    rows = readers.succeeded_uris(domain(spark, sf_dir, "events"))
    return rows.withColumn("event_time", time_text(F.col("event_time")))


# ---- menu fetches

_BODY_OK = "(o_orderstatus <> 'F' OR o_orderkey % 4 <> 0)"
_FETCH_SQL = f"""f AS (SELECT *, CAST(o_orderkey AS STRING) AS task_id, CAST(o_custkey AS STRING) AS cust, o_orderstatus <> 'F' AS ok1, {_BODY_OK} AS ok,
    CASE WHEN o_orderkey % 3 = 0 THEN '404' ELSE 'error' END AS bad FROM orders)"""


def _fetched(spark, sf_dir):
    tasks, log = manifest_log(spark, sf_dir)
    return tasks, jobs.manifest_attempts(log)


@query(
    "manifest_results",
    f"""WITH {_FETCH_SQL} SELECT task_id, 'run-1' AS run_id, cust AS restaurant_id, 'outlet-' || cust AS restaurant_unique_name, {sql_time('o_orderdate')} AS fetched_at,
    CASE WHEN ok1 THEN 'original' WHEN ok THEN 'v2_2' END AS manifest_source, CASE WHEN ok1 THEN 'm/' || cust ELSE 'v2_2/m/' || cust END AS manifest_url,
    CAST(CASE WHEN ok THEN 200 WHEN bad = '404' THEN 404 END AS BIGINT) AS http_status, CASE WHEN ok1 THEN 100 + o_custkey ELSE 107 + o_custkey END AS latency_ms,
    NOT ok1 AS fallback_used, CASE WHEN ok THEN cust END AS manifest_restaurant_id, CASE WHEN ok THEN 'Outlet ' || cust END AS manifest_name,
    CASE WHEN ok THEN 'Europe/London' END AS timezone, CASE WHEN ok THEN o_orderstatus = 'P' END AS is_offline,
    CAST(CASE WHEN ok THEN 2 ELSE 0 END AS BIGINT) AS menu_count, CASE WHEN ok THEN 'items/' || cust END AS items_url, CAST(NULL AS STRING) AS item_details_url,
    CAST(CASE WHEN ok THEN 3 * (1 + o_orderkey % 3) ELSE 0 END AS BIGINT) AS opening_time_count, CASE WHEN ok THEN 'Collection|Delivery' END AS opening_service_types,
    CASE WHEN ok THEN 'succeeded' ELSE 'failed' END AS outcome,
    CASE WHEN NOT ok THEN CASE WHEN bad = '404' THEN 'Menu manifest returned HTTP 404: ' ELSE 'Menu manifest request failed: ' END || 'v2_2/m/' || cust || ' | attempts=original:' || bad || '; v2_2:' || bad END AS error FROM f""",
)
def manifest_results(spark, sf_dir):
    tasks, chosen = _fetched(spark, sf_dir)
    rows = jobs.manifest_results(tasks, chosen)
    return rows.drop("result_id", "restaurant_name", "restaurant_url", "cuisine_names").withColumn("fetched_at", time_text(F.col("fetched_at")))


@query(
    "opening_times",
    f"""WITH {_FETCH_SQL}, n AS (SELECT f.*, unnest(range(1, 2 + o_orderkey % 3)) AS n FROM f WHERE ok),
    t AS (SELECT *, CASE WHEN o_custkey % 10 <> 0 THEN lpad(CAST(8 + n * 3 AS STRING), 2, '0') || ':00' END AS opens,
        CASE WHEN n = 3 THEN '02:00' WHEN n = 2 THEN '14:00' ELSE '12:30' END AS closes FROM n)
    SELECT task_id, cust AS restaurant_id, service_type, day_of_week, n AS interval_index, opens AS opens_at_local, closes AS closes_at_local,
    closes <= opens AS crosses_midnight, 'Europe/London' AS timezone, 'menu_manifest' AS source, {sql_time('o_orderdate')} AS fetched_at
    FROM t, (VALUES ('Delivery', 'Monday'), ('Delivery', 'Friday'), ('Collection', 'Sunday')) v(service_type, day_of_week)""",
)
def opening_times(spark, sf_dir):
    tasks, chosen = _fetched(spark, sf_dir)
    rows = jobs.opening_times(tasks, chosen.filter("outcome = 'succeeded'").select("task_id", "fetched_at", "body"))
    return rows.drop("opening_time_id", "run_id", "restaurant_unique_name").withColumn("fetched_at", time_text(F.col("fetched_at")))


@query("menu_pending", f"WITH {_FETCH_SQL} SELECT task_id, cust AS restaurant_id FROM f WHERE NOT ok")
def menu_pending(spark, sf_dir):
    tasks, chosen = _fetched(spark, sf_dir)
    return jobs.menu_pending(tasks, chosen.select("task_id", "outcome")).select("task_id", "restaurant_id")


@query(
    "fetch_availability",
    """WITH l AS (SELECT o_custkey, CASE o_orderkey % 4 WHEN 0 THEN 'manifest' WHEN 1 THEN 'manifest_v2_2' WHEN 2 THEN 'items' ELSE 'item_details' END AS label,
    CASE o_orderstatus WHEN 'F' THEN 404 ELSE 200 END AS status, o_orderdate FROM orders),
    b AS (SELECT o_custkey, label, max_by(status, {'a': o_orderdate, 'b': status}) AS status FROM l GROUP BY ALL)
    SELECT 'outlet-' || CAST(o_custkey AS STRING) AS slug, CAST(max(status) FILTER (label = 'manifest') AS INTEGER) AS manifest, CAST(max(status) FILTER (label = 'manifest_v2_2') AS INTEGER) AS manifest_v2_2,
    CAST(max(status) FILTER (label = 'items') AS INTEGER) AS items, CAST(max(status) FILTER (label = 'item_details') AS INTEGER) AS item_details FROM b GROUP BY o_custkey""",
)
def fetch_availability(spark, sf_dir):
    log = driver_table(spark, sf_dir, "orders").selectExpr(
        "'outlet-' || o_custkey AS slug",
        "CASE o_orderkey % 4 WHEN 0 THEN 'manifest' WHEN 1 THEN 'manifest_v2_2' WHEN 2 THEN 'items' ELSE 'item_details' END AS label",
        "CASE o_orderstatus WHEN 'F' THEN 404 ELSE 200 END AS status",
        "o_orderdate AS finished_at",
    )
    return jobs.fetch_availability(log)


# ---- audits


@query(
    "http_outcomes",
    f"""{DIAGNOSTICS_SQL} SELECT CASE WHEN http_status IN (403, 429) THEN CAST(http_status AS STRING) WHEN http_status >= 500 THEN '5xx' ELSE 'ok' END AS status_class,
    outcome, count(*) AS requests FROM d GROUP BY ALL""",
)
def http_outcomes(spark, sf_dir):
    return audit.http_outcomes(diagnostics(spark, sf_dir))


@query(
    "outcome_windows",
    f"""{DIAGNOSTICS_SQL} SELECT {sql_time("date_trunc('minute', event_time)")} AS window_start,
    CASE WHEN http_status IN (403, 429) THEN CAST(http_status AS STRING) WHEN http_status >= 500 THEN '5xx' ELSE 'ok' END AS status_class,
    count(*) AS requests, count(*) FILTER (http_status = 429) AS too_many FROM d GROUP BY ALL""",
)
def outcome_minutes(spark, sf_dir):
    return outcome_windows(diagnostics(spark, sf_dir)).withColumn("window_start", time_text(F.col("window_start")))


_PERCENTILES = ", ".join(f"round(quantile_cont({{0}}, {q})::DOUBLE, 3) AS {name}" for name, q in audit.PERCENTILES.items())


def _rounded(rows):
    """Interpolated values to three decimals, where both engines print the same."""
    return rows.withColumns({name: F.round(name, 3) for name in audit.PERCENTILES})


@query(
    "latency_percentiles",
    f"{DIAGNOSTICS_SQL} SELECT limiter_key, count(*) AS n, min(latency_ms) AS min, max(latency_ms) AS max, {_PERCENTILES.format('latency_ms')} FROM d GROUP BY ALL",
)
def latency_percentiles(spark, sf_dir):
    return _rounded(audit.latency_percentiles(diagnostics(spark, sf_dir), ["limiter_key"], "latency_ms"))


@query(
    "request_gaps",
    f"""{DIAGNOSTICS_SQL}, g AS (SELECT limiter_key, start_ms - lag(start_ms) OVER (PARTITION BY limiter_key ORDER BY start_ms, diagnostic_id) AS gap FROM d)
    SELECT limiter_key, count(gap) AS n, min(gap) AS min, max(gap) AS max, {_PERCENTILES.format('gap')} FROM g WHERE gap IS NOT NULL GROUP BY ALL""",
)
def request_gaps(spark, sf_dir):
    return _rounded(audit.request_gaps(diagnostics(spark, sf_dir)))


@query(
    "spacing_replay",
    f"""{DIAGNOSTICS_SQL}, a AS (SELECT diagnostic_id, limiter_key, start_ms, row_number() OVER w - 1 AS position FROM d WINDOW w AS (PARTITION BY limiter_key ORDER BY start_ms, diagnostic_id)),
    r AS (SELECT *, max(start_ms + 1000 - position * 1300) OVER (PARTITION BY limiter_key ORDER BY start_ms, diagnostic_id ROWS UNBOUNDED PRECEDING) + position * 1300 AS reserved_ms FROM a)
    SELECT diagnostic_id, limiter_key, start_ms, position, reserved_ms, reserved_ms - start_ms AS wait_ms FROM r""",
)
def spacing_replay(spark, sf_dir):
    arrivals = diagnostics(spark, sf_dir).select("diagnostic_id", "limiter_key", "start_ms")
    return audit.spacing_replay(arrivals, arrival="start_ms")


@query(
    "ban_audit",
    f"""{DIAGNOSTICS_SQL}, b AS (SELECT DISTINCT limiter_key, finish_ms AS at_ms FROM d WHERE http_status = 429),
    tl AS (SELECT limiter_key, start_ms AS at_ms, 0 AS kind, diagnostic_id, NULL AS ban_ms, http_status FROM d UNION ALL SELECT limiter_key, at_ms, 1, NULL, at_ms, 429 FROM b),
    r AS (SELECT *, max(ban_ms) OVER (PARTITION BY limiter_key ORDER BY at_ms, kind ROWS UNBOUNDED PRECEDING) + 3600000 AS until FROM tl)
    SELECT limiter_key, CAST(diagnostic_id AS STRING) AS diagnostic_id, at_ms AS start_ms, http_status, coalesce(at_ms < until, FALSE) AS circuit_open,
    CASE WHEN at_ms < until THEN until END AS ban_until_ms FROM r WHERE kind = 0""",
)
def ban_audit(spark, sf_dir):
    return audit.ban_audit(diagnostics(spark, sf_dir))


@query(
    "in_flight",
    f"""{DIAGNOSTICS_SQL}, s AS (SELECT limiter_key, start_ms AS at_ms, 1 AS step FROM d UNION ALL SELECT limiter_key, finish_ms, -1 FROM d),
    c AS (SELECT limiter_key, at_ms, sum(step) AS step FROM s GROUP BY ALL)
    SELECT limiter_key, at_ms, CAST(sum(step) OVER (PARTITION BY limiter_key ORDER BY at_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS open_requests FROM c""",
)
def in_flight(spark, sf_dir):
    return audit.in_flight(diagnostics(spark, sf_dir))


@query(
    "diagnostics_enriched",
    f"""{DIAGNOSTICS_SQL} SELECT diagnostic_id, {sql_time('event_time + to_milliseconds(1300)')} AS reserved_for, latency_ms // 3 AS queue_delay_ms,
    latency_ms // 2 AS limiter_acquire_ms, latency_ms AS request_ms FROM d""",
)
def diagnostics_enriched(spark, sf_dir):
    d = diagnostics(spark, sf_dir)
    whole = F.timestamp_millis("start_ms")

    def later(shift):
        return F.timestamp_millis(F.col("start_ms") + shift)

    shaped = d.select(
        "diagnostic_id",
        (F.col("start_ms") + 1300).alias("limiter_token_reserved_for_ms"),
        whole.alias("worker_received_at"),
        later(F.expr("latency_ms div 3")).alias("worker_started_at"),
        whole.alias("limiter_acquire_started_at"),
        later(F.expr("latency_ms div 2")).alias("limiter_acquire_finished_at"),
        whole.alias("api_request_started_at"),
        later(F.col("latency_ms")).alias("api_request_finished_at"),
    )
    rows = audit.diagnostics_enriched(shaped)
    return rows.select("diagnostic_id", time_text(F.col("reserved_for")).alias("reserved_for"), "queue_delay_ms", "limiter_acquire_ms", "request_ms")


@query(
    "spillover",
    f"""{cte('snapshots')}, {OBSERVED_SQL}, u AS (SELECT tag, {utc('CAST(local_start AS TIMESTAMP)')} AS opens, {utc('CAST(local_end AS TIMESTAMP)')} AS closes FROM iv),
    s AS (SELECT planned_window, captured_at + to_hours(CAST(CAST(ListingId AS BIGINT) % 24 AS BIGINT)) AS at FROM d_snapshots),
    f AS (SELECT planned_window, EXISTS (SELECT 1 FROM u WHERE u.tag = s.planned_window AND s.at >= u.opens AND s.at < u.closes) AS inside FROM s)
    SELECT planned_window, count(*) AS rows, count(*) FILTER (inside) AS inside, count(*) FILTER (NOT inside) AS outside FROM f GROUP BY ALL""",
)
def spillover(spark, sf_dir):
    snapshots = domain(spark, sf_dir, "snapshots").withColumn(
        "captured_at", F.col("captured_at") + F.expr("make_interval(0, 0, 0, 0, CAST(CAST(ListingId AS BIGINT) % 24 AS INT))")
    )
    intervals = observed_intervals(spark, sf_dir).select(
        "tag", to_utc(wall_time(F.col("local_start"))).alias("opens_at"), to_utc(wall_time(F.col("local_end"))).alias("closes_at")
    )
    return audit.spillover(snapshots, intervals)


@query("duplicate_keys", f"{cte('coverage')} SELECT postcode, restaurant_id, count(*) AS rows FROM d_coverage GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return audit.duplicate_keys(domain(spark, sf_dir, "coverage"), ["postcode", "restaurant_id"])


@query(
    "key_summary",
    f"""{cte('coverage')}, k AS (SELECT count(*) AS n FROM d_coverage GROUP BY postcode, restaurant_id)
    SELECT 'coverage' AS table_name, CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_keys, count(*) FILTER (n > 1) AS repeated_keys,
    CAST(sum(n) - count(*) AS BIGINT) AS surplus_rows FROM k""",
)
def key_summary(spark, sf_dir):
    return audit.key_summary(domain(spark, sf_dir, "coverage"), ["postcode", "restaurant_id"], "coverage")


@query(
    "fk_audit",
    f"""{cte('coverage', 'snapshots', 'profile', 'manifest', 'events', 'tasks')}
    SELECT 'coverage' AS child, 'profile' AS parent, count(*) AS child_rows, count(*) FILTER (restaurant_id NOT IN (SELECT restaurant_id FROM d_profile)) AS orphan_rows, CAST(0 AS BIGINT) AS null_rows FROM d_coverage
    UNION ALL SELECT 'snapshots', 'profile', count(*), count(*) FILTER (ListingId NOT IN (SELECT restaurant_id FROM d_profile)), 0 FROM d_snapshots
    UNION ALL SELECT 'tasks', 'manifest', count(*), count(*) FILTER (job_id NOT IN (SELECT job_id FROM d_manifest)), 0 FROM d_tasks
    UNION ALL SELECT 'manifest', 'events', count(*), count(*) FILTER (job_id NOT IN (SELECT job_id FROM d_events)), 0 FROM d_manifest""",
)
def fk_audit(spark, sf_dir):
    frames = {name: domain(spark, sf_dir, name) for name in ("coverage", "snapshots", "profile", "tasks", "manifest", "events")}
    edges = [
        ("coverage", "restaurant_id", "profile", "restaurant_id"),
        ("snapshots", "ListingId", "profile", "restaurant_id"),
        ("tasks", "job_id", "manifest", "job_id"),
        ("manifest", "job_id", "events", "job_id"),
    ]
    return audit.fk_audit(frames, edges)
