"""Job state out of append-only logs: admission, status, attempts, menu fetch results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.clock import crosses_midnight, window_expired
from catchment.functions.ids import key_of, uuid5
from catchment.functions.rows import open_array
from catchment.functions.text import clean_postcode
from catchment.sources.schemas import MENU_MANIFEST, OPENING_SERVICES, missing_required

# Fixed value: attempts allowed where the manifest names none.
DEFAULT_MAX_ATTEMPTS = 3
# Fields every task must carry.
TASK_FIELDS = ["job_id", "run_id", "provider", "postcode", "planned_window", "scheduled_at"]
MENU_TASK_FIELDS = ["task_id", "run_id", "restaurant_id", "restaurant_unique_name", "scheduled_at"]


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """Newest manifest row per job by `created_at`; equal times fall back to the row content."""
    fields = ["run_id", "provider", "postcode", "planned_window", "scheduled_at", "max_attempts"]
    newest = manifest.groupBy("job_id").agg(
        F.max_by(F.struct(*fields), F.struct("created_at", *fields)).alias("row")
    )
    return newest.select(
        "job_id",
        *[F.col(f"row.{name}") for name in fields[:-1]],
        F.coalesce("row.max_attempts", F.lit(DEFAULT_MAX_ATTEMPTS).cast("long")).alias("max_attempts"),
    )


def latest_success(events: DataFrame) -> DataFrame:
    """Newest succeeded event per job."""
    fields = ["event_time", "raw_uri", "processed_rows"]
    newest = (
        events.filter(F.col("event_type") == "succeeded")
        .groupBy("job_id")
        .agg(F.max(F.struct(*fields)).alias("row"))
    )
    return newest.select("job_id", "row.*")


def job_attempts(events: DataFrame) -> DataFrame:
    """Started events per job."""
    return (
        events.filter(F.col("event_type") == "started").groupBy("job_id").agg(F.count(F.lit(1)).alias("attempts"))
    )


def event_facts(events: DataFrame) -> DataFrame:
    """Per job: attempts and whether it ever succeeded, in one grouping."""
    wanted = events.filter(F.col("event_type").isin("started", "succeeded"))
    return wanted.groupBy("job_id").agg(
        F.count_if(F.col("event_type") == "started").alias("attempts"),
        F.bool_or(F.col("event_type") == "succeeded").alias("has_succeeded"),
    )


def job_status(events: DataFrame) -> DataFrame:
    """Current status per job: success is final, otherwise the newest event decides."""
    newest = F.max(F.struct("event_time", "event_id", "event_type"))
    folded = events.groupBy("job_id").agg(
        F.bool_or(F.col("event_type") == "succeeded").alias("won"),
        newest.alias("last"),
        F.count_if(F.col("event_type") == "started").alias("attempts"),
        F.count(F.lit(1)).alias("events"),
    )
    return folded.select(
        "job_id",
        F.when(F.col("won"), "succeeded").otherwise(F.col("last.event_type")).alias("status"),
        "attempts",
        "events",
        F.col("last.event_time").alias("last_event_time"),
    )


def identity_mismatches(expected: dict[str, Column], actual: dict[str, Column]) -> Column:
    """Names of the fields that differ, in the order given; compared as text, a missing value reading 'None'."""
    flags = []
    for name, wanted in expected.items():
        left, right = wanted.cast("string"), actual[name].cast("string")
        if name == "postcode":
            left, right = clean_postcode(left), clean_postcode(right)
            missing = "none"
        else:
            missing = "None"
        differs = F.coalesce(left, F.lit(missing)) != F.coalesce(right, F.lit(missing))
        flags.append(F.when(differs, F.lit(name)))
    return F.array_compact(F.array(*flags))


def admission(tasks: DataFrame, manifest: DataFrame, events: DataFrame, bans: DataFrame, now: Column | None = None) -> DataFrame:
    """Decide per task row whether its job may run; the first rule that applies wins.

    `tasks` may carry `now` and `limiter_key` columns; `bans` holds (limiter_key, ban_until). Adds `decision`,
    `status_code` and `message`. Only the history of the tasks' own jobs is folded.
    """
    asked = tasks.select("job_id").distinct()
    manifest, events = (history.join(asked, "job_id", "left_semi") for history in (manifest, events))
    fields = ["run_id", "provider", "postcode", "planned_window"]
    checked = missing_required(tasks, TASK_FIELDS)
    known = latest_manifest(manifest).select(
        F.col("job_id"), *[F.col(name).alias(f"m_{name}") for name in fields], F.col("max_attempts"), F.lit(True).alias("in_manifest")
    )
    open_bans = bans.groupBy("limiter_key").agg(F.max("ban_until").alias("ban_until"))
    # Both fact tables have one row per job; joined first, they leave the tasks, which may repeat a job, one join to split.
    facts = known.join(event_facts(events), "job_id", "full")
    joined = checked.join(facts, "job_id", "left").join(open_bans, "limiter_key", "left")
    mismatches = identity_mismatches(
        {name: F.col(f"m_{name}") for name in fields}, {name: F.col(name) for name in fields}
    )
    clock = now if now is not None else F.col("now")
    rules = [
        (F.col("missing_fields").isNotNull(), "missing_fields", 400, F.concat(F.lit("Missing fields: "), F.col("missing_fields"))),
        (F.col("in_manifest").isNull(), "rejected", 404, F.lit("Job is not in job_manifest")),
        (
            F.size("mismatches") > 0,
            "rejected",
            409,
            F.concat(F.lit("Task payload does not match job_manifest: "), F.array_join("mismatches", ", ")),
        ),
        (F.coalesce("has_succeeded", F.lit(False)), "already_succeeded", 200, F.lit(None).cast("string")),
        (F.coalesce("attempts", F.lit(0)) >= F.col("max_attempts"), "max_attempts_reached", 200, F.lit("Max attempts reached")),
        (
            window_expired(F.col("window_end_at"), clock),
            "window_expired",
            200,
            F.concat(F.lit("Observation window ended at "), F.date_format("window_end_at", "yyyy-MM-dd'T'HH:mm:ssxxx")),
        ),
        (F.coalesce(F.col("ban_until") > clock, F.lit(False)), "deferred", 503, F.lit("Ban circuit active")),
    ]
    decision, code, message = F.lit("run"), F.lit(200), F.lit(None).cast("string")
    for hit, name, status, text in reversed(rules):
        decision = F.when(hit, name).otherwise(decision)
        code = F.when(hit, status).otherwise(code)
        message = F.when(hit, text).otherwise(message)
    return joined.withColumn("mismatches", mismatches).select(
        *tasks.columns,
        F.coalesce("attempts", F.lit(0).cast("long")).alias("attempts"),
        decision.alias("decision"),
        code.alias("status_code"),
        message.alias("message"),
    )


def menu_pending(tasks: DataFrame, results: DataFrame) -> DataFrame:
    """Menu tasks that have no succeeded result yet."""
    done = results.filter(F.col("outcome") == "succeeded").select("task_id").distinct()
    return tasks.join(done, "task_id", "left_anti")


# Where a manifest is looked for, in this order.
MANIFEST_SOURCES = ("original", "v2_2")


def manifest_attempts(attempts: DataFrame) -> DataFrame:
    """Per task, the fetch that counts out of a saved attempt log (task_id, source, url, status, ..., body).

    The first source with a good response wins; the trail names the failed sources before it. A task without a good
    response keeps the last source. One grouping with a slot per source: nothing is gathered per task.
    """
    ok = (F.col("status") == 200) & F.col("body").isNotNull()
    is_good = F.coalesce(ok, F.lit(False))
    row = F.struct("source", "url", "status", "latency_ms", "finished_at")
    # The bodies have slots of their own, which a job that doesn't ask for them never fills; failed ones are of no use.
    slots = [
        F.max_by(value, F.when(F.col("source") == source, F.struct(is_good, "finished_at", "url"))).alias(name)
        for source in MANIFEST_SOURCES
        for name, value in ((source, F.struct(is_good.alias("ok"), row.alias("row"))), (f"{source}_body", F.when(is_good, F.col("body"))))
    ]
    folded = attempts.filter(F.col("source").isin(list(MANIFEST_SOURCES))).groupBy("task_id").agg(*slots)
    won, good, body, trail = F.lit(False), F.lit(None), F.lit(None), []
    for source in MANIFEST_SOURCES:
        slot = F.col(source)
        status = F.coalesce(slot["row"]["status"].cast("string"), F.lit("error"))
        trail.append(F.when(~won & ~slot["ok"], F.concat(F.lit(f"{source}:"), status)))
        good = F.when(~won & slot["ok"], slot["row"]).otherwise(good)
        body = F.when(~won & slot["ok"], F.col(f"{source}_body")).otherwise(body)
        won = won | F.coalesce(slot["ok"], F.lit(False))
    last = F.coalesce(*[F.col(source)["row"] for source in reversed(MANIFEST_SOURCES)])
    shown = folded.select(
        "task_id",
        won.alias("won"),
        F.when(won, good).otherwise(last).alias("chosen"),
        F.when(won, body).alias("body"),
        F.array_join(F.array_compact(F.array(*trail)), "; ").alias("attempt_errors"),
    )
    return shown.select(
        "task_id",
        F.when(F.col("won"), F.col("chosen.source")).alias("manifest_source"),
        F.col("chosen.url").alias("manifest_url"),
        F.col("chosen.status").cast("long").alias("http_status"),
        F.col("chosen.latency_ms").cast("long").alias("latency_ms"),
        F.when(F.col("won"), F.col("chosen.source") != MANIFEST_SOURCES[0]).otherwise(F.lit(True)).alias("fallback_used"),
        F.col("chosen.finished_at").alias("fetched_at"),
        F.when(F.col("won"), "succeeded").otherwise("failed").alias("outcome"),
        "attempt_errors",
        "body",
    )


def manifest_results(tasks: DataFrame, chosen: DataFrame) -> DataFrame:
    """Menu result rows: task identity, fetch facts and counts out of the manifest document."""
    doc = F.from_json("body", MENU_MANIFEST)
    joined = tasks.join(chosen, "task_id").withColumn("doc", doc)
    info = F.col("doc.RestaurantInfo")
    services = F.coalesce(info["RestaurantOpeningTimes"], F.array().cast(OPENING_SERVICES))
    counts = F.transform(
        services,
        lambda service: F.aggregate(
            F.coalesce(F.transform(service["TimesPerDay"], lambda day: F.coalesce(F.size(day["Times"]), F.lit(0))), F.array().cast("array<int>")),
            F.lit(0),
            lambda total, one: total + F.greatest(one, F.lit(0)),
        ),
    )
    types = F.array_sort(F.array_distinct(F.filter(services["ServiceType"], lambda kind: kind != "")))
    failed = F.col("outcome") == "failed"
    cause = F.when(
        F.col("http_status").isNotNull(), F.concat(F.lit("Menu manifest returned HTTP "), F.col("http_status"), F.lit(": "))
    ).otherwise(F.lit("Menu manifest request failed: "))
    message = F.concat(cause, F.coalesce("manifest_url", F.lit("")), F.lit(" | attempts="), F.col("attempt_errors"))
    return joined.select(
        uuid5(key_of(F.lit("menu-result"), F.col("task_id"), F.col("fetched_at"))).alias("result_id"),
        "task_id",
        "run_id",
        F.col("restaurant_id").cast("string").alias("restaurant_id"),
        "restaurant_name",
        F.btrim("restaurant_unique_name").alias("restaurant_unique_name"),
        "restaurant_url",
        "cuisine_names",
        "fetched_at",
        "manifest_source",
        "manifest_url",
        "http_status",
        "latency_ms",
        "fallback_used",
        F.col("doc.RestaurantId").alias("manifest_restaurant_id"),
        info["Name"].alias("manifest_name"),
        info["TimeZone"].alias("timezone"),
        info["IsOffline"].alias("is_offline"),
        F.greatest(F.coalesce(F.size("doc.Menus"), F.lit(0)), F.lit(0)).cast("long").alias("menu_count"),
        F.col("doc.ItemsUrl").alias("items_url"),
        F.col("doc.ItemDetailsUrl").alias("item_details_url"),
        F.aggregate(counts, F.lit(0), lambda total, one: total + one).cast("long").alias("opening_time_count"),
        F.nullif(F.array_join(types, "|"), F.lit("")).alias("opening_service_types"),
        "outcome",
        F.when(failed, message).alias("error"),
    )


def opening_times(tasks: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row per service, day and interval; an overnight interval stays on its own day.

    `manifests` holds (task_id, fetched_at, body).
    """
    joined = tasks.select("task_id", "run_id", "restaurant_id", "restaurant_unique_name").join(
        manifests.select("task_id", "fetched_at", F.from_json("body", MENU_MANIFEST).alias("doc")), "task_id"
    )
    head = ["task_id", "run_id", "restaurant_id", "restaurant_unique_name", "fetched_at"]
    zone = F.col("doc.RestaurantInfo.TimeZone").alias("timezone")
    services = open_array(joined, [*head, zone], "doc.RestaurantInfo.RestaurantOpeningTimes", "service", "service_at")
    days = open_array(services, ["*"], "service.TimesPerDay", "day", "day_at")
    times = open_array(days, ["*"], "day.Times", "time", "time_at")
    opens, closes = F.col("time.FromLocalTime"), F.col("time.ToLocalTime")
    return times.select(
        uuid5(key_of(F.lit("opening-time"), F.col("task_id"), F.col("fetched_at"), F.col("service_at"), F.col("day_at"), F.col("time_at"))).alias("opening_time_id"),
        "task_id",
        "run_id",
        F.col("restaurant_id").cast("string").alias("restaurant_id"),
        "restaurant_unique_name",
        F.col("service.ServiceType").alias("service_type"),
        F.col("day.DayOfWeek").alias("day_of_week"),
        (F.col("time_at") + 1).cast("long").alias("interval_index"),
        opens.alias("opens_at_local"),
        closes.alias("closes_at_local"),
        crosses_midnight(opens, closes).alias("crosses_midnight"),
        "timezone",
        F.lit("menu_manifest").alias("source"),
        "fetched_at",
    )


def fetch_availability(responses: DataFrame, labels: tuple[str, ...] = ("manifest", "manifest_v2_2", "items", "item_details")) -> DataFrame:
    """Status per known document of a slug out of a saved response log (slug, label, status, finished_at)."""
    return (
        responses.groupBy("slug")
        .pivot("label", list(labels))
        .agg(F.max_by("status", F.struct("finished_at", "status")))
    )
