"""The whole jobs a user runs: each reads tables or folders, and writes tables or returns frames.

With `dry_run` a job writes nothing and returns what it would have written.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.functions.brands import DEFAULT_RULES, BrandRules
from catchment.operators import grocery, jobs, listing, menu, planning
from catchment.operators.planning import Run
from catchment.session import pin
from catchment.sources import readers, writers
from catchment.sources.schemas import COVERAGE, PROFILE, conform_to_schema

#: Folders that one backfill by events reads; their names are collected.
MOST_FOLDERS = 10_000


@dataclass(frozen=True)
class WindowChoice:
    """How the collection windows are given; at most one of the three groups, each complete, else the weekly rules."""

    weeks: int = 2
    start_date: str | None = None
    custom_start: str | None = None
    custom_end: str | None = None
    daily_start_date: str | None = None
    daily_days: int | None = None
    daily_start_time: str | None = None
    daily_end_time: str | None = None
    intervals: str | dict | None = None


def choose_windows(spark: SparkSession, names: list[str], choice: WindowChoice) -> DataFrame:
    """Interval rows for the names, checked for unknown and empty windows."""
    custom = (choice.custom_start, choice.custom_end)
    daily = (choice.daily_start_date, choice.daily_days, choice.daily_start_time, choice.daily_end_time)
    for group, label in ((custom, "custom"), (daily, "daily")):
        if any(group) and not all(group):
            raise ValueError(f"give all of the {label} window settings or none")
    if sum((any(custom), any(daily), choice.intervals is not None)) > 1:
        raise ValueError("use custom, daily or explicit windows, not more than one")
    if choice.intervals is not None:
        found = planning.explicit_windows(spark, choice.intervals, names)
    elif any(daily):
        found = planning.daily_windows(spark, names, *daily)
    elif any(custom):
        found = planning.custom_windows(spark, names, *custom)
    else:
        if choice.start_date is None:
            raise ValueError("give a start date for the weekly windows")
        found = planning.calendar_windows(spark, choice.weeks, choice.start_date)
    planning.check_windows(found, names)
    return found.filter(F.col("tag").isin(names))


def plan_collection(
    spark: SparkSession,
    postcodes: DataFrame,
    names: list[str],
    run: Run,
    choice: WindowChoice | None = None,
    manifest_path: str | None = None,
    schedule_now: bool = False,
    skip_existing: bool = False,
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Task rows and new manifest rows of a run; appends the manifest rows. `postcodes` holds (ordinal, postcode)."""
    intervals = choose_windows(spark, names, choice or WindowChoice())
    timed = None if schedule_now else intervals
    manifest = writers.read_table(spark, manifest_path, "job_manifest", runs=[run.run_id]) if manifest_path else None
    if skip_existing and manifest is not None:
        tasks = planning.plan_resume(postcodes, names, timed, run, manifest)
    else:
        tasks = planning.plan_jobs(postcodes, names, timed, run)
    rows = planning.manifest_rows(tasks, run)
    if manifest is not None:
        rows = planning.new_manifest_rows(rows, manifest, run.run_id)
    if manifest_path and not dry_run:
        # The manifest is read and appended to, so the new rows are fixed first.
        rows = pin(rows)
        writers.append_rows(rows, manifest_path, "job_manifest")
    return tasks, rows


def plan_menus(spark: SparkSession, profile: DataFrame, run_id: str, now: str, seed: str, limit: int | None = None, out: str | None = None) -> DataFrame:
    """Menu tasks of the outlets in seeded order; with a limit, of the first ones."""
    tasks = planning.menu_tasks(planning.seeded_sample(profile, seed, limit), run_id, now)
    if out:
        writers.append_rows(tasks, out, "menu_manifest_tasks")
    return tasks


def backfill(
    spark: SparkSession,
    snapshot_label: str,
    raw_paths: str | list[str] | None = None,
    events: DataFrame | None = None,
    limit_raw_files: int | None = None,
    coverage_path: str | None = None,
    profile_path: str | None = None,
    existing_profiles: DataFrame | None = None,
    dry_run: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Coverage rows, new profiles and counters out of raw documents, given by path or by their succeeded events.

    The documents are parsed once into a pinned table of outlets that both outputs read.
    """
    if (raw_paths is None) == (events is None):
        raise ValueError("give either raw paths or events")
    named = None if events is None else readers.succeeded_uris(events, limit_raw_files)
    lines = readers.raw_lines(spark, raw_paths or _folders(named))
    if named is not None:
        # Unwanted files leave as plain text, before anything is parsed.
        wanted = named.groupBy(_address(F.col("raw_uri")).alias("address")).agg(F.max("event_time").alias("event_time"))
        lines = lines.withColumn("address", _address(F.col("raw_uri"))).join(wanted, "address").drop("address")
    # The last seen wins: by the time of the event that named the file, or by the document's own.
    arrival = "captured_at" if events is None else "event_time"
    keep = ("raw_uri",) if events is None else ("raw_uri", "event_time")
    reads = {*listing.COVERAGE_READS, *listing.PROFILE_READS}
    raw = pin(readers.parse_envelopes(lines, keep=keep, reads=reads).select("raw_uri", "postcode", arrival, "response"))
    known = existing_profiles if existing_profiles is not None else spark.createDataFrame([], "restaurant_id string")
    coverage = conform_to_schema(listing.coverage_rows(raw, snapshot_label), COVERAGE)
    profiles = conform_to_schema(listing.new_profiles(listing.profile_rows(raw, (arrival, "raw_uri")), known), PROFILE)
    if not dry_run:
        if coverage_path:
            writers.append_rows(coverage, coverage_path, "postcode_restaurant_delivery_map")
        if profile_path:
            writers.append_rows(profiles, profile_path, "restaurant_profile")
    return coverage, profiles, listing.backfill_stats(raw, known)


def _address(uri: Column) -> Column:
    """Local files are written with one or three slashes."""
    return F.regexp_replace(uri, "^file:/+", "file:/")


def _folders(named: DataFrame, most: int = MOST_FOLDERS) -> list[str]:
    """The window folders of the named files; a run has few of them, however many files they hold."""
    folders = named.select(F.regexp_extract("raw_uri", r"^(.*)/[^/]*$", 1).alias("folder")).distinct()
    found = [row.folder for row in folders.limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"the events name files in more than {most} folders; backfill them in parts")
    return found


def collect_snapshots(spark: SparkSession, raw_paths: str | list[str], out: str) -> None:
    """Raw documents to observed availability, appended."""
    rows = listing.open_now(readers.read_raw_listings(spark, raw_paths, listing.OPEN_READS))
    timed = rows.withColumns({name: F.to_timestamp(name) for name in ("scheduled_at", "captured_at")})
    writers.append_rows(timed, out, "restaurant_snapshots")


def export_grocery(
    coverage: DataFrame,
    snapshots: DataFrame,
    profile: DataFrame,
    geography: DataFrame,
    intervals: DataFrame,
    out: str | None = None,
    id_column: str = "ListingId",
    rules: BrandRules = DEFAULT_RULES,
) -> DataFrame:
    """Grocery availability per area, postcode and source key; checks the static label first, writes sorted CSV."""
    grocery.static_label(coverage).collect()
    keys = grocery.source_keys(intervals)
    tags = [row.source_tag for row in keys.filter(F.col("source_dataset") == grocery.TEMPORAL).collect()]
    aggregates = grocery.grocery_availability(coverage, snapshots, profile, tags, id_column, rules)
    grid = grocery.grocery_grid(geography, keys, aggregates, rules)
    if out:
        writers.write_csv(grid.orderBy("source_dataset", "source_tag", "postcode", "geo_code"), out)
    return grid


def export_postcodes(lists: Iterable[DataFrame], out: str) -> None:
    """Distinct clean postcodes of several lists, sorted, as CSV."""
    writers.write_csv(readers.combine_postcodes(*lists).orderBy("postcode"), out)


def record_menus(tasks: DataFrame, attempts: DataFrame, results_path: str, opening_path: str) -> None:
    """Result rows of all fetched menu tasks and opening times of the succeeded ones, appended."""
    chosen = pin(jobs.manifest_attempts(attempts))
    writers.append_rows(jobs.manifest_results(tasks, chosen), results_path, "menu_manifest_results")
    writers.append_rows(jobs.opening_times(tasks, chosen.filter("outcome = 'succeeded'")), opening_path, "restaurant_opening_times")


def export_menus(pages: DataFrame, documents: DataFrame, out: str) -> list[str]:
    """Menu tables of saved pages as CSV, each only when it has rows; returns the names written."""
    state = pin(menu.attach_documents(menu.page_state(pages), documents))
    written = []
    for name, build in (("summary", menu.menu_summary), ("items", menu.menu_items), ("modifiers", menu.menu_modifiers), ("deals", menu.menu_deals)):
        rows = pin(build(state))
        if not rows.isEmpty():
            writers.write_csv(rows, f"{out}/{name}")
            written.append(name)
    return written
