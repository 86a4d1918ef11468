import gzip
import json

import pytest
from pyspark.sql import functions as F
from test_listing import RESTAURANTS, envelope
from test_menu import DETAILS, ITEMS, STATE
from test_planning import JUNE, RUN, postcodes

from catchment import workflows
from catchment.operators import planning
from catchment.sources import readers, writers
from catchment.workflows import WindowChoice


@pytest.mark.parametrize(
    "settings, message",
    [
        ({"custom_start": "2026-06-17T14:00:00"}, "custom"),
        ({"daily_start_date": "2026-06-17", "daily_days": 1}, "daily"),
        ({"intervals": JUNE, "custom_start": "2026-06-17T14:00:00", "custom_end": "2026-06-17T15:00:00"}, "not more than one"),
        ({}, "start date"),
        ({"start_date": "2026-06-15"}, "Unknown or empty windows: weekday_afternoon"),
    ],
)
def test_window_choices_are_checked(spark, settings, message):
    with pytest.raises(ValueError, match=message):
        workflows.choose_windows(spark, ["weekday_afternoon"], WindowChoice(**settings))


def test_plan_collection_appends_once(spark, tmp_path):
    path, names = str(tmp_path / "manifest"), ["weekday_afternoon", "saturday_peak"]
    choice = WindowChoice(intervals=JUNE)
    codes = postcodes(spark, "a", "b", "c")
    first = planning.manifest_rows(planning.plan_jobs(codes.filter("postcode = 'a'"), names, workflows.choose_windows(spark, names, choice), RUN), RUN)
    writers.append_rows(first, path, "job_manifest")
    tasks, rows = workflows.plan_collection(spark, codes, names, RUN, choice, path, dry_run=True)
    assert (tasks.count(), rows.count()) == (6, 4)
    tasks, rows = workflows.plan_collection(spark, codes, names, RUN, choice, path, skip_existing=True)
    assert (tasks.count(), rows.count()) == (4, 4)
    stored = writers.read_table(spark, path, "job_manifest")
    assert stored.count() == 6 and stored.select("job_id").distinct().count() == 6
    _, again = workflows.plan_collection(spark, codes, names, RUN, choice, path, skip_existing=True)
    assert again.count() == 0
    daily = workflows.choose_windows(spark, ["x"], WindowChoice(daily_start_date="2026-06-17", daily_days=2, daily_start_time="09:00", daily_end_time="10:00"))
    assert daily.count() == 2


def test_backfill(spark, tmp_path, rows):
    folder = tmp_path / "raw"
    folder.mkdir()
    for at in range(3):
        (folder / f"{at}.json.gz").write_bytes(gzip.compress(json.dumps(envelope(RESTAURANTS, f"j{at}")).encode()))
    paths = [str(tmp_path / name) for name in ("coverage", "profile")]
    coverage, profiles, stats = workflows.backfill(spark, "label", str(folder), coverage_path=paths[0], profile_path=paths[1])
    assert rows(stats)[0]["map_rows"] == 12 and coverage.count() == 12 and profiles.count() == 4
    known = writers.read_table(spark, paths[1], "restaurant_profile")
    assert known.count() == 4 and writers.read_table(spark, paths[0], "postcode_restaurant_delivery_map").count() == 12
    events = spark.createDataFrame([("succeeded", (folder / f"{at}.json.gz").as_uri(), at) for at in range(2)] + [("failed", None, 3)], "event_type string, raw_uri string, event_time int")
    coverage, profiles, stats = workflows.backfill(spark, "label", events=events, existing_profiles=known, dry_run=True)
    assert coverage.count() == 8 and profiles.count() == 0 and rows(stats)[0]["profiles_existing"] == 4
    some, _, _ = workflows.backfill(spark, "label", events=events, limit_raw_files=1, dry_run=True)
    assert some.count() == 4
    with pytest.raises(ValueError, match="more than 0 folders"):
        workflows._folders(events, 0)
    with pytest.raises(ValueError, match="either"):
        workflows.backfill(spark, "label")
    out = str(tmp_path / "snapshots")
    workflows.collect_snapshots(spark, str(folder), out)
    assert writers.read_table(spark, out, "restaurant_snapshots").count() == 3


def test_exports(spark, tmp_path):
    coverage = spark.createDataFrame([("l", "a", "1", True)], "snapshot_label string, postcode string, restaurant_id string, is_delivery boolean")
    snapshots = spark.createDataFrame([("saturday_peak", "a", "1")], "planned_window string, postcode string, ListingId string")
    profile = spark.createDataFrame([("1", "Coop", None)], "restaurant_id string, restaurant_name string, cuisine_names string")
    geography = spark.createDataFrame([("a", "E1", "lsoa"), ("b", "E2", "lsoa")], "postcode string, geo_code string, geo_type string")
    out = str(tmp_path / "grocery")
    grid = workflows.export_grocery(coverage, snapshots, profile, geography, readers.read_window_config(spark, JUNE), out)
    assert grid.count() == 6
    lines = [line for path in sorted((tmp_path / "grocery").glob("*.csv")) for line in path.read_text(encoding="utf-8").splitlines() if not line.startswith("﻿")]
    assert lines[0].startswith("a,E1,lsoa,static_map,full_coverage,,,1,1,0,yes,no") and len(lines) == 6
    workflows.export_postcodes([spark.createDataFrame([("B 1",), ("a1",)], "postcode string")], str(tmp_path / "codes"))
    text = "".join(path.read_text(encoding="utf-8") for path in sorted((tmp_path / "codes").glob("*.csv")))
    assert [line for line in text.splitlines() if "postcode" not in line] == ["a1", "b1"]


def test_menu_exports(spark, tmp_path):
    html = f'<script id="__NEXT_DATA__">{json.dumps(STATE)}</script>'
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    whole = spark.createDataFrame([(1, json.dumps(ITEMS), json.dumps(DETAILS))], "page_id int, items_json string, details_json string")
    assert workflows.export_menus(pages, whole, str(tmp_path / "menu")) == ["summary", "items", "modifiers", "deals"]
    bare = spark.createDataFrame([(1, "{}", "{}")], "page_id int, items_json string, details_json string")
    assert workflows.export_menus(pages, bare, str(tmp_path / "bare")) == ["summary", "items"]


def test_menu_records(spark, tmp_path):
    from test_jobs import menu_inputs

    tasks, log = menu_inputs(spark)
    log = log.withColumn("finished_at", F.timestamp_seconds("finished_at"))
    results, opening = str(tmp_path / "results"), str(tmp_path / "opening")
    workflows.record_menus(tasks, log, results, opening)
    assert writers.read_table(spark, results, "menu_manifest_results").count() == 3
    assert writers.read_table(spark, opening, "restaurant_opening_times").count() == 3
    profile = spark.createDataFrame([("1", "n", "slug", None, None)], "restaurant_id string, restaurant_name string, restaurant_unique_name string, restaurant_url string, cuisine_names string")
    assert workflows.plan_menus(spark, profile, "r", "2026-06-01T00:00:00+00:00", "s", out=str(tmp_path / "tasks")).count() == 1
