import bisect
import itertools
from datetime import datetime, timedelta
from zoneinfo import ZoneInfo

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catchment.operators import planning
from catchment.operators.planning import Run
from catchment.sources import readers

LONDON, UTC = ZoneInfo("Europe/London"), ZoneInfo("UTC")
RUN = Run("run-1", "listing", "2026-06-01T00:00:00+00:00")

JUNE = {
    "weekday_afternoon": [["2026-06-17T14:00:00", "2026-06-17T18:00:00"], ["2026-06-18T14:00:00", "2026-06-18T18:00:00"]],
    "saturday_peak": [["2026-06-20T14:00:00", "2026-06-20T22:00:00"]],
}


def twin(intervals, count):
    """Where each job falls on the joined-up intervals, by bisection on their cumulative lengths in seconds, as doubles."""
    bounds = [tuple(map(datetime.fromisoformat, pair)) for pair in intervals]
    ends = list(itertools.accumulate(int((close - open_).total_seconds()) - 60 for open_, close in bounds))
    made = []
    for job in range(count):
        place = job * (ends[-1] / count)
        at = bisect.bisect_right(ends, place)
        start = bounds[at][0] + timedelta(seconds=place - (ends[at - 1] if at else 0))
        made.append(tuple(moment.replace(tzinfo=LONDON, microsecond=0).astimezone(UTC) for moment in (start, bounds[at][1])))
    return made


def planned(spark, config, counts):
    jobs = None
    for tag, count in counts.items():
        part = spark.range(count).select(F.lit(tag).alias("planned_window"), F.col("id").alias("ordinal"))
        jobs = part if jobs is None else jobs.unionByName(part)
    frame = planning.schedule(jobs, readers.read_window_config(spark, config))
    found = frame.select("planned_window", "ordinal", F.unix_seconds("scheduled_at").alias("s"), F.unix_seconds("window_end_at").alias("e")).collect()
    return {(row.planned_window, row.ordinal): (row.s, row.e) for row in found}


def check(spark, config, counts):
    found = planned(spark, config, counts)
    assert len(found) == sum(counts.values())
    for tag, count in counts.items():
        for at, (start, end) in enumerate(twin(config[tag], count) if count else []):
            assert found[tag, at] == (int(start.timestamp()), int(end.timestamp())), (tag, count, at)


def test_schedule_is_even_ordered_and_guarded(spark):
    config = {"lunch": [["2026-03-03T11:00:00", "2026-03-03T12:30:00"], ["2026-03-05T11:00:00", "2026-03-05T13:00:00"], ["2026-03-06T10:00:00", "2026-03-06T10:20:00"]]}
    found = planned(spark, config, {"lunch": 45})
    times = [found["lunch", at] for at in range(45)]
    assert times == sorted(times) and all(start + 60 <= end for start, end in times)
    gaps = {later[0] - sooner[0] for sooner, later in zip(times, times[1:], strict=False) if later[1] == sooner[1]}
    assert max(gaps) - min(gaps) <= 1
    check(spark, config, {"lunch": 45})
    check(spark, JUNE, {"weekday_afternoon": 37, "saturday_peak": 1})


def test_boundary_counts_and_large_counts(spark):
    two = [["2026-06-17T14:00:00", "2026-06-17T22:00:00"], ["2026-06-18T14:00:00", "2026-06-18T22:00:00"]]
    four = [[f"2026-06-{day}T14:00:00", f"2026-06-{day}T18:00:00"] for day in (17, 18, 24, 25)]
    check(spark, {"a": two, "b": four, "c": two}, {"a": 14, "b": 174, "c": 3})
    check(spark, {"a": two, "b": four}, {"a": 50_000, "b": 1})


def test_schedule_over_clock_changes(spark):
    config = {
        "autumn": [["2026-10-25T00:30:00", "2026-10-25T04:00:00"], ["2026-10-26T00:30:00", "2026-10-26T04:00:00"]],
        "spring": [["2026-03-29T00:00:00", "2026-03-29T04:00:00"]],
    }
    check(spark, config, {"autumn": 37, "spring": 11})


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(2, 900), st.integers(1, 60)), min_size=1, max_size=4), st.integers(1, 400))
def test_schedule_matches_the_walk(spark, spans, count):
    day, intervals = datetime(2026, 7, 1), []
    for at, (minutes, start) in enumerate(spans):
        opens = day + timedelta(days=at, minutes=start)
        intervals.append([opens.isoformat(), (opens + timedelta(minutes=minutes)).isoformat()])
    check(spark, {"t": intervals}, {"t": count})


def test_no_jobs_and_bad_intervals(spark):
    assert planned(spark, JUNE, {"weekday_afternoon": 0}) == {}
    with pytest.raises(Exception, match="longer than the end guard"):
        planned(spark, {"t": [["2026-06-17T14:00:00", "2026-06-17T14:01:00"]]}, {"t": 2})
    with pytest.raises(ValueError, match="No intervals for windows: x"):
        planning.schedule(spark.range(1).select(F.lit("x").alias("planned_window"), F.col("id").alias("ordinal")), readers.read_window_config(spark, JUNE))


@pytest.mark.parametrize(
    "config, tags, message",
    [
        ("[1]", None, "JSON object"),
        ({"a": []}, None, "no intervals configured"),
        (JUNE, ["missing"], "no intervals configured for window: missing"),
        ({"a": [["2026-06-17T14:00:00"]]}, None, "local_start, local_end"),
        ({"a": [["2026-06-17T14:00:00", ""]]}, None, "local_start, local_end"),
        ({"a": [["2026-06-17T14:00:00", "2026-06-17T13:00:00"]]}, None, "must end after"),
    ],
)
def test_bad_window_settings_raise(spark, config, tags, message):
    with pytest.raises(Exception, match=message):
        readers.read_window_config(spark, config, tags).collect()


def test_window_settings(spark, rows, tmp_path):
    path = tmp_path / "w.json"
    path.write_text('{"a": [["2026-06-17T14:00:00", "2026-06-17T18:00:00"],\n ["2026-06-18T13:00:00Z", "2026-06-18T17:00:00+00:00"]]}')
    found = rows(readers.read_window_config(spark, str(path), ["a"]), "ordinal")
    assert [(row["local_start"], row["local_end"]) for row in found] == [("2026-06-17T14:00:00", "2026-06-17T18:00:00"), ("2026-06-18T14:00:00", "2026-06-18T18:00:00")]


def test_calendar_daily_and_custom_windows(spark, rows):
    found = rows(planning.calendar_windows(spark, 1, "2026-06-15"), "tag", "local_start")
    assert len(found) == 3 + 3 + 2 + 3
    assert [row["local_start"] for row in found if row["tag"] == "weekend_evening"] == [f"2026-06-{day}T17:00:00" for day in (19, 20, 21)]
    assert planning.calendar_windows(spark, 0, "2026-06-16").count() == 2
    daily = rows(planning.daily_windows(spark, ["a", "b"], "2026-06-30", 2, "09:15:30", "10:00"), "tag", "local_start")
    assert [(row["tag"], row["local_start"]) for row in daily] == [("a", "2026-06-30T09:15:00"), ("a", "2026-07-01T09:15:00"), ("b", "2026-06-30T09:15:00"), ("b", "2026-07-01T09:15:00")]
    for bad in (("2026-06-30", 0, "09:00", "10:00"), ("2026-06-30", 1, "10:00", "10:00"), ("2026-06-30", 1, "09:00+01:00", "10:00")):
        with pytest.raises(ValueError):
            planning.daily_windows(spark, ["a"], *bad)
    custom = rows(planning.custom_windows(spark, ["a", "b"], "2026-06-17T14:00:00", "2026-06-17T18:00:00"))
    assert {row["tag"] for row in custom} == {"a", "b"}
    with pytest.raises(ValueError, match="Unknown or empty windows: z"):
        planning.check_windows(planning.custom_windows(spark, ["a"], "2026-06-17T14:00:00", "2026-06-17T18:00:00"), ["a", "z"])


def postcodes(spark, *names):
    return spark.createDataFrame(list(enumerate(names)), "ordinal bigint, postcode string")


def test_tasks_and_manifest(spark, rows):
    intervals = readers.read_window_config(spark, JUNE, ["weekday_afternoon"])
    tasks = planning.plan_jobs(postcodes(spark, "aa11aa"), ["weekday_afternoon"], intervals, RUN)
    task = rows(tasks.withColumn("window_end_at", F.date_format("window_end_at", "yyyy-MM-dd HH:mm")))[0]
    assert task["window_end_at"] == "2026-06-17 17:00"
    manifest = rows(planning.manifest_rows(tasks, RUN))[0]
    assert "window_end_at" not in manifest and (manifest["status"], manifest["attempt_count"], manifest["max_attempts"]) == ("pending", 0, 3)
    assert manifest["task_name"] == "job-" + task["job_id"]
    at_once = rows(planning.plan_jobs(postcodes(spark, "a", "b"), ["w"], None, RUN), "postcode")
    assert [row["scheduled_at"].second for row in at_once] == [0, 1] and at_once[0]["window_end_at"] is None


def test_resume_schedules_only_what_is_missing(spark, rows):
    intervals = readers.read_window_config(spark, JUNE)
    names = ["weekday_afternoon", "saturday_peak"]
    codes = postcodes(spark, "a", "b", "b", "c")
    manifest = spark.createDataFrame(
        [("run-1", "weekday_afternoon", "a", "x"), ("other", "weekday_afternoon", "b", "y"), ("run-1", "saturday_peak", "b", "z")],
        "run_id string, planned_window string, postcode string, job_id string",
    )
    found = rows(planning.plan_resume(codes, names, intervals, RUN, manifest), "planned_window", "scheduled_at")
    assert [(row["planned_window"], row["postcode"]) for row in found] == [("saturday_peak", "a"), ("saturday_peak", "c"), ("weekday_afternoon", "b"), ("weekday_afternoon", "b"), ("weekday_afternoon", "c")]
    expected = [int(start.timestamp()) for start, _ in twin(JUNE["weekday_afternoon"], 3)]
    assert [int(row["scheduled_at"].replace(tzinfo=UTC).timestamp()) for row in found[2:]] == expected
    skipped = rows(planning.skipped_counts(codes, names, manifest, RUN), "planned_window")
    assert [(row["postcodes"], row["skipped_existing"]) for row in skipped] == [(4, 2), (4, 1)]


def test_sample_is_repeatable_and_skips_blank_slugs(spark, rows):
    df = spark.createDataFrame([(str(at), "" if at % 3 == 0 else f"s{at}", f"n{at}", None, None) for at in range(30)], "restaurant_id string, restaurant_unique_name string, restaurant_name string, restaurant_url string, cuisine_names string")
    first, again = (rows(planning.seeded_sample(df.repartition(parts), "x", 5), "rank_key") for parts in (2, 5))
    assert first == again and all(row["restaurant_unique_name"] for row in first)
    tasks = rows(planning.menu_tasks(planning.seeded_sample(df, "x", 5), "r", "2026-06-01T00:00:00+00:00"), "scheduled_at")
    assert [row["restaurant_id"] for row in tasks] == [row["restaurant_id"] for row in first]
    assert [row["scheduled_at"].second for row in tasks] == [0, 1, 2, 3, 4]
