import random

from pyspark.sql import functions as F

from catchment.operators import audit

DIAGNOSTICS = "diagnostic_id bigint, limiter_key string, start_ms bigint, finish_ms bigint, http_status bigint"


def test_spacing_of_four_equal_arrivals(spark, rows):
    df = spark.createDataFrame([("k", 0, at) for at in range(4)], "limiter_key string, arrival_ms bigint, diagnostic_id bigint")
    assert [row["reserved_ms"] for row in rows(audit.spacing_replay(df), "diagnostic_id")] == [1000, 2300, 3600, 4900]


def test_spacing_matches_the_walk_on_a_hot_key(spark, rows):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.8 else "cold", rng.randrange(400_000), at) for at in range(600)]
    found = {row["diagnostic_id"]: row["reserved_ms"] for row in rows(audit.spacing_replay(spark.createDataFrame(data, "limiter_key string, arrival_ms bigint, diagnostic_id bigint")))}
    last = {}
    for key, arrival, at in sorted(data):
        last[key] = max(arrival + 1000, last.get(key, -10**9) + 1300)
        assert found[at] == last[key]


def test_ban_opens_when_the_response_is_back(spark, rows):
    hour = 3_600_000
    data = [
        (1, "k", 0, 500, 429),
        (2, "k", 400, 450, 200),  # the 429 is not back yet
        (3, "k", 500, 600, 200),  # the same instant as its return
        (4, "k", 501, 600, 200),
        (5, "k", 500 + hour - 1000, 9, 200),
        (6, "k", 500 + hour, 9, 200),
        (7, "other", 600, 700, 200),
        (8, "k", None, None, None),
    ]
    found = {int(row["diagnostic_id"]): row["circuit_open"] for row in rows(audit.ban_audit(spark.createDataFrame(data, DIAGNOSTICS)))}
    assert found == {1: False, 2: False, 3: False, 4: True, 5: True, 6: False, 7: False}


def test_gaps_and_concurrency(spark, rows):
    data = [(1, "k", 0, 100, 200), (2, "k", 50, 150, 200), (3, "k", 150, 160, 200), (4, "k", None, None, None), (5, "z", 7, 8, 200)]
    df = spark.createDataFrame(data, DIAGNOSTICS)
    gaps = rows(audit.request_gaps(df), "limiter_key")
    assert len(gaps) == 1 and (gaps[0]["n"], gaps[0]["min"], gaps[0]["max"], gaps[0]["p50"]) == (2, 50, 100, 75.0)
    open_now = {(row["limiter_key"], row["at_ms"]): row["open_requests"] for row in rows(audit.in_flight(df))}
    assert open_now["k", 50] == 2 and open_now["k", 150] == 1 and open_now["k", 160] == 0
    assert {row["limiter_key"]: row["peak_open"] for row in rows(audit.peak_in_flight(df))} == {"k": 2, "z": 1}


def test_outcomes_spillover_and_keys(spark, rows):
    df = spark.createDataFrame([(429, "failed"), (503, "failed"), (200, "succeeded"), (404, "failed"), (None, "deferred")], "http_status bigint, outcome string")
    assert {row["status_class"] for row in rows(audit.http_outcomes(df))} == {"429", "5xx", "ok", "4xx", "none"}
    snapshots = spark.createDataFrame([("w", "2026-06-17 13:00:00"), ("w", "2026-06-17 17:00:00"), ("w", "2026-06-18 00:30:00"), ("v", "2026-06-17 13:00:00")], "planned_window string, captured_at string").withColumn("captured_at", F.col("captured_at").cast("timestamp"))
    intervals = spark.createDataFrame([("w", "2026-06-17 13:00:00", "2026-06-17 17:00:00"), ("w", "2026-06-17 23:00:00", "2026-06-18 01:00:00"), ("w", "2026-06-17 12:00:00", "2026-06-17 14:00:00")], "tag string, a string, b string").select("tag", F.col("a").cast("timestamp").alias("opens_at"), F.col("b").cast("timestamp").alias("closes_at"))
    found = {row["planned_window"]: (row["rows"], row["inside"], row["outside"]) for row in rows(audit.spillover(snapshots, intervals))}
    assert found == {"w": (3, 2, 1), "v": (1, 0, 1)}
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(audit.duplicate_keys(keys, ["k"])) == [{"k": "a", "rows": 2}]
    assert rows(audit.key_summary(keys, ["k"], "t"))[0] == {"table_name": "t", "rows": 4, "distinct_keys": 3, "repeated_keys": 1, "surplus_rows": 1}
    parents = spark.createDataFrame([("a",)], "k string")
    assert rows(audit.fk_audit({"c": keys, "p": parents}, [("c", "k", "p", "k")])) == [{"child": "c", "parent": "p", "child_rows": 4, "orphan_rows": 1, "null_rows": 1}]
