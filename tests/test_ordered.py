"""Running values against brute force, with one key that holds most of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.operators.audit import request_gaps, spacing_replay
from catchment.operators.ordered import exact_percentiles, global_ordinal, keyed_ordinal, running, stretch


def skewed(spark, n=4000):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.7 else f"k{rng.randrange(5)}" if rng.random() < 0.9 else None, rng.randrange(300), i, rng.randrange(-50, 50) or None) for i in range(n)]
    return rows, spark.createDataFrame(rows, "k string, t int, id int, v int").repartition(7)


def test_running_values_match_brute_force(spark):
    rows, df = skewed(spark)
    at = stretch(F.col("t"), 7)
    got = running(df, ["k"], at, ["t", "id"], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "c": ("count", F.col("v"))})
    before = running(df, ["k"], at, ["t", "id"], {"p": ("max", F.col("t"))}, inclusive=False)
    result = {row.id: (row.s, row.m, row.c) for row in got.collect()}
    previous = {row.id: row.p for row in before.collect()}
    state = {}
    for k, t, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        total, top, count, last = state.get(k, (None, None, 0, None))
        assert previous[i] == last
        if v is not None:
            total, top, count = (total or 0) + v, v if top is None else max(top, v), count + 1
        state[k] = (total, top, count, t)
        assert result[i] == (total, top, count)


def test_ordinals_are_dense(spark):
    _, df = skewed(spark)
    placed = global_ordinal(df, stretch(F.col("t"), 7), ["t", "id"]).orderBy("ordinal").collect()
    assert [row.ordinal for row in placed] == list(range(len(placed)))
    assert [(row.t, row.id) for row in placed] == sorted((row.t, row.id) for row in placed)
    keyed = keyed_ordinal(df, ["k"], stretch(F.col("t"), 7), ["t", "id"])
    spans = keyed.groupBy("k").agg(F.min("ordinal").alias("a"), F.max("ordinal").alias("b"), F.countDistinct("ordinal").alias("n"), F.count("*").alias("c")).collect()
    assert all(row.a == 0 and row.b == row.n - 1 and row.n == row.c for row in spans)


def test_percentiles_match_numpy(spark):
    rows, df = skewed(spark)
    points = {"p50": 0.5, "p90": 0.9, "p99": 0.99}
    for row in exact_percentiles(df, ["k"], "v", points).collect():
        values = [v for k, _, _, v in rows if k == row.k and v is not None]
        assert row.n == len(values) and row.min == min(values) and row.max == max(values)
        for name, q in points.items():
            assert abs(row[name] - np.percentile(values, q * 100)) < 1e-9
    total = exact_percentiles(df, [], "v", points).collect()
    assert len(total) == 1 and abs(total[0].p90 - np.percentile([r[3] for r in rows if r[3] is not None], 90)) < 1e-9


def test_one_value_and_no_rows(spark):
    df = spark.createDataFrame([("a", 5)], "k string, v int")
    row = exact_percentiles(df, ["k"], "v", {"p50": 0.5}).collect()[0]
    assert (row.n, row.p50) == (1, 5.0)
    assert exact_percentiles(df.filter("v > 9"), ["k"], "v", {"p50": 0.5}).collect() == []


@pytest.mark.parametrize("scale", [1e-7, 1.0, 1e12])
def test_percentiles_of_spread_out_values(spark, scale):
    rng = random.Random(3)
    values = [rng.choice([-1, 1, 1]) * rng.lognormvariate(0, 4) * scale for _ in range(3000)] + [0.0] * 50 + [scale] * 200 + [float("nan")]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double").repartition(5)
    row = exact_percentiles(df, [], "v", {"p1": 0.01, "p50": 0.5, "p99": 0.99, "top": 1.0}).collect()[0]
    real = values[:-1]
    assert row.n == len(real)
    for name, q in (("p1", 1), ("p50", 50), ("p99", 99), ("top", 100)):
        assert row[name] == pytest.approx(np.percentile(real, q), rel=1e-12)


def test_spacing_replay_matches_a_walk(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", "hot", "hot", None, "k"]), rng.randrange(0, 4_000_000) if rng.random() < 0.97 else None, f"d{n}") for n in range(3000)]
    df = spark.createDataFrame(rows, "limiter_key string, arrival_ms long, diagnostic_id string").repartition(6)
    got = {row.diagnostic_id: (row.position, row.reserved_ms, row.wait_ms) for row in spacing_replay(df).collect()}
    last, number, want = {}, {}, {}
    for key, at, name in sorted((row for row in rows if row[1] is not None), key=lambda row: (row[1], row[2])):
        last[key] = max(at + 1000, last.get(key, -(10**9)) + 1300)
        want[name] = (number.get(key, 0), last[key], last[key] - at)
        number[key] = number.get(key, 0) + 1
    assert got == want


def test_no_range_sort_and_few_exchanges(spark):
    df = spark.createDataFrame([("a", 5, "d", 1)], "limiter_key string, arrival_ms long, diagnostic_id string, start_ms long")
    plan = spacing_replay(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 3 and "rangepartitioning" not in plan
    assert "rangepartitioning" not in request_gaps(df)._jdf.queryExecution().executedPlan().toString()
