"""Op 3 sends one block to the driver whatever the table's size, and gives the same rows from any grid of cells."""

import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from test_llm_tables import brute_topk

from catchment.llm import topk

SMALL_DRIVER = """
from catchment.session import build_session
from pyspark.sql import functions as F
spark = build_session("small driver", "local[4]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "24", "spark.driver.maxResultSize": "1m"})
rows = spark.range(3000).select(F.col("id").alias("vec_id"), F.transform(F.sequence(F.lit(1), F.lit(64)), lambda at: F.sin(F.col("id") * 67.0 + at * at)).alias("embedding"))
from catchment.llm import topk
print(topk.search(rows, block=128).count())
"""


def test_only_one_block_goes_to_the_driver():
    # 24 blocks, one in each partition, have 64 KB each as doubles.
    done = subprocess.run([sys.executable, "-c", SMALL_DRIVER], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split()[-1] == str(3000 // 50 * 5)


def vectors(factor=1.0):
    random.seed(3)
    rows = [(n, [random.uniform(-2, 2) * factor * (1 + n % 5) for _ in range(6)]) for n in range(150)]
    same = [(400 - n, rows[10][1]) for n in range(120)]
    negative = [(500 + n, [-abs(x) for x in rows[n][1]]) for n in range(20)]
    return rows + same + negative + [(5, rows[6][1]), (-10, rows[7][1]), (600, [0.0] * 6), (601, [1.0])]


@pytest.mark.parametrize(("kind", "factor"), [("float", 1.0), ("float", 1e5), ("double", 1.0), ("double", 4e5)])
@pytest.mark.parametrize(("held", "block"), [(6 * 10, 8), (6 * 40, 64), (1 << 22, 16)])
def test_any_grid_gives_the_same_rows(spark, monkeypatch, kind, factor, held, block):
    monkeypatch.setattr(topk, "HELD", held, raising=False)
    rows = [(n, [float(np.float32(x)) for x in v] if kind == "float" else v) for n, v in vectors(factor)]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")
    expected = Counter()
    # Vectors that share a query's id are ranked together.
    for found in brute_of_ids(rows, 5, 5):
        expected[found] += 1
    assert Counter(map(tuple, topk.search(frame, every=5, block=block, query_block=7).collect())) == expected


def brute_of_ids(rows, every, k):
    merged = {}
    for q, _, i, score in brute_topk(rows, every, k).elements():
        merged.setdefault(q, []).append((-score, i))
    return [(q, n + 1, i, -score) for q, found in merged.items() for n, (score, i) in enumerate(sorted(found)[:k])]


def test_no_queries(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 3.0])], "vec_id long, embedding array<float>")
    assert topk.search(frame).collect() == []


def test_best_rises_with_each_block():
    rng = np.random.default_rng(1)
    turn, leading = np.eye(8), 5
    q, c = (np.floor(rng.normal(0, 80, (n, 8))).astype(np.float32) for n in (9, 300))
    asked = topk.Asked(np.arange(9) * 50, q, np.full(9, -np.inf), turn, leading, 3)
    room, last = topk.Room(), asked.best.copy()
    for at in range(0, 300, 75):
        block = c[at : at + 75]
        asked.meet(np.arange(1000 + at, 1000 + at + 75), block, topk.bounding(block, turn, leading), float(topk.lengths(block).max()), room)
        assert (asked.best >= last).all() and (asked.best == -np.sort(-(q @ c[: at + 75].T), axis=1)[:, 2]).all()
        last = asked.best.copy()


def test_equal_scores_go_to_the_smaller_id():
    scores = np.array([[5.0, 7, 7, 7, 1], [3, 3, 3, 3, 3]])
    at, to, found = topk.firsts(scores, np.array([100, 40]), np.array([50, 40, 30, 20, 10]), 2)
    assert sorted(zip(at.tolist(), to.tolist(), found.tolist(), strict=True)) == [(0, 2, 7), (0, 3, 7), (1, 3, 3), (1, 4, 3)]
