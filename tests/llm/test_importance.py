"""Importance resampling against a brute-force version over whole texts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from catchment.llm import importance, queries

SF = "/root/testdata/sf0.001"


def grams(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return words, [" ".join(words[at : at + n]) for n in (1, 2, 3) for at in range(len(words) - n + 1)]


def brute(docs, target, share=5):
    """(id, n_features, weight, score, rank) rows; all rows of one id and score count as alike."""
    bucket = lambda gram: zlib.crc32(gram.encode()) % 10_000
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(map(bucket, grams(text)[1]))
    for text in target:
        t.update(map(bucket, grams(text)[1]))
    big, small = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big + 10_000) / ((s[b] + 1) * (small + 10_000))))
    rows, may = [], []
    for number, (doc, text) in enumerate(docs):
        words, found = grams(text)
        weight = sum(gain(bucket(gram)) for gram in found)
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None])
        if len(words) >= 20:
            may.append(((-score, doc is None, doc or 0, -weight, -len(found)), number))
    for rank, (_, number) in enumerate(sorted(may)[: share * len(may) // 100], 1):
        rows[number][4] = rank
    return Counter(map(tuple, rows))


def ours(frame):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in frame.collect())


def pairs(frame):
    return [(row.doc_id, row.text) for row in frame.collect()]


def test_query_against_brute_force(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = brute(pairs(docs), [row.text for row in target.collect()])
    assert ours(queries.op12_importance_resampling(spark, SF)) == want
    assert any(row[4] for row in want)


def test_odd_texts_ids_and_columns(spark, documents):
    rng = random.Random(5)
    some = ["one", "Two", "3", "vier", "fünf", "日本", "x" * 400, "\x00", "a\nb", "É"]
    rows = [(n // 2, " ".join(rng.choices(some, k=rng.randint(0, 60)))) for n in range(120)]
    rows += [(None, "no id " * 30), (7, None), (8, ""), (9, " \n "), (10, "word " * 30), (10, "word " * 30), (11, "tie " * 30), (11, "TIE " * 30)]
    frame = documents(rows).selectExpr("*", "1 AS rank", "2 AS weight", "3 AS n_words", "'x' AS _bin", "4 AS score")
    target = spark.createDataFrame([(1, "one two 3"), (2, None), (3, "")], "item_id long, text string")
    assert ours(importance.resample(frame, target, share=40)) == brute(rows, ["one two 3", None, ""], 40)
    assert ours(importance.resample(frame, target.limit(0), share=40)) == brute(rows, [], 40)
    empty = importance.resample(frame.limit(0), target)
    assert empty.count() == 0 and {"doc_id", "n_features", "weight", "score", "rank"} <= set(empty.columns)


@pytest.mark.parametrize("chunk", [1, 7, 30, 1 << 20])
def test_long_texts_are_cut_without_losing_features(chunk):
    rng = random.Random(chunk)
    texts = [" ".join("ab"[: rng.randint(1, 2)] * rng.randint(1, 20) for _ in range(rng.randint(0, 50))) for _ in range(30)]
    texts += ["", "x" * 100, "  a  b  c  "]
    pieces = [piece for row, text in enumerate(texts) for piece in importance.pieces(row, text.encode(), chunk)]
    found = Counter()
    for some in importance.batched(pieces, 64):
        got = importance.features(some)
        rows = [some[at].row for at, n in enumerate(got.borders[1:] - got.borders[:-1]) for _ in range(n)]
        for hashes, valid in zip(got.hashes, got.valid, strict=True):
            found.update((row, int(h)) for row, h, counts in zip(rows, hashes, valid, strict=True) if counts)
    assert found == Counter((row, zlib.crc32(gram.encode())) for row, text in enumerate(texts) for gram in grams(text)[1])


def test_ranks_over_many_bins(spark):
    rows = [(n, 30, n % 7, n % 5, (n * 37) % 50) for n in range(2000)] + [(5, 30, 0, 0, 49)] * 3
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    got = sorted((r["rank"], -r.score, r.doc_id) for r in importance.ranked(scored, "n_words >= 20", 30, 10).collect() if r["rank"])
    want = sorted((-row[4], row[0]) for row in rows)[: 30 * len(rows) // 100]
    assert [row[0] for row in got] == list(range(1, len(want) + 1)) and [row[1:] for row in got] == want
