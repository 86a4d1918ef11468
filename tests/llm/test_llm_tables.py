"""Exact dedup, line dedup, mixing, packing, top-k: against SQL or a brute-force version."""

import bisect
import random
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from catchment.llm import exact_dedup, line_dedup, mixing, packing, queries, topk

SF = "/root/testdata/sf0.001"
SHARED = "This line stands in many documents."
TEXTS = [
    None, "", "", "Same Text", "same text", "SAME TÉXT", "same tÉxt", "x" * 5000, "X" * 5000, "x" * 4999 + "y", f"{SHARED}\nown line of the first one\n",
    f"  {SHARED.upper()}\t\n{SHARED}\nother", f"{SHARED}", f"a\n\n{SHARED}\nb", "\n", "short\nshort", "tail\n", "same text",
]


@pytest.fixture
def edge(documents):
    frame = documents([(number, text, None if number % 3 else "en", None if number % 4 else "src0") for number, text in enumerate(TEXTS)])
    return frame.selectExpr("*", "1 AS keep_id", "'x' AS _hash", "2 AS kept", "3 AS _lines", "4 AS _print", "5 AS _id", "6 AS piece", "7 AS count")


def plain(rows):
    return [(row.doc_id, row.text, row.lang, row.source) for row in rows.collect()]


@pytest.mark.parametrize("name", ["op7_mixing", "op8_line_dedup", "op9_exact_dedup", "op3_exact_topk"])
def test_queries_against_sql(spark, against_sql, name):
    against_sql(queries.QUERIES[name](spark, SF), queries.SQL[name])


@pytest.mark.parametrize("name", ["op7_mixing", "op8_line_dedup", "op9_exact_dedup"])
def test_edges_against_sql(edge, against_sql, name):
    import pandas as pd

    report = {
        "op7_mixing": mixing.mix_report, "op8_line_dedup": line_dedup.line_report,
        "op9_exact_dedup": lambda docs: exact_dedup.exact_dedup(docs, hash_all=True),
    }[name]
    base = edge.select("doc_id", "text", "lang", "source")
    pandas = pd.DataFrame([row.asDict() for row in base.collect()]).astype({"text": "string", "lang": "string", "source": "string"})
    against_sql(report(edge), queries.SQL[name], documents=pandas)


def test_refinement_hashes_survivors_only(edge):
    refined = {row.doc_id: row for row in exact_dedup.exact_dedup(edge).collect()}
    whole = {row.doc_id: row for row in exact_dedup.exact_dedup(edge, hash_all=True).collect()}
    for doc, row in whole.items():
        assert (row.keep_id, row.group_size, row.kept) == (refined[doc].keep_id, refined[doc].group_size, refined[doc].kept)
    hashed = {doc for doc, row in refined.items() if row.text_sha256}
    assert {doc for doc, row in whole.items() if row.group_size > 1} <= hashed and len(hashed) < len(whole)


def test_repeated_and_missing_ids(documents):
    rows = documents([(1, "a"), (1, "a"), (None, "a"), (2, "b"), (2, "c")])
    found = sorted(map(repr, ((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(rows).collect())))
    want = [(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (2, 2, 1, True), (2, 2, 1, True)]
    assert found == sorted(map(repr, want))
    lines = documents([(1, SHARED), (1, SHARED), (None, SHARED), (2, SHARED + "\nx")])
    kept = sorted(repr((r.doc_id, r.text, r._n_dropped)) for r in line_dedup.line_dedup(lines).collect())
    assert kept == sorted(map(repr, [(1, "", 1), (1, "", 1), (None, "", 1), (2, SHARED + "\nx", 0)]))


def test_many_lines_and_one_hot_line(documents):
    long = "\n".join(f"a line of its own number {n}" for n in range(20_000)) + f"\n{SHARED}\nend"
    rows = documents([(0, long)] + [(n, f"{SHARED}\ntext {n}") for n in range(1, 400)])
    cut = {row.doc_id: row for row in line_dedup.line_dedup(rows).collect()}
    assert cut[0].text == long.replace(f"\n{SHARED}", "") and cut[399].text.startswith(SHARED)
    assert all(cut[n].text == f"text {n}" for n in range(1, 399))


@pytest.mark.parametrize("report", [mixing.mix_report, line_dedup.line_report, exact_dedup.exact_dedup, packing.pack])
def test_empty_table(edge, report):
    assert report(edge.limit(0)).collect() == []


def test_raking_meets_the_margins():
    cells = {(a, b, c): float(10 + 7 * i + 3 * j + k) for i, a in enumerate("xyz") for j, b in enumerate("pq") for k, c in enumerate("uv")}
    margins = [{"x": 0.5, "y": 0.3, "z": 0.2, "absent": 0.4}, {"p": 0.9, "q": 0.1}, {"u": 0.4, "v": 0.6}]
    weights = mixing.rake(cells, margins, 60)
    total = sum(cells.values())
    for axis, margin in enumerate(margins):
        there = {name: share for name, share in margin.items() if name != "absent"}
        for name, share in there.items():
            got = sum(cells[cell] * weights[cell] for cell in cells if cell[axis] == name)
            assert got == pytest.approx(total * share / sum(there.values()), rel=1e-6)
    assert mixing.rake({}, margins, 5) == {}


def test_mix_keeps_columns_and_draws_by_probability(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(docs).collect()
    expected, kept = sum(r._probability * r._tokens for r in rows), sum(r._tokens for r in rows if r._kept)
    assert len(rows) == 1000 and abs(kept - expected) < 0.15 * expected
    assert max(r._probability for r in rows) == 1.0


def best_fit(lengths, capacity):
    left, bins = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect.bisect_left(left, length)
        if at < len(left):
            room = left.pop(at)
        else:
            room, bins = capacity, bins + 1
        if room > length:
            bisect.insort(left, room - length)
    return bins


def check_packing(pieces, texts, capacity):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want, lengths = Counter(), []
    for doc, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for number, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want[(doc, number, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
            lengths.append(len(part))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in pieces) == want
    bins = {}
    for row in pieces:
        bins.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(bins) == best_fit(lengths, capacity)


def test_packing(spark, edge):
    texts = [(row.doc_id, row.text) for row in edge.collect()]
    check_packing(packing.pack(edge).collect(), texts, packing.CAPACITY)
    check_packing(packing.pack(edge, capacity=7, salts=3).collect(), texts, 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_packing(packing.pack(docs).collect(), [(row.doc_id, row.text) for row in docs.collect()], packing.CAPACITY)


def test_plan_is_best_fit_and_small():
    random.seed(3)
    for _ in range(60):
        capacity = random.choice([5, 17, 64])
        lengths = [random.randint(1, capacity) for _ in range(random.randint(1, 300))]
        entries = packing.plan(Counter(lengths), capacity)
        assert len({first + n for _, _, number, first, _ in entries for n in range(number)}) == best_fit(lengths, capacity)
    few = len(packing.plan({length: 10 for length in range(1, 65)}, 64))
    assert len(packing.plan({length: 10_000_000 for length in range(1, 65)}, 64)) < 20 * few


def brute_topk(rows, every, k):
    import math

    vectors = [(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    size = Counter(len(v) for _, v in vectors).most_common(1)[0][0]
    vectors = {(i, v) for i, v in vectors if len(v) == size}
    out = []
    for q, v in vectors:
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in vectors if i != q)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return Counter(out)


@pytest.mark.parametrize("block", [4, 2048])
def test_topk_against_brute_force(spark, block):
    random.seed(8)
    rows = [(n, [random.uniform(-2, 2) * (1 + n % 7) for _ in range(6)]) for n in range(120)]
    rows += [(200 + n, rows[5][1]) for n in range(90)] + [(300, None), (301, []), (302, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (303, [float("nan")] * 6), (304, [float("inf")] * 6)]
    rows += [(None, rows[1][1]), (305, [1.0]), (7, rows[7][1]), (350, [0.0] * 6), (355, [-1.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS band")
    found = topk.search(frame, every=5, block=block, query_block=8)
    assert Counter(map(tuple, found.collect())) == brute_topk(rows, 5, 5)


def test_topk_of_few_and_large(spark):
    rows = [(0, [1e6, 1.0]), (50, [1e6, -2.0]), (51, [1e6, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, topk.search(frame).collect())) == brute_topk(rows, 50, 5)
    assert topk.search(frame.limit(0)).collect() == []
