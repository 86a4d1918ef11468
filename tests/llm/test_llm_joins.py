"""N-gram join, components, suffix dedup and the pipeline: against brute-force versions."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from catchment.llm import line_dedup, mixing, ngram_join, packing, suffix_dedup, toxicity
from catchment.llm.components import components

SF = "/root/testdata/sf0.001"


def shingle_sets(rows):
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = {tuple(words[at : at + 5]) for at in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()
        sets[doc] = runs
    return sets


def brute_join(rows):
    sets = shingle_sets(rows)
    common = Counter()
    places = defaultdict(list)
    for doc, runs in sets.items():
        for run in runs:
            places[run].append(doc)
    for docs in places.values():
        common.update(itertools.combinations(sorted(docs), 2))
    parent = {doc: doc for doc in sets}

    def top(doc):
        while parent[doc] != doc:
            doc = parent[doc]
        return doc

    for (a, b), number in common.items():
        if 100 * number >= 80 * (len(sets[a]) + len(sets[b]) - number):
            one, other = sorted((top(a), top(b)))
            parent[other] = one
    return sorted((doc, len(sets[doc]), top(doc)) for doc in sets)


def varied_texts():
    """Copies with edits of different strength, a group that only a chain of links joins, shared passages, odd texts."""
    random.seed(11)
    vocabulary = [f"w{n}" for n in range(400)]
    rows, passage = [], random.choices(vocabulary, k=40)
    for family in range(6):
        base = random.choices(vocabulary, k=random.choice([6, 30, 120]))
        for _ in range(14):
            words = list(base)
            for _ in range(random.randint(0, 1 + len(words) // 40)):
                words[random.randrange(len(words))] = random.choice(vocabulary)
            if random.random() < 0.3:
                words = words[: -random.randint(1, 1 + len(words) // 10)] or words
            rows.append((len(rows), random.choice([" ", "\n", "\t "]).join(words)))
        rows.append((len(rows), " ".join(passage + base[:20])))
    slide = random.choices(vocabulary, k=140)
    rows += [(len(rows) + n, " ".join(slide[n * 5 : n * 5 + 80])) for n in range(12)]
    odd = ["", None, " \n", "one two", "One TWO", "one two three", "É É É É É", "é é é é é", "a b c d e", "A B C D E", "x " * 3000, "x " * 2999]
    return rows + [(len(rows) + n, text) for n, text in enumerate(odd)]


@pytest.mark.parametrize("tile", [3, 512])
def test_join_against_brute_force(documents, monkeypatch, tile):
    monkeypatch.setattr(ngram_join, "TILE", tile)
    rows = varied_texts()
    frame = documents(rows).selectExpr("*", "1 AS key", "2 AS n", "3 AS component_id")
    assert sorted(map(tuple, ngram_join.ngram_join(frame).collect())) == brute_join(rows)


def test_join_with_parts(documents, monkeypatch):
    """Groups of frequent shingles are dealt to parts by set; nothing is lost."""
    monkeypatch.setattr(ngram_join, "PART_BITS", 2)
    rows = varied_texts()
    assert sorted(map(tuple, ngram_join.ngram_join(documents(rows)).collect())) == brute_join(rows)


def test_join_repeats_and_empty(documents):
    text = "one two three four five six"
    found = sorted(map(repr, map(tuple, ngram_join.ngram_join(documents([(5, text), (5, text), (3, text), (None, text), (None, "")])).collect())))
    assert found == sorted(map(repr, [(5, 2, 3), (5, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None)]))
    assert ngram_join.ngram_join(documents([])).collect() == []


def test_bounds_never_lose_a_link():
    random.seed(2)
    rng = np.random.default_rng(1)
    for _ in range(300):
        base = rng.integers(0, 1 << 62, random.randint(1, 300)).astype(np.uint64)
        cut = random.randint(0, len(base) // 3)
        one, other = np.unique(base), np.unique(np.r_[base[cut:], rng.integers(0, 1 << 62, random.randint(0, 30)).astype(np.uint64)])
        if len(other) and ngram_join.linked(one, other, 80):
            maps = [np.frombuffer(ngram_join.bitmap(item), np.uint64) for item in (one, other)]
            differ = np.bitwise_count(maps[0] ^ maps[1]).sum(dtype=np.int64)
            assert ngram_join.room(np.array([differ]), np.array([len(one) + len(other)]), 80)[0]
            firsts = [set(item[: ngram_join.prefix_size(len(item), 80)].tolist()) for item in (one, other)]
            assert firsts[0] & firsts[1]


def test_components(spark):
    random.seed(4)
    chain = [(n, n + 1) for n in range(60)]
    star = [(100, 100 + n) for n in range(1, 50)]
    random.shuffle(chain)
    frame = spark.createDataFrame([*chain, *star, (7, 7), (200, 201), (201, 200)], "a long, b long")
    found = dict(map(tuple, components(frame).collect()))
    want = {n: 0 for n in range(61)} | {100 + n: 100 for n in range(50)} | {200: 200, 201: 200}
    assert found == want
    assert components(frame.limit(0)).collect() == []


def brute_suffix(rows, length):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[at : at + length] for at in range(len(data) - length + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if counts[data[at : at + length]] > 1:
                gone[at : at + length] = b"\x01" * length
        kept = bytes(byte for byte, lost in zip(data, gone, strict=True) if not lost)
        out.append((doc, len(data), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(map(repr, out))


@pytest.mark.parametrize("cover", suffix_dedup.COVERS)
def test_covers(cover):
    assert cover.holds()
    at = suffix_dedup.sampled(cover, 1000, 3000)
    assert (np.diff(at) > 0).all() and set((at % cover.period).tolist()) == set(cover.residues)


@pytest.mark.parametrize("length", [6, 24, 200])
def test_suffix_dedup_against_brute_force(documents, length):
    random.seed(length)
    passages = ["".join(random.choices("abé ", k=random.randint(0, 4 * length))) for _ in range(10)]
    rows = []
    for number in range(50):
        parts = [random.choice(passages)[random.randint(0, 3) :] if random.random() < 0.6 else "".join(random.choices("abcdefgh", k=length)) for _ in range(random.randint(0, 4))]
        rows.append((number, "".join(parts)))
    rows += [(100, None), (101, ""), (102, "aaaa" * length), (103, "ab" * length), (104, rows[3][1]), (None, rows[5][1]), (103, "ab" * length + "c"), (102, "aaaa" * length)]
    frame = documents(rows).selectExpr("*", "1 AS key", "2 AS size", "3 AS starts", "4 AS n_removed")
    found = sorted(repr(tuple(row)[:5]) for row in suffix_dedup.suffix_dedup(frame, length=length).collect())
    assert found == brute_suffix(rows, length)


def test_suffix_dedup_in_chunks(documents, monkeypatch):
    """Small chunks, buckets and packs give the same as large ones."""
    monkeypatch.setattr(suffix_dedup, "CHUNK", 500)
    monkeypatch.setattr(suffix_dedup, "HELD", 700)
    monkeypatch.setattr(suffix_dedup, "BUCKET", 64)
    random.seed(6)
    shared = "".join(random.choices("abcdefghij ", k=900))
    rows = [(n, "".join(random.choices("klmnop ", k=150)) + shared[random.randint(0, 300) : random.randint(450, 900)] + str(n) + shared[::-1][: 40 * n]) for n in range(20)]
    found = sorted(repr(tuple(row)[:5]) for row in suffix_dedup.suffix_dedup(documents(rows)).collect())
    assert found == brute_suffix(rows, 200)
    assert suffix_dedup.suffix_dedup(documents([])).collect() == []


def test_suffix_dedup_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = sorted(repr(tuple(row)[:5]) for row in suffix_dedup.suffix_dedup(docs).collect())
    assert found == brute_suffix([(row.doc_id, row.text) for row in docs.collect()], 200)


def brute_lines(rows):
    keys = defaultdict(set)

    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                keys[key(line)].add(doc)
    out = {}
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not (len(keys.get(key(line), ())) >= 3 and doc != max(keys[key(line)]))]
        if len(kept) == len(lines) or "\n".join(kept).strip(" "):
            out[doc] = "\n".join(kept)
    return out


def test_pipeline(spark, tmp_path):
    """Each stage against a brute-force version over what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {row.doc_id: row.text for row in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        if name == "best-fit packing":
            want = {(doc, zlib.crc32(packing.word_ids(_tokenizer()).encode([text])[0] + bytes(4))) for doc, text in kept.items()}
            assert {(row.doc_id, row.ids_crc32) for row in docs.collect() if row.length < packing.CAPACITY and row.start == 0} <= want
            assert {row.doc_id for row in docs.collect()} == set(kept)
            break
        assert docs.columns == before.columns
        if name == "toxicity":
            lexicon = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
            kept = {doc: text for doc, text in kept.items() if toxicity.score(text, lexicon) < 0.5}
        elif name == "line dedup":
            kept = brute_lines(list(kept.items()))
        elif name == "n-gram Jaccard join":
            kept = {doc: kept[doc] for doc, _, least in brute_join(list(kept.items())) if doc == least}
        else:
            drawn = {row.doc_id for row in mixing.mix(before).collect() if row._kept}
            kept = {doc: text for doc, text in kept.items() if doc in drawn}
        found = docs.collect()
        assert {row.doc_id: row.text for row in found} == kept and len(found) == len(kept)
        assert all(row.n_chars == len(row.text) for row in found)
    assert corpus_pipeline.run(spark, SF).count() >= len(kept)


def test_pipeline_stages_take_odd_tables(spark, documents):
    odd = documents([(1, None), (2, ""), (None, "text without id"), (3, "same words in both of these"), (3, "same words in both of these")])
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, rows, SF).count() <= 5


def _tokenizer():
    import public_tokenizers

    return public_tokenizers.path(packing.TOKENIZER)
