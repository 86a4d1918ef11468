"""Token counts, toxicity, secret scan: row by row operators."""

import hashlib
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from hypothesis import given, settings
from hypothesis import strategies as st

from catchment.llm import queries, secret_scan, token_counts, toxicity

SF = "/root/testdata/sf0.001"

MODEL = public_tokenizers.path(token_counts.MODEL)
ODD = [None, "", " ", "\n\n", "word", "a  b   c", "▁x", "<s> </s> <unk> <0x0A>", "日本語 text", "😀é\x00\t", "x" * 30_000, "word " * 20_000, "tie", "tie"]


@pytest.fixture
def edge(documents):
    """Odd texts, a NULL id, a repeated row and columns of clashing names."""
    rows = [(number, text) for number, text in enumerate(ODD)] + [(None, "no id"), (3, "\n\n"), (3, "\n\n")]
    return documents(rows).selectExpr("*", "1 AS n_tokens", "2 AS _text", "'x' AS score", "0 AS held_out", "n_chars AS spans")


@given(st.lists(st.sampled_from(["a", "th", "ing", " ", "  ", "\n", "é", "日", "<s>", "▁", "0", "==", "😀", "the", "\x00"]), max_size=25), st.integers(2, 9))
@settings(max_examples=300, deadline=None)
def test_transducer_counts_like_the_library(parts, chunk):
    text = "".join(parts)
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    ours = token_counts.transducer(MODEL)
    assert ours.total(token_counts.normalised(text), chunk) == len(library.encode(text))


def test_state_maps_compose_in_any_grouping():
    machine = token_counts.transducer(MODEL)
    text = token_counts.normalised("one two  three\nfour-five " * 7)
    maps = [machine.chunk_map(text[at : at + 11]) for at in range(0, len(text), 11)]
    left = maps[0]
    for item in maps[1:]:
        left = machine.compose(left, item)
    right = maps[-1]
    for item in reversed(maps[:-1]):
        right = machine.compose(item, right)
    whole = [machine.count(m.head) + (m.count or 0) + machine.count(m.tail) for m in (left, right)]
    assert whole == [machine.count(text)] * 2


def test_token_counts(spark, edge):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for frame in (edge, spark.read.parquet(f"{SF}/documents.parquet")):
        texts = Counter((row.doc_id, row.text or "") for row in frame.select("doc_id", "text").collect())
        want = Counter()
        for (doc, text), times in texts.items():
            number = len(library.encode(text))
            want[(doc, len(text.encode()), number, number > 4096)] += times
        assert Counter(map(tuple, token_counts.token_counts(frame).collect())) == want
    assert token_counts.token_counts(edge.limit(0)).count() == 0


def test_forgetting_words_and_states_changes_nothing():
    small = token_counts.Transducer(token_counts.transducer(MODEL).ranks, remember=3)
    text = token_counts.normalised("some words come and some words go, some come again")
    assert small.count(text) == token_counts.transducer(MODEL).count(text)


def brute_spans(text):
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16])


SECRETS = [
    "password = 'abcdef123456'", "toKen:short", "paſſword=abcdefghijkl1", "api_key=\"A+/=_.-0123456\" apikey: zzzzzzzzzzzzz", "AKIAABCDEFGH1234567 AKIA12",
    "é deadbeefdeadbeef0 DEADBEEFDEADBEEF", "secret= token=abcdefghijklmn", "", "0123456789abcdef" * 3,
]


@pytest.mark.parametrize("text", SECRETS)
def test_fixed_patterns(text):
    assert secret_scan.base_spans(text) == brute_spans(text)


def test_constants_reach_sensitive_names():
    text = 'base = "zK8#qW2!mN5x"\nname = "hello"\npassword = base\nother: zK8#qW2!mN5y\nsignature_key => "Ab9" + "fQ7xT2"\npassword = "changeme123"\n'
    spans = {text[start:end] for start, _, end in secret_scan.named_spans(text)}
    assert "zK8#qW2!mN5x" in spans
    assert not spans & {"hello", "zK8#qW2!mN5y", "changeme123"}


def test_secret_scan(spark, edge):
    for frame in (edge, spark.read.parquet(f"{SF}/documents.parquet")):
        got = Counter(tuple(row)[:5] for row in secret_scan.secret_scan(frame).collect())
        want = Counter()
        for row in frame.select("doc_id", "text").collect():
            base = brute_spans(row.text or "")
            digest = hashlib.sha256(",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
            want[(row.doc_id, *(sum(k == kind for _, k, _ in base) for kind in range(3)), digest)] += 1
        assert got == want


def test_folding_and_exceptions():
    lexicon = toxicity.Lexicon(((" idiot ", 5.0), (" trash ", 5.0)), slopes=(-4.0, 3.0, 1.0, 0.0, 0.0))
    for text in ("you idiot", "you 1d10t", "you іdіоt", "YOU ＩＤＩＯＴ"):
        assert toxicity.score(text, lexicon) > 0.5, text
    for text in ("", "you idiots", "a trash can", "fine"):
        assert toxicity.score(text, lexicon) < 0.5, text
    assert toxicity.score("trash " + "word " * 500, lexicon) < toxicity.score("trash word", lexicon)


def test_toxicity_of_rows(spark, edge):
    lexicon = toxicity.Lexicon(((" word ", 9.0),))
    scored = toxicity.toxicity(edge.drop("score"), lexicon).collect()
    assert len(scored) == edge.count() and all(0 <= row._score <= 1 for row in scored)
    empty = toxicity.fit(edge, spark.createDataFrame([], "doc_id long, toxic int"))
    assert empty.weights == () and toxicity.score("anything", empty) < 0.5


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = {row.doc_id: row for row in queries.op6_toxicity(spark, folder).collect()}
    assert all(row.held_out == (zlib.crc32(str(doc).encode()) % 5 == 0) for doc, row in rows.items())
    labels = [row for row in spark.read.parquet(f"{folder}/labels.parquet").collect() if rows[row.doc_id].held_out]
    right = sum(rows[row.doc_id].predicted == row.toxic for row in labels)
    assert len(labels) > 40 and right >= 0.93 * len(labels)
