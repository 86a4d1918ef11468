"""Spelling variants against a brute-force version."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catchment.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def words_of(docs, noise=199, min_chars=6, min_count=5):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if noise and h % noise == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            n[word] += 1
    return {word: number for word, number in n.items() if len(word) >= min_chars and number >= min_count}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:at] + b[at + 1 :] == a for at in range(len(b)))


def brute(n, factor=5):
    # Words one edit apart share a string of one letter less, or one is that string of the other.
    shorter = {}
    for word in n:
        for key in {word, *(word[:at] + word[at + 1 :] for at in range(len(word)))}:
            shorter.setdefault(key, set()).add(word)
    near = {word: {other for key in {word, *(word[:at] + word[at + 1 :] for at in range(len(word)))} for other in shorter[key] if one_edit(word, other)} for word in n}
    form = {word: min(near[word], key=lambda other: (-n[other], other)) for word in n if near[word]}
    form = {word: other for word, other in form.items() if n[other] >= factor * n[word]}

    def root(word):
        return root(form[word]) if word in form else word

    return {(word, form.get(word), root(word), n[word], len(near[word]), n[form[word]] if word in form else None) for word in n}


def ours(frame):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_brute_force(spark):
    docs = [(row.doc_id, row.text) for row in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(words_of(docs))
    assert ours(queries.op11_spelling_variants(spark, SF)) == want
    assert any(row[1] for row in want) and any(row[4] > 1 for row in want)


def made(rng, number):
    stems = ["Banana", "colour", "éçàèùôß", "ÀÖØöøÿ×÷", "aaaaaaaa", "abababab", "strasse", "misspelling"]
    words = []
    for _ in range(number):
        word = list(rng.choice(stems))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
            at = rng.randrange(len(word))
            word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "x"])
        words.append("".join(word))
    return words


@pytest.mark.parametrize(("share", "noise"), [(500_000, 199), (60, 3), (9, 0)])
def test_odd_texts_small_shares_and_hot_halves(spark, documents, share, noise):
    rng = random.Random(share)
    rows = [(n, rng.choice([" ", "-", "9", "日", "\n"]).join(made(rng, 60))) for n in range(60)]
    rows += [(None, "colour " * 9), (7, None), (8, ""), (9, "short word"), (10, "colour " * 9), (10, "colour " * 9), (11, "z" * 3000 + " "), (12, ("y" * 700 + " ") * 6 + ("y" * 701 + " ") * 40)]
    rows.append((13, "chainaaa " * 5 + "chainaab " * 26 + "chainabb " * 140))
    frame = documents(rows).selectExpr("*", "1 AS word", "2 AS n", "'x' AS form", "3 AS root", "4 AS id")
    got = ours(spelling.spelling_variants(frame, share=share, noise=noise))
    want = brute(words_of(rows, noise))
    assert got == want and (noise == 3 or any(row[1] and row[1] != row[2] for row in want))
    assert spelling.spelling_variants(frame.limit(0)).count() == 0


WORD = st.text(st.sampled_from("abcé"), min_size=2, max_size=9)


@given(st.sets(WORD, min_size=1, max_size=60), st.booleans())
@settings(max_examples=300, deadline=None)
def test_index_finds_all_words_one_edit_away(words, right):
    index = spelling.Index(list(words))
    asks = sorted(words)
    halves = [len(word) - len(word) // 2 if right else len(word) // 2 for word in asks]
    ask, found = index.near(asks, halves)
    pairs = [(asks[a], index.words[f]) for a, f in zip(ask.tolist(), found.tolist(), strict=True)]
    want = {(a, b) for a, half in zip(asks, halves, strict=True) for b in words if b.endswith(a[len(a) - half :]) and one_edit(a, b)}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


@given(st.dictionaries(WORD, st.integers(1, 4), min_size=1, max_size=60))
@settings(max_examples=200, deadline=None)
def test_halves_tell_each_pair_once(held):
    told = Counter()
    for right in (False, True):
        for word, number, form, count in spelling.best_near(held, sorted(held), right):
            assert one_edit(word, form) and count == held[form]
            told[word] += number
    assert told == Counter({a: n for a in held if (n := sum(one_edit(a, b) for b in held))})


def test_pieces_of_long_texts_count_the_same():
    text = "colours, Banana9 éclairs " * 50 + "x" * 90
    whole = Counter()
    for counts in spelling.runs(text.encode(), 6, 20):
        whole += counts
    assert whole == next(spelling.runs(text.encode(), 6)) == Counter({"colours": 50, "banana": 50, "éclairs": 50, "x" * 90: 1})
