"""The similarity join's bounds by place and by width of bitmaps, and groups that hold the same sets."""

import random

import numpy as np

from catchment.llm import ngram_join


def shingles(rng, number):
    return np.unique(rng.integers(0, 1 << 62, number).astype(np.uint64))


def differing(one, other):
    maps = [np.frombuffer(ngram_join.bitmap(item, ngram_join.width(len(item))), np.uint64) for item in (one, other)]
    words = min(map(len, maps))
    return np.bitwise_count(ngram_join.folded(maps[0], words) ^ ngram_join.folded(maps[1], words)).sum(dtype=np.int64)


def test_wide_bitmaps_tell_large_sets_apart():
    rng = np.random.default_rng(3)
    one, other = shingles(rng, 9000), shingles(rng, 8000)
    short = [np.frombuffer(ngram_join.bitmap(item), np.uint64) for item in (one, other)]
    both = np.array([len(one) + len(other)])
    assert ngram_join.room(np.array([np.bitwise_count(short[0] ^ short[1]).sum(dtype=np.int64)]), both, 80)[0]  # a short one is full
    assert not ngram_join.room(np.array([differing(one, other)]), both, 80)[0]
    wide = np.frombuffer(ngram_join.bitmap(one, ngram_join.width(len(one))), np.uint64)
    assert (ngram_join.folded(wide, ngram_join.BITS // 64) == short[0]).all()


def test_wide_bitmaps_and_places_never_lose_a_link():
    random.seed(5)
    rng = np.random.default_rng(6)
    links = 0
    for _ in range(400):
        base = shingles(rng, random.choice([1, 2, 5, 30, 300, 3000]))
        one, other = base, np.unique(np.r_[base[random.randint(0, len(base) // 5) :], shingles(rng, random.randint(0, 1 + len(base) // 5))])
        small, large = sorted((one, other), key=len)
        if not ngram_join.linked(small, large, 80):
            continue
        links += 1
        assert ngram_join.room(np.array([differing(one, other)]), np.array([len(one) + len(other)]), 80)[0]
        first = np.intersect1d(small, large)[0]
        assert np.searchsorted(small, first) < ngram_join.first_places(len(small), 80)
        assert np.searchsorted(large, first) < ngram_join.prefix_size(len(large), 80)
    assert links > 100


def test_partners_against_brute_force():
    rng = np.random.default_rng(7)
    for percent in (50, 80, 100):
        runs, n = np.sort(rng.integers(0, 40, 200)), rng.integers(1, 30, 200)
        n = n[np.lexsort((n, runs))]
        early = rng.random(200) < 0.5
        want = []
        for i in range(200):
            near = [j for j in range(200) if j != i and runs[j] == runs[i] and 100 * min(n[i], n[j]) >= percent * max(n[i], n[j])]
            want.append(any(early[i] and early[j] if n[i] == n[j] else early[i] if n[i] < n[j] else early[j] for j in near))
        assert ngram_join.with_partner(runs, n, early, percent).tolist() == want


def test_groups_of_the_same_sets_are_one(spark, documents):
    """Sets that share a passage meet at many shingles, which lie in many buckets; they are compared once."""
    passage = " ".join(f"p{n}" for n in range(60))
    docs = documents([(n, f"{passage} " + " ".join(f"t{n}x{at}" for at in range(8))) for n in range(3)])
    levels = np.zeros(ngram_join.SKETCH, np.uint8)
    sides = ngram_join.members(ngram_join.grouped(ngram_join.prefixes(docs, "text", levels, 16, 80), levels, 80)).collect()
    whole = [row for row in sides if sum(other.part == row.part for other in sides) == 3]
    assert len({row.key for row in whole}) == 3
    assert len(sides) == len({(row.part, row.key) for row in sides})
