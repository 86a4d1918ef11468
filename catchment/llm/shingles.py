"""Distinct word shingles of texts as sorted 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from catchment.llm.prints import CHUNK, Prints, mixed

WORDS = 5
#: Odd factors that tell the places of a shingle apart (fixed values).
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xD6E8FEB86659FD93], np.uint64)
#: Words longer than this are hashed one by one.
LONG = 1024

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of a text, A-Z folded."""
    text = _LOWER[np.frombuffer(data, np.uint8)]
    inside = ~_BLANK[text]
    starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]][: len(inside)])
    ends = np.flatnonzero(inside & np.r_[~inside[1:], True][-len(inside) :]) + 1
    hashes = np.zeros(len(starts), np.uint64)
    long = ends - starts > LONG
    for at in np.flatnonzero(long).tolist():
        hashes[at] = xxhash.xxh3_64_intdigest(text[starts[at] : ends[at]].tobytes())
    short = np.flatnonzero(~long)
    for some in np.split(short, np.flatnonzero(np.diff(starts[short] // CHUNK)) + 1):
        if len(some):
            first = starts[some[0]]
            hashes[some] = Prints(text[first : ends[some[-1]]]).at(starts[some] - first, ends[some] - first)
    return starts, hashes


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text the hashes of its distinct runs of five words; of the whole sequence where there are fewer words."""
    starts, hashes = word_hashes(b"\n".join(texts))
    borders = np.searchsorted(starts, np.cumsum([0, *(len(text) + 1 for text in texts)]))
    runs = np.zeros(0, np.uint64)
    if len(hashes) >= WORDS:
        runs = np.full(len(hashes) - WORDS + 1, WORDS, np.uint64)
        for at in range(WORDS):
            runs += hashes[at : len(hashes) - WORDS + 1 + at] * FACTORS[at]
        runs = mixed(runs)
    sets = []
    for first, last in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True):
        if last - first >= WORDS:
            sets.append(np.unique(runs[first : last - WORDS + 1]))
        elif last > first:
            few = hashes[first:last]
            sets.append(mixed(np.array([(few * FACTORS[: len(few)]).sum(dtype=np.uint64)]) + np.uint64(len(few))))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def sets_in(column: pa.Array) -> Iterator[np.ndarray]:
    """The set of each text of a column, worked out for about a megabyte of texts at a time."""
    some, held = [], 0
    for text in column:
        some.append(text.as_buffer().to_pybytes() if text.is_valid else b"")
        held += len(some[-1])
        if held > CHUNK // 2:
            yield from shingle_sets(some)
            some, held = [], 0
    if some:
        yield from shingle_sets(some)


def set_key(hashes: np.ndarray) -> int:
    """One 64-bit value for a set of shingles."""
    return int(mixed(hashes * FACTORS[0] + FACTORS[1]).sum(dtype=np.uint64) ^ np.uint64(len(hashes))) - (1 << 63)
