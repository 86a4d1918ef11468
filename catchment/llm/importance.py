"""Importance resampling towards a target: hashed n-gram counts of corpus and target, gains per bucket, a draw by Gumbel keys.

A batch's texts are joined with sentinels between them; one regex pass finds all words, the word starts are looked up
against the documents' offsets, and n-grams that would cross a document are masked before anything is counted.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.session import pin

BUCKETS = 10_000
#: Percent of the documents with enough words that are drawn.
SHARE = 5
MIN_WORDS = 20
SEED = 42
ORDERS = 3
#: Bytes of text that are joined at a time; longer texts are cut between words.
CHUNK = 1 << 20
#: Rows that one task ranks, about.
RANKED = 200_000

_SENTINEL = b"\n"
#: A-Z in lower case; digits, letters and all beyond ASCII stay; anything else parts words, sentinels among it.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_WORD = re.compile(rb"[^ \n]+")


class Piece(NamedTuple):
    row: int
    text: bytes
    #: Words at the start that belong to the piece before.
    carried: int


class Features(NamedTuple):
    """Hashes of the n-grams that end at each word of some pieces, and which of them count."""

    hashes: list[np.ndarray]
    valid: list[np.ndarray]
    #: First word of each piece, and one past the last word.
    borders: np.ndarray


def pieces(row: int, text: bytes, chunk: int = CHUNK) -> Iterator[Piece]:
    """A folded text in pieces; all but the first repeat the last words of the one before, so that no n-gram is lost."""
    folded, at, tail = text.translate(_FOLD), 0, []
    while at < len(folded) or not at:
        end = len(folded)
        if end - at > chunk:
            cut = folded.rfind(b" ", at + 1, at + chunk)
            cut = cut if cut > 0 else folded.find(b" ", at + chunk)
            end = cut if cut > 0 else end
        piece = Piece(row, b" ".join([*tail, folded[at:end]]), len(tail))
        yield piece
        if end >= len(folded):
            return
        tail, at = piece.text.rsplit(None, ORDERS - 1)[1 - ORDERS :], end


def batched(some: Iterable[Piece], chunk: int = CHUNK) -> Iterator[list[Piece]]:
    held, size = [], 0
    for piece in some:
        held.append(piece)
        size += len(piece.text) + 1
        if size >= chunk:
            yield held
            held, size = [], 0
    if held:
        yield held


def features(some: list[Piece]) -> Features:
    joined = _SENTINEL.join(piece.text for piece in some)
    words = _WORD.findall(joined)
    codes = np.frombuffer(joined, np.uint8)
    inside = (codes != 32) & (codes != 10)
    starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]][: len(inside)])
    offsets = np.cumsum([0, *(len(piece.text) + 1 for piece in some)])
    borders = np.searchsorted(starts, offsets)
    counts = np.diff(borders)
    place = np.arange(len(words)) - np.repeat(borders[:-1], counts)
    fresh = place >= np.repeat([piece.carried for piece in some], counts)
    hashes, valid = [np.fromiter(map(crc32, words), np.int64, len(words))], [fresh]
    spaced, before = [b" " + word for word in words], hashes[0].tolist()
    for order in range(1, ORDERS):
        before = list(map(crc32, spaced[order:], before))
        hashes.append(np.r_[np.zeros(min(order, len(words)), np.int64), np.array(before, np.int64)])
        valid.append(fresh & (place >= order))
    return Features(hashes, valid, borders)


def texts_of(column: pa.Array, chunk: int = CHUNK) -> Iterator[Piece]:
    for row, text in enumerate(column):
        yield from pieces(row, text.as_buffer().to_pybytes() if text.is_valid else b"", chunk)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows of a frame of one text column; each task adds up its own first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for some in batched(texts_of(batch.column(0))):
                found = features(some)
                for hashes, valid in zip(found.hashes, found.valid, strict=True):
                    total += np.bincount(hashes[valid] % buckets, minlength=buckets)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["bucket", "n"])

    sums = np.zeros(buckets, np.int64)
    for row in texts.mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        sums[row["bucket"]] = row["n"]
    return sums


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What one feature of each bucket adds: 1000 times the logarithm of the smoothed ratio of shares, rounded down."""
    wide, narrow = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * wide / ((s + 1.0) * narrow))) for s, t in pairs], np.int64)


def noise(key: str) -> int:
    """A Gumbel draw out of a key, times 1000, rounded down."""
    first = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((first + 0.5) / 4294967296)))


def weights(column: pa.Array, gain: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, features, weight) of each text of a column."""
    totals = np.zeros((3, len(column)), np.int64)
    for some in batched(texts_of(column, chunk), chunk):
        found = features(some)
        number = len(found.valid[0])
        own = np.zeros((3, number + 1), np.int64)
        own[0, 1:] = found.valid[0]
        for hashes, valid in zip(found.hashes, found.valid, strict=True):
            own[1, 1:] += valid
            own[2, 1:] += np.where(valid, gain[hashes % len(gain)], 0)
        sums = np.cumsum(own, axis=1)
        by_piece = sums[:, found.borders[1:]] - sums[:, found.borders[:-1]]
        # A long text has several pieces in one list.
        for kind in range(3):
            np.add.at(totals[kind], [piece.row for piece in some], by_piece[kind])
    return totals[0], totals[1], totals[2]


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of each row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, number, weight = weights(batch.column(1), gain)
            keys = (f"{seed}:{'' if doc is None else doc}" for doc in batch.column(0).to_pylist())
            score = weight + np.fromiter(map(noise, keys), np.int64, len(weight))
            arrays = [batch.column(0), *(pa.array(values, pa.int64()) for values in (words, number, weight, score))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(weigh, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


def ranked(scored: DataFrame, enough: str, share: int, per_task: int = RANKED) -> DataFrame:
    """`scored` with the rank of the rows that are drawn: the `share` percent of highest score among the `enough` ones.

    Rows are dealt over bins of scores, of about `per_task` rows by an approximate quantile; exact counts of the bins
    give what each bin's ranks start from, so no task sees more than its bin, and rows that can't be drawn aren't moved.
    """
    number = scored.filter(enough).count()
    draw = share * number // 100
    if not draw:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    bins = min(4096, max(16, draw // per_task))
    fractions = np.linspace(max(0.0, 1 - 1.2 * draw / number), 1.0, bins, endpoint=False).tolist()
    tops = scored.filter(enough).agg(F.percentile_approx("score", fractions, 20 * bins * 100 // max(share, 1)).alias("at")).first()["at"]
    bounds = np.unique(np.array(tops, np.int64))

    @F.pandas_udf("int")
    def bin_of(score: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, score.to_numpy(), side="right").astype(np.int32))

    counts = np.zeros(len(bounds) + 1, np.int64)
    for row in scored.filter(enough).groupBy(bin_of("score").alias("bin")).count().collect():
        counts[row["bin"]] = row["count"]
    before = counts[::-1].cumsum()[::-1] - counts
    last = int(np.flatnonzero(before < draw)[0])
    may = F.expr(enough) if last == 0 else F.expr(enough) & (F.col("score") >= int(bounds[last - 1]))
    order = Window.partitionBy("_bin").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features"))
    above = F.get(F.array(*[F.lit(int(value)) for value in before]), F.col("_bin")).cast("long")
    top = scored.filter(may).withColumn("_bin", bin_of("score")).withColumn("rank", above + F.row_number().over(order)).drop("_bin")
    return top.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank"))).unionByName(
        scored.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    buckets: int = BUCKETS,
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) for each row; `rank` is NULL where a row isn't drawn.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case; features are all runs of one to
    three of them, hashed to buckets. A bucket's gain compares its share of the target with its share of `docs`; a
    row's weight is the sum of its features' gains, its score adds a Gumbel draw made of seed and id, and of the rows
    with `min_words` words the `share` percent of highest score are drawn, ties to the smaller id.

    NULL and empty texts have no words: no features, weight 0, never drawn. A NULL id draws with the seed alone and is
    larger than any other. Rows that repeat an id are rows like others; rows alike in score and id rank by weight and
    number of features, and those alike in all are told apart by nothing. Texts of any length are read whole, in
    pieces. Other columns are ignored; an empty target leaves the smoothing alone; empty `docs` give no rows.
    """
    gain = gains(bucket_counts(docs.select(text_col), buckets), bucket_counts(target.select(target_text), buckets))
    return ranked(pin(weighed(docs, gain, id_col, text_col, seed)), f"n_words >= {min_words}", share)
