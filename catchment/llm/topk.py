"""Exact top-k by inner product: norm-sorted blocks, rotated partial sums, Cauchy-Schwarz bounds.

Vectors are rotated onto the eigenvectors of their second moments (the right singular vectors of the whole matrix), so
that the leading coordinates hold most of any product. Candidates stand in blocks by descending length. The longest ones
give each query a first k-th best score. A query needs a later block only if its own length times the longest vector
there can reach that score. Inside a block the product of the leading coordinates and the lengths of the rest bound each
score from above, and only pairs whose bound reaches the k-th best are multiplied out, in whole numbers.

Stripes of queries and columns of candidates make a grid of cells. A cell is one task: it holds its stripe and lets the
column's blocks pass by, and each query's k-th best there rises with them. So vectors travel once for each column or
stripe, not for each pair of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.llm.common import let_go
from catchment.session import pin

SCALE = 256
EVERY = 50
K = 5
#: Vectors in a block of candidates and in one of queries.
BLOCK = 2048
QUERY_BLOCK = 512
#: Components of queries that a task holds, about; 64,000 vectors of 64.
HELD = 1 << 22
#: Columns where there are few candidates for a query.
MIN_COLUMNS = 16
#: Share of the squared lengths that the leading coordinates hold.
LEADING = 0.9
#: Pairs that are multiplied out at once; more leave the processor's cache.
PAIRS = 2048
#: Slack for rounding in the bounds, relative to the lengths; scores themselves are exact.
SLACK = 1e-9
#: Below it, each sum of a product of two vectors is exact in single precision, whatever its order: none exceeds the product of the lengths.
SINGLE = 2.0**24

BLOCKS = "band int, most double, ids binary, vectors binary"
NAMES = ["band", "most", "ids", "vectors"]


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component; NULL for vectors that are NULL, empty or hold NULL or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    values = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, values)


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def opened(ids, vectors, stored: str, single: bool) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.frombuffer(ids, np.int64)
    return numbers, np.frombuffer(vectors, stored).reshape(len(numbers), -1).astype(np.float32 if single else float)


def moments(rows: DataFrame, size: int) -> np.ndarray:
    """Sum of the outer products of the vectors, added up in each task first; as large as the square of the dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            x = matrix(batch.column(0)).astype(float)
            if len(x):
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size, dtype=np.int32)), pa.array(total.ravel())], names=["at", "value"])

    total = np.zeros(size * size)
    sums = rows.select("_v").mapInArrow(added, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).toArrow()
    total[sums["at"].to_numpy()] = sums["value"].to_numpy()
    return total.reshape(size, size)


def rotation(total: np.ndarray) -> tuple[np.ndarray, int]:
    """Eigenvectors by descending share of the squared lengths, and how many of them count as leading."""
    values, vectors = np.linalg.eigh(total)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    shares = np.cumsum(values) / max(values.sum(), 1e-300)
    return np.ascontiguousarray(vectors), int(min(len(values), np.searchsorted(shares, LEADING) + 1))


def blocked(rows: DataFrame, size: int, stored: str) -> DataFrame:
    """Rows of each partition by descending length, packed `size` at a time; `band` is the partition's number."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        band = TaskContext.get().partitionId()

        def out(i: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
            most = float(lengths(x).max())
            arrays = [pa.array([band], pa.int32()), pa.array([most]), pa.array([i.tobytes()], pa.binary()), pa.array([x.astype(stored).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=NAMES)

        ids, vectors = np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = matrix(batch.column(1))
            ids = np.concatenate([ids, batch.column(0).to_numpy()])
            vectors = new if vectors is None else np.concatenate([vectors, new])
            while len(ids) >= size:
                yield out(ids[:size], vectors[:size])
                ids, vectors = ids[size:], vectors[size:]
        if len(ids):
            yield out(ids, vectors)

    return rows.sortWithinPartitions(F.desc("_length"), "_id").select("_id", "_v").mapInArrow(packed, BLOCKS)


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(float) ** 2).sum(axis=1))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Whole-number products; in Python's integers where doubles would round."""
    if len(q) and len(c) and float(np.abs(q).max()) * float(np.abs(c).max()) * q.shape[1] >= 2.0**53:
        return q.astype(object).astype(int).astype(object) @ c.astype(object).astype(int).astype(object).T
    return q @ c.T


def kth_best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best score among the candidates; minus infinity where there are fewer."""
    scores = products(q, c).astype(float)
    scores[q_ids[:, None] == c_ids[None, :]] = -np.inf
    if scores.shape[1] < k:
        return np.full(len(q), -np.inf)
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]


def search(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    every: int = EVERY,
    k: int = K,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each row whose id is divisible by `every`.

    Components count as floor(256 * x). All rows but the query's own are candidates; equal scores go to the smaller id.
    Vectors that are NULL or hold NULL or non-finite components and rows without an id take no part, nor do vectors of
    another dimension than most. Repeated rows of one id and vector count once; a row of the query's id is the query's own. Queries with fewer than k
    candidates get them all; an empty table gives no rows. Equal vectors may be any share of the rows: blocks are cut by
    number, not by content. Scores must fit a long.
    """
    spark = rows.sparkSession
    out = "query_id long, rank int, vec_id long, score long"
    # The whole part of 256 times a single-precision number is one itself.
    element = getattr(rows.schema[vector_col].dataType, "elementType", None)
    kind = "float" if isinstance(element, T.FloatType) else "double"
    taken = rows.select(F.col(id_col).cast("long").alias("_id"), whole_numbers(F.col(vector_col)).cast(f"array<{kind}>").alias("_v"))
    taken = taken.filter("_id IS NOT NULL AND _v IS NOT NULL").dropDuplicates(["_id", "_v"])
    squares = F.aggregate(F.col("_v").cast("array<double>"), F.lit(0.0), lambda total, x: total + x * x)
    taken = pin(taken.withColumn("_length", F.sqrt(squares)))
    asks = F.col("_id") % every == 0
    sizes = taken.groupBy(F.size("_v").alias("size")).agg(F.count("*").alias("count"), F.max("_length").alias("most"), F.count(F.when(asks, 1)).alias("asked"))
    sizes = sizes.orderBy(F.desc("count"), "size").take(1)
    if not sizes or not sizes[0]["asked"]:
        return spark.createDataFrame([], out)
    size, number, asked_number = sizes[0]["size"], sizes[0]["count"], sizes[0]["asked"]
    taken = taken.filter(F.size("_v") == size)
    turn, leading = rotation(moments(taken, size))
    single = sizes[0]["most"] ** 2 < SINGLE
    stored = "<i2" if single else "<f4" if kind == "float" else "<f8"
    opens = partial(opened, stored=stored, single=single)

    # Bands of descending length; their number is bounded by the session's partitions.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bands = max(1, min(parts, -(-number // block)))
    by_length = [F.desc("_length"), F.col("_id")]
    candidates = pin(blocked(taken.repartitionByRange(bands, *by_length), block, stored))
    # One block: the first of the first band has the longest vectors of all. No other band is read for it.
    head_ids, head_vectors = opens(*candidates.select("ids", "vectors").head())

    # Stripes by what a task holds; columns so that cells are no more than the session's partitions and copies of the queries about as large as the candidates.
    stripes = -(-asked_number * size // HELD)
    asked = taken.filter(asks).repartitionByRange(max(min(parts, -(-asked_number // query_block)), 4 * stripes), *by_length)
    asked = pin(blocked(asked, query_block, stored))
    del taken
    let_go(spark)
    longest = {row["band"]: row["most"] for row in candidates.groupBy("band").agg(F.max("most").alias("most")).collect()}
    last = max(longest) + 1
    columns = min(last, -(-parts // stripes), max(MIN_COLUMNS, number // asked_number))
    last_asked = asked.agg(F.max("band")).first()[0] + 1

    def aimed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, ids, vectors in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                q_ids, q = opens(ids.as_buffer(), vectors.as_buffer())
                best = kth_best(q_ids, q, head_ids, head_vectors, k)
                own = lengths(q)
                needed = {b * columns // last for b, most in longest.items() if (own * most * (1 + SLACK) >= best).any()}
                cells = [column * stripes + band * stripes // last_asked for column in sorted(needed)]
                arrays = [pa.array([cells], pa.list_(pa.int32())), *(pa.array([x.as_py()], pa.binary()) for x in (ids, vectors)), pa.array([best.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["cells", "ids", "vectors", "best"])

    asked = asked.mapInArrow(aimed, "cells array<int>, ids binary, vectors binary, best binary")
    asked = asked.select(F.explode("cells").alias("cell"), F.lit(float("inf")).alias("most"), "ids", "vectors", "best")
    # A column of candidates meets each stripe.
    first = F.expr(f"cast(band * {columns} div {last} as int)") * stripes
    passing = candidates.select(F.explode(F.sequence(first, first + stripes - 1)).alias("cell"), "most", "ids", "vectors", F.lit(None).cast("binary").alias("best"))
    # One cell in each partition: its queries, then its candidates by descending length.
    cells = asked.unionByName(passing).repartitionById(columns * stripes, F.col("cell")).sortWithinPartitions(F.desc("most"))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, held, room = [], [], Room()
        for batch in batches:
            for most, ids, vectors, best in zip(batch.column(0).to_pylist(), *batch.columns[1:], strict=True):
                these, x = opens(ids.as_buffer(), vectors.as_buffer())
                if best.is_valid:
                    pieces.append((these, x, np.frombuffer(best.as_buffer(), float)))
                    continue
                if pieces:
                    # All queries have come; small blocks are put together.
                    whole, pieces = [np.concatenate(x) for x in zip(*pieces, strict=True)], []
                    held = [Asked(*(x[i : i + query_block] for x in whole), turn, leading, k) for i in range(0, len(whole[0]), query_block)]
                if held:
                    turned = bounding(x, turn, leading)
                    for queries in held:
                        queries.meet(these, x, turned, most, room)
        for queries in held:
            yield queries.hits()

    hits = cells.select("most", "ids", "vectors", "best").mapInArrow(found, "query_id long, vec_id long, score long")
    within = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def bounding(x: np.ndarray, turn: np.ndarray, leading: int) -> np.ndarray:
    """Leading coordinates after the rotation, and the length of the rest: the product of two such rows is no less than that of the vectors, but for rounding."""
    turned = x.astype(float) @ turn
    return np.column_stack([turned[:, :leading], lengths(turned[:, leading:])]).astype(x.dtype)


class Room:
    """Memory for the bounds of a pair of blocks, used again for the next pair."""

    def __init__(self):
        self.bounds, self.marks = np.zeros(0, np.uint8), np.zeros(0, bool)

    def reached(self, q: np.ndarray, c: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where the product of two rows is no less than the query's least."""
        n, m, width = len(q), len(c), -(-len(c) // 8) * 8
        if len(self.bounds) < n * m * q.itemsize or len(self.marks) < n * width:
            self.bounds, self.marks = np.zeros(n * m * q.itemsize, np.uint8), np.zeros(n * width, bool)
        bounds, marks = self.bounds[: n * m * q.itemsize].view(q.dtype).reshape(n, m), self.marks[: n * width].reshape(n, width)
        np.matmul(q, c.T, out=bounds)
        np.greater_equal(bounds, least[:, None], out=marks[:, :m])
        marks[:, m:] = False
        # Few places are marked: eight are looked at at once.
        eights = np.flatnonzero(marks.reshape(-1).view(np.uint64))
        one, place = np.nonzero(marks.reshape(-1, 8)[eights])
        return np.divmod(eights[one] * 8 + place, width)


class Asked:
    """A block of queries and the k best that each has met."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, best: np.ndarray, turn: np.ndarray, leading: int, k: int):
        self.ids, self.q, self.own, self.turned = ids, q, lengths(q), bounding(q, turn, leading)
        # The k-th best score known so far, in this cell or before.
        self.best, self.k = best.copy(), k
        self.scores = np.full((len(ids), k), np.iinfo(np.int64).min)
        self.met = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.slack = max(SLACK, (self.turned.shape[1] + 16) * float(np.finfo(q.dtype).eps))

    def meet(self, c_ids: np.ndarray, c: np.ndarray, c_turned: np.ndarray, most: float, room: Room) -> None:
        """Take in a block of candidates, none longer than `most`."""
        need = self.own * most * (1 + SLACK) >= self.best
        rows = np.flatnonzero(need)
        if not len(rows):
            return
        least = (self.best - self.slack * self.own * most - SLACK)[rows].astype(self.turned.dtype)
        at, to = room.reached(self.turned if need.all() else self.turned[rows], c_turned, least)
        other = self.ids[rows[at]] != c_ids[to]
        at, to = at[other], to[other]
        if not len(at):
            return
        if len(at) * 16 > len(rows) * len(c):
            at, to, scores = firsts(products(self.q[rows], c), self.ids[rows], c_ids, self.k)
        elif c.dtype == float and float(np.abs(self.q).max()) * float(np.abs(c).max()) * c.shape[1] >= 2.0**53:
            scores = products(self.q[rows], c)[at, to].astype(np.int64)
        else:
            places = rows[at]
            scores = np.concatenate([np.einsum("ij,ij->i", self.q[places[i : i + PAIRS]], c[to[i : i + PAIRS]]) for i in range(0, len(at), PAIRS)]).astype(np.int64)
        rows, ids = rows[at], c_ids[to]
        last, last_id = self.scores[rows, -1], self.met[rows, -1]
        keep = (scores >= self.best[rows]) & ((scores > last) | (scores == last) & (ids < last_id))
        if keep.any():
            self.take(rows[keep], ids[keep], scores[keep])

    def take(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Put better candidates among the k best of their queries; equal scores go by the smaller id."""
        some = np.unique(rows)
        rows = np.concatenate([np.repeat(some, self.k), rows])
        ids, scores = np.concatenate([self.met[some].ravel(), ids]), np.concatenate([self.scores[some].ravel(), scores])
        # ~ turns the order of whole numbers round and has no overflow.
        order = np.lexsort((ids, ~scores, rows))
        starts = np.searchsorted(rows[order], some)
        kept = order[starts[:, None] + np.arange(self.k)]
        self.met[some], self.scores[some] = ids[kept], scores[kept]
        full = self.met[some, -1] != np.iinfo(np.int64).max
        self.best[some[full]] = np.maximum(self.best[some[full]], self.scores[some[full], -1])

    def hits(self) -> pa.RecordBatch:
        at, place = np.nonzero(self.scores != np.iinfo(np.int64).min)
        arrays = [pa.array(x) for x in (self.ids[at], self.met[at, place], self.scores[at, place])]
        return pa.RecordBatch.from_arrays(arrays, names=["query_id", "vec_id", "score"])


def firsts(scores: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and scores of each query's k best; equal scores go to the smaller id."""
    order = np.argsort(c_ids, kind="stable")
    scores = scores[:, order]
    scores[q_ids[:, None] == c_ids[order][None, :]] = -np.inf
    kept = scores > -np.inf
    if scores.shape[1] > k:
        least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k, None]
        over, same = scores > least, kept & (scores == least)
        same &= same.cumsum(axis=1) <= k - over.sum(axis=1, keepdims=True)
        kept = over | same
    at, to = np.nonzero(kept)
    return at, order[to], scores[at, to].astype(np.int64)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
