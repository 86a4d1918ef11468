"""Similarity join on word shingles: documents whose Jaccard similarity is 0.8 or more, and the classes they form.

Texts with the same set of shingles are one set from the start. Sets that can link share one of their rarest shingles
(prefix filter), so each set goes to the groups of those. In a group the sets stand by size, without those whose place in the
prefix leaves no other to link to; of groups of the same sets one stays. First each set is compared
with one leader of its groups, which settles groups of copies without their pairs. Groups that still hold more than one
component are cut into size-banded tiles: bit counts of hashed parity bitmaps bound the overlap from above, first of short
ones, then of ones as wide as the set is large. Pairs of different components that pass are compared exactly, by
intersection of their sorted arrays.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.llm.common import give_back, let_go, whole_text
from catchment.llm.components import components
from catchment.llm.presence import passes, presence
from catchment.llm.prints import CHUNK, mixed
from catchment.llm.shingles import set_key, sets_in
from catchment.session import pin

#: Similarity in percent.
PERCENT = 80
#: Counters that order shingles by how frequent they are. The order is free, so their size can't change results.
SKETCH = 1 << 19
SLICES = 64
#: Bits of a short parity bitmap; a wide one has about one for each shingle.
BITS = 2048
#: Entries of a bucket, members of a part of a group, and sets of a tile's side.
BUCKET = 1 << 20
PART_BITS = 16
TILE = 512


def prefix_size(number: int, percent: int) -> int:
    """So many of its first shingles a set shares at least one of with each set it links to."""
    return number - -(-percent * number // 100) + 1


def first_places(number: int, percent: int) -> int:
    """So many of a set's first places can be the first that it shares with a set it links to, of its size or larger."""
    return number - -(-2 * percent * number // (100 + percent)) + 1


def bitmap(hashes: np.ndarray, bits: int = BITS) -> bytes:
    """Parity of the number of shingles at each bit."""
    return np.packbits((np.bincount((hashes & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def width(number: int) -> int:
    """Bits of a wide bitmap: a short one is full where sets have several thousand shingles, and tells none apart."""
    return max(BITS, 1 << (number - 1).bit_length())


def folded(wide: np.ndarray, words: int) -> np.ndarray:
    """The narrower bitmap of so many 64-bit words that a wide one holds."""
    return np.bitwise_xor.reduce(wide.reshape(-1, words), axis=0)


def linked(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * common >= percent * (len(first) + len(second) - common)


def sketch_rows(counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
    for number, part in enumerate(counts.reshape(SLICES, -1)):
        if part.any():
            yield number, zlib.compress(part.tobytes(), 1)


def added(rows: DataFrame) -> np.ndarray:
    """Sum of the counters of all tasks; the result is as large as the sketch, whatever the input."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(zlib.decompress(part), np.uint32).astype(np.uint64) for part in table["counts"].to_pylist())
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    total = np.zeros((SLICES, SKETCH // SLICES), np.uint64)
    for row in rows.groupBy("slice").applyInArrow(merge, "slice int, counts binary").collect():
        total[row["slice"]] = np.frombuffer(row["counts"], np.uint64)
    return total.ravel()


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, key, text_key) of each document, and each task's counters as rows (slice, counts)."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n", "key", "text_key", "slice", "counts"]
        counts = np.zeros(SKETCH, np.uint32)
        seen: set[int] = set()
        for batch in batches:
            sizes, keys, fresh = [], [], []
            for found in sets_in(batch.column(1)):
                sizes.append(len(found))
                keys.append(set_key(found) if len(found) else None)
                if len(found) and keys[-1] not in seen:
                    if len(seen) > 1 << 18:
                        seen.clear()
                    seen.add(keys[-1])
                    fresh.append((found % np.uint64(SKETCH)).astype(np.int32))
            if fresh:
                counts += np.bincount(np.concatenate(fresh), minlength=SKETCH).astype(np.uint32)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), text_keys(batch.column(1)), none.cast(pa.int32()), none.cast(pa.binary())], names=names)
        parts = list(sketch_rows(counts))
        give_back()
        none = pa.nulls(len(parts)).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.binary())], names=names)

    return rows.mapInArrow(described, "id long, n long, key long, text_key long, slice int, counts binary")


def text_keys(texts: pa.Array) -> pa.Array:
    """A quick hash of each text, to find texts again without working out their shingles."""
    return pa.array([xxhash.xxh3_64_intdigest(text.as_buffer()) - (1 << 63) if text.is_valid else None for text in texts], pa.int64())


#: The size is negative where the place of the shingle lets the set link to smaller ones only.
ENTRY = np.dtype([("shingle", "<u8"), ("key", "<i8"), ("n", "<i4")])


def prefixes(docs: DataFrame, text_col: str, levels: np.ndarray, buckets: int, percent: int) -> DataFrame:
    """Prefix shingles of each distinct set, packed by bucket of the shingle; frequent shingles are dealt to parts by set."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            if not parts:
                return
            entries = np.concatenate(parts)
            spread = spread_bits(entries["shingle"], levels)
            part = mixed(entries["key"].astype(np.uint64)) & ((np.uint64(1) << spread.astype(np.uint64)) - np.uint64(1))
            bucket = (mixed(entries["shingle"] + part) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            entries, bucket = entries[order], bucket[order]
            for some in np.split(np.arange(len(entries)), np.flatnonzero(np.diff(bucket)) + 1):
                yield pa.RecordBatch.from_arrays([pa.array([bucket[some[0]]]), pa.array([entries[some].tobytes()], pa.binary())], names=["bucket", "entries"])

        parts, held, seen = [], 0, set()
        for batch in batches:
            for found in sets_in(batch.column(0)):
                if not len(found) or (key := set_key(found)) in seen:
                    continue
                seen.add(key)
                first = prefix_size(len(found), percent)
                rare = found[np.lexsort((found, levels[(found % np.uint64(SKETCH)).astype(np.int64)]))[:first]]
                entries = np.empty(first, ENTRY)
                entries["shingle"], entries["key"], entries["n"] = rare, key, len(found)
                entries["n"][first_places(len(found), percent) :] *= -1
                parts.append(entries)
                held += first
                if held >= BUCKET // 2:
                    yield from out(parts)
                    parts, held, seen = [], 0, set()
        yield from out(parts)
        give_back()

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(packed, "bucket long, entries binary")


def spread_bits(shingle: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Bits of the set's key that deal a frequent shingle's sets to parts; none for most."""
    return np.maximum(levels[(shingle % np.uint64(SKETCH)).astype(np.int64)].astype(np.int64) - PART_BITS, 0)


def with_partner(runs: np.ndarray, n: np.ndarray, early: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set's run, ordered by size, holds another it can link to: the smaller one of the two is early, or both of one size."""
    base = runs << 32
    place = base | n
    before = np.r_[0, np.cumsum(early)]
    low, high = np.searchsorted(place, base | -(-percent * n // 100)), np.searchsorted(place, base | (100 * n // max(percent, 1)), side="right")
    same, over = np.searchsorted(place, place), np.searchsorted(place, place, side="right")
    return (before[same] > before[low]) | (early & ((high > over) | (before[over] - before[same] > 1)))


def grouped(packed: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """Groups of two sets or more: (shingle, parted, keys, sizes, leaders), by size.

    A group ends where the next larger set is too large to link. The leader of a set is the first it can link to. Parts of
    a frequent shingle are kept whole, as their sets may link to those of other parts.
    """

    def groups(key: tuple, table: pa.Table) -> pa.Table:
        entries = np.frombuffer(b"".join(table["entries"].to_pylist()), ENTRY)
        entries = entries[np.lexsort((entries["key"], np.abs(entries["n"]), entries["shingle"]))]
        other = entries["shingle"][1:] != entries["shingle"][:-1]
        entries = entries[np.r_[True, other | (entries["key"][1:] != entries["key"][:-1])][: len(entries)]]
        other = entries["shingle"][1:] != entries["shingle"][:-1]
        runs = np.cumsum(np.r_[False, other][: len(entries)])
        parted = spread_bits(entries["shingle"], levels) > 0
        keep = parted | with_partner(runs, np.abs(entries["n"].astype(np.int64)), entries["n"] > 0, percent)
        entries, parted = entries[keep], parted[keep]
        other = entries["shingle"][1:] != entries["shingle"][:-1]
        sizes_of = np.abs(entries["n"])
        n = sizes_of.astype(np.int64)
        ends_here = other | ((100 * n[:-1] < percent * n[1:]) & ~parted[1:])
        starts = np.flatnonzero(np.r_[True, ends_here][: len(entries)])
        ends = np.r_[starts[1:], len(entries)] if len(starts) else starts
        useful = (ends - starts > 1) | parted[starts]
        rows, known = [], set()
        for start, end in zip(starts[useful], ends[useful], strict=True):
            keys, sizes = entries["key"][start:end], n[start:end]
            content = keys.tobytes()
            if content in known and not parted[start]:  # the same sets met at another shingle
                continue
            known.add(content)
            leaders = keys[np.searchsorted(sizes, -(-percent * sizes // 100))]
            rows.append((int(entries["shingle"][start]) - (1 << 63), bool(parted[start]), content, sizes_of[start:end].tobytes(), leaders.tobytes()))
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(("shingle", "parted", "keys", "sizes", "leaders"), columns, kinds, strict=True)})

    return packed.groupBy("bucket").applyInArrow(groups, "shingle long, parted boolean, keys binary, sizes binary, leaders binary")


def members(groups: DataFrame) -> DataFrame:
    """One row (shingle, part, key, n, leader) for each set of a group; groups of the same sets are one, unless parts of a shingle."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shingle, part, keys, sizes, leaders in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                k, n, m = np.frombuffer(keys, np.int64), np.frombuffer(sizes, np.int32), np.frombuffer(leaders, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(k), shingle)), pa.array(np.full(len(k), part)), pa.array(k), pa.array(n), pa.array(m)],
                    names=["shingle", "part", "key", "n", "leader"],
                )

    columns = groups.withColumn("part", F.xxhash64("keys")).withColumn("_of", F.when(F.col("parted"), F.col("shingle")))
    columns = columns.dropDuplicates(["part", "_of"]).select("shingle", "part", "keys", "sizes", "leaders")
    return columns.mapInArrow(opened, "shingle long, part long, key long, n int, leader long")


def one_text(described: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, text_key): for each set of the keys the text that stands for it."""
    rows = described.filter("key IS NOT NULL").join(keys.distinct(), "key", "left_semi")
    return pin(rows.groupBy("key").agg(F.min("text_key").alias("text_key")))


def sets_of(docs: DataFrame, text_col: str, wanted: DataFrame, whole: bool) -> DataFrame:
    """(text_key, n, value, short) of the wanted texts: the whole set of each, or its wide and its short bitmap.

    Other texts are read, but neither worked out nor moved; a few may slip through and meet nothing later.
    """
    bits = presence(wanted.select("text_key"))

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            found = text_keys(batch.column(0))
            keys = found.fill_null(0).to_numpy()
            at = []
            for row in np.flatnonzero(passes(bits, keys)).tolist():
                if keys[row] not in seen:
                    seen.add(keys[row])
                    at.append(row)
            if len(seen) > 1 << 18:
                seen.clear()
            # So many texts at a time as hold a few megabytes, as their sets are larger than they are.
            lengths = pc.binary_length(batch.column(0)).fill_null(0).to_numpy()[at]
            for some in np.split(np.array(at, np.int64), np.flatnonzero(np.diff(np.cumsum(lengths) // (CHUNK << 2))) + 1):
                rows = pa.array(some, pa.int64())
                sizes, values, short = [], [], []
                for hashes in sets_in(batch.column(0).take(rows)):
                    sizes.append(len(hashes))
                    values.append(hashes.tobytes() if whole else bitmap(hashes, width(len(hashes))))
                    short.append(None if whole else folded(np.frombuffer(values[-1], np.uint64), BITS // 64).tobytes())
                columns = [found.take(rows), pa.array(sizes, pa.int32()), pa.array(values, pa.binary()), pa.array(short, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["text_key", "n", "value", "short"])
        give_back()

    found = docs.select(F.col(text_col).alias("_text")).mapInArrow(taken, "text_key long, n int, value binary, short binary")
    return found.dropDuplicates(["text_key"])


def words_in(column: pa.Array) -> np.ndarray:
    """The 64-bit words of a column of binary values without NULL, one value behind the other, without a copy."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(np.uint64)


def with_room(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose wide bitmaps leave room for a link."""

    def differing(one: pa.Scalar, other: pa.Scalar) -> int:
        x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (one, other))
        words = min(len(x), len(y))
        return int(np.bitwise_count(folded(x, words) ^ folded(y, words)).sum())

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = batch.column(2).to_numpy().astype(np.int64) + batch.column(3).to_numpy()
            differ = np.array([differing(*sides) for sides in zip(batch.column(4), batch.column(5), strict=True)], np.int64)
            keep = pa.array(room(differ, both, percent), pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(at).filter(keep) for at in (0, 1)], names=["a", "b"])

    left = bitmaps.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("wide").alias("_one"))
    right = bitmaps.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("wide").alias("_other"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "_one", "_other")
    return both.mapInArrow(compared, "a long, b long")


def room(differ: np.ndarray, both: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of `both` shingles together can link, given how many bits of their bitmaps differ.

    common <= (both - differ) / 2, and a link needs 100 * common >= percent * (both - common).
    """
    return (100 + percent) * (both - differ) >= 2 * percent * both


def verified(pairs: DataFrame, wanted: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link, by exact intersection."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2), batch.column(3), strict=True)
            keep = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in sides]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    texts = [wanted.select(F.col("key").alias(side), F.col("text_key").alias(f"_text_{side}")) for side in ("a", "b")]
    placed = pairs.join(texts[0], "a").join(texts[1], "b")
    # Sets are dealt out once, by text, for both joins.
    left = sets.select(F.col("text_key").alias("_text_a"), F.col("value").alias("_first"))
    right = sets.select(F.col("text_key").alias("_text_b"), F.col("value").alias("_second"))
    both = placed.join(left, "_text_a").join(right, "_text_b").select("a", "b", "_first", "_second")
    return both.mapInArrow(checked, "a long, b long")


def forest(a: np.ndarray, b: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Positions of the pairs of a spanning forest that takes the pairs with the fewest differences first."""
    over: dict[int, int] = {}

    def top(node: int) -> int:
        while (above := over.get(node, node)) != node:
            over[node] = node = over.get(above, above)
        return node

    kept = []
    for at in np.argsort(differ, kind="stable").tolist():
        one, other = top(int(a[at])), top(int(b[at]))
        if one != other:
            over[one] = other
            kept.append(at)
    return np.array(kept, np.int64)


class Side:
    """One side of the tiles of a batch: the members of all tiles, one after the other."""

    def __init__(self, column: pa.Array) -> None:
        sets = column.flatten()
        self.sizes = column.value_lengths().to_numpy().astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.key, self.component = sets.field("key").to_numpy(), sets.field("component").to_numpy()
        self.n = sets.field("n").to_numpy().astype(np.int64)
        self.maps = words_in(sets.field("bitmap")).reshape(len(sets), -1)


def pairs_with_room(one: Side, other: Side, cells: np.ndarray, tiles: np.ndarray, first: int, most: int, percent: int) -> np.ndarray:
    """(tile, i, j, share of bits that differ) of the pairs of some tiles, from the first-th on, that may link."""
    ends = np.cumsum(cells[tiles])
    number = np.arange(first, min(first + most, ends[-1]))
    place = np.searchsorted(ends, number, side="right")
    tile = tiles[place]
    number = number - (ends - cells[tiles])[place]
    i, j = one.starts[tile] + number // other.sizes[tile], other.starts[tile] + number % other.sizes[tile]
    n1, n2 = one.n[i], other.n[j]
    keep = (one.component[i] != other.component[j]) & (100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2))
    tile, i, j = tile[keep], i[keep], j[keep]
    both = one.n[i] + other.n[j]
    differ = np.concatenate([np.zeros(0, np.int64), *(np.bitwise_count(one.maps[i[at : at + 8192]] ^ other.maps[j[at : at + 8192]]).sum(axis=1, dtype=np.int64) for at in range(0, len(i), 8192))])
    keep = room(differ, both, percent)
    return np.stack([tile[keep], i[keep], j[keep], differ[keep] * 1_000_000 // np.maximum(both[keep], 1)])


def tiled(sides: DataFrame, components: DataFrame, bitmaps: DataFrame, percent: int, spanning: bool) -> DataFrame:
    """Pairs (shingle, a, b) of different components in a group whose bitmaps leave room for a link.

    All of them, or with `spanning` only those of each tile's likeliest spanning forest of components.
    """
    marked = sides.select("shingle", "part", "key", "n").join(components.withColumnRenamed("node", "key"), "key", "left")
    marked = marked.withColumn("component", F.coalesce("component", "key"))
    split = marked.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    rest = marked.join(split.select("shingle"), "shingle", "left_semi")
    place = Window.partitionBy("shingle", "part").orderBy("n", "key")
    numbered = rest.withColumn("block", F.floor((F.row_number().over(place) - 1) / TILE))
    side = numbered.join(bitmaps.select("key", "bitmap"), "key")
    packed = side.groupBy("shingle", "part", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.collect_list(F.struct("key", "n", "component", "bitmap")).alias("sets")
    )
    first = packed.select(*[F.col(name).alias(f"{name}_1") for name in packed.columns])
    second = packed.select(*[F.col(name).alias(f"{name}_2") for name in packed.columns])
    # Blocks of one shingle meet, each pair of blocks once, if their sizes can link.
    ordered = (F.col("part_1") < F.col("part_2")) | ((F.col("part_1") == F.col("part_2")) & (F.col("block_1") <= F.col("block_2")))
    near = (100 * F.col("high_1") >= percent * F.col("low_2")) & (100 * F.col("high_2") >= percent * F.col("low_1"))
    tiles = first.join(second, (F.col("shingle_1") == F.col("shingle_2")) & ordered & near).select("sets_1", "sets_2", "shingle_1")

    def told(held: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.concatenate([np.zeros((3, 0), np.int64), *held], axis=1)
        return pa.RecordBatch.from_arrays([pa.array(side) for side in pairs], names=["shingle", "a", "b"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            one, other = Side(batch.column(0)), Side(batch.column(1))
            cells, shingles = one.sizes * other.sizes, batch.column(2).to_numpy()
            # About as many pairs at a time as fit a core's cache; what is left of them goes on before more are compared,
            # as in a group of near copies all pairs have room.
            for tiles_ in np.split(np.arange(len(cells)), np.flatnonzero(np.diff(np.cumsum(cells) // (1 << 15))) + 1):
                found = [pairs_with_room(one, other, cells, tiles_, part, 1 << 18, percent) for part in range(0, int(cells[tiles_].sum()), 1 << 18)]
                tile, i, j, share = np.concatenate([np.zeros((4, 0), np.int64), *found], axis=1)
                if not len(tile):
                    continue
                if spanning:
                    kept = [some[forest(one.component[i[some]], other.component[j[some]], share[some])] for some in np.split(np.arange(len(tile)), np.flatnonzero(np.diff(tile)) + 1)]
                    tile, i, j = (side[np.concatenate(kept)] for side in (tile, i, j))
                a, b = one.key[i], other.key[j]
                pairs = np.unique(np.stack([shingles[tile], np.minimum(a, b), np.maximum(a, b)]), axis=1)
                held.append(pairs)
                if sum(some.shape[1] for some in held) >= 1 << 17:
                    yield told(held)
                    held.clear()
        yield told(held)
        give_back()

    return tiles.mapInArrow(compared, "shingle long, a long, b long")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row; the component is the smallest id that links lead to.

    Two rows link when the Jaccard similarity of their sets of five-word shingles is at least `percent` hundredths.
    Texts of fewer words have their whole sequence as one shingle. NULL texts and texts without words have no shingles
    and link with nothing. Rows that repeat an id share their component where their texts link; a NULL id never names a
    component unless all its rows have none. Other columns are ignored, and an empty table gives no rows. Sets are told
    apart by 64-bit values and shingles by 64-bit hashes; links are checked on whole sets.
    """
    spark = docs.sparkSession
    described = pin(describe(docs, id_col, text_col))
    rows = described.filter("slice IS NULL").select("id", "n", "key", "text_key")
    levels = np.floor(np.log2(added(described.filter("slice IS NOT NULL").select("slice", "counts")).astype(float) + 1)).astype(np.uint8)
    total = rows.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total * (100 - percent) // 100 // BUCKET))

    sides = pin(members(grouped(prefixes(docs, text_col, levels, buckets, percent), levels, percent)))
    wanted = one_text(rows, sides.select("key"))
    bitmaps = pin(sets_of(docs, text_col, wanted, whole=False).join(wanted, "text_key").select("key", "n", F.col("value").alias("wide"), F.col("short").alias("bitmap")))
    let_go(spark)
    # One leader for each set, the smallest of those its groups have; parts of one shingle meet in their first sets.
    heads = Window.partitionBy("shingle").orderBy("n", "key")
    first = sides.groupBy("shingle", "part").agg(F.min(F.struct("n", "key")).alias("head")).select("shingle", "head.*")
    joints = first.select("key", F.lag("key").over(heads).alias("leader")).filter("leader IS NOT NULL AND key <> leader")
    stars = sides.filter("key <> leader").groupBy("key").agg(F.min("leader").alias("leader")).unionByName(joints).distinct()
    pairs = stars.select(F.col("key").alias("a"), F.col("leader").alias("b"))
    links = spark.createDataFrame([], "a long, b long")
    pairs = pin(with_room(pairs, bitmaps, percent).distinct())
    # Later turns compare what the components so far leave apart: the likeliest pairs, then all pairs that have room.
    for turn in range(3):
        if turn:
            found = pin(tiled(sides, components(links), bitmaps, percent, spanning=turn == 1))
            # Groups without any pair of room have none later, when components are larger.
            sides = sides.join(found.select("shingle").distinct(), "shingle", "left_semi")
            pairs = pin(with_room(found.select("a", "b").distinct(), bitmaps, percent))
            let_go(spark)
        ends = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key")))
        # Worked out for either end anew rather than stored: whole sets are larger than the texts.
        wanted = one_text(rows, ends)
        links = pin(links.unionByName(verified(pairs, wanted, sets_of(docs, text_col, wanted, whole=True), percent)))
        let_go(spark)
    joined = components(links).withColumnRenamed("node", "key")

    placed = pin(rows.join(joined, "key", "left").withColumn("component", F.coalesce("component", "key")))
    smallest = placed.filter("key IS NOT NULL").groupBy("component").agg(F.min("id").alias("component_id"))
    return placed.join(smallest, "component", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id")
    )
