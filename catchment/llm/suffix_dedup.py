"""Repeated substrings by a difference cover, over all texts and inside them.

Every string of `length` bytes that stands at two places is found without sorting all suffixes. Positions are sampled by a
difference cover: residues D modulo `period` such that for any two places i and j some k < period puts both i + k and
j + k into the sample. So two equal strings hold equal strings of `length - period + 1` bytes at sampled positions.

1. Sampled positions are named by a triple of words that spans that many bytes (a fingerprint of the three names). Names
   are sorted, neighbours compared, and names that stand once are done with.
2. The same on longer names: positions whose names repeat are named by their surroundings, all bytes of all strings of
   `length` that cover the triple at the sampled place. Equal surroundings settle all their strings at once.
3. Where a name has different surroundings, the places in between are merged: the strings of `length` bytes at each place
   there, once for each kind of surroundings, are sorted and compared with their neighbours.

Fingerprints stand for bytes, 40 or 48 bits where a false match only costs work, 64 bits where it decides. They are packed by the
task, equal ones of a task are sent once, so a passage of any share of the documents is one entry of each task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import give_back, whole_text
from catchment.llm.presence import passes, presence
from catchment.llm.prints import CHUNK, Prints, mixed
from catchment.session import pin

LENGTH = 200
#: Bytes of text a task packs at a time, and entries of a bucket.
HELD = 4 << 20
BUCKET = 1 << 21
#: Shares of a bucket that are sorted one after the other (a power of two), and rows of a batch that are worked on at a time.
SHARES = 4
ROWS = 512


class Cover(NamedTuple):
    period: int
    residues: tuple[int, ...]

    def holds(self) -> bool:
        differences = {(a - b) % self.period for a in self.residues for b in self.residues}
        return len(differences) == self.period


#: Difference covers with as few residues as there can be (fixed values), by longest string they serve.
COVERS = (Cover(133, (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)), Cover(57, (0, 1, 3, 13, 32, 36, 43, 52)), Cover(13, (0, 1, 3, 9)), Cover(3, (1, 2)))


def cover_for(length: int) -> Cover:
    """The largest cover that leaves names of two thirds of the strings or more, so that shorter repeats end early."""
    return next((cover for cover in COVERS if 3 * (length - cover.period + 1) >= 2 * length), COVERS[-1])


def sampled(cover: Cover, start: int, end: int) -> np.ndarray:
    """Positions of the sample from start to end."""
    first = start // cover.period * cover.period
    grid = (np.arange(first, end, cover.period, dtype=np.int64)[:, None] + np.array(cover.residues)).ravel()
    return grid[(grid >= start) & (grid < end)]


def named(data: bytes, length: int, cover: Cover, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, names) of the sampled positions of a text, chunk by chunk."""
    word = (length - cover.period + 1) // 3
    whole = np.frombuffer(data, np.uint8)
    last = len(data) - 3 * word + 1
    for start in range(0, max(last, 0), CHUNK):
        end = min(start + CHUNK, last)
        prints = Prints(whole[start : end + 3 * word])
        at = sampled(cover, start, end) - start
        triple = [prints.at(at + place * word, at + (place + 1) * word) for place in range(3)]
        # The name of a triple is made of the names of its words.
        name = mixed(triple[0] + mixed(triple[1] + mixed(triple[2])))
        yield at + start, name & np.uint64((1 << 8 * width) - 1)


class Entry(NamedTuple):
    """What one text sends: names, and what tells kinds of one name apart (empty where there is one kind only)."""

    key: int
    names: np.ndarray
    kinds: np.ndarray


REPLIES = "bucket long, answer boolean, keys binary, counts binary, names binary, kinds binary, flags binary"
REPEATED, SENDER = 1, 2


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 7
    types = [pa.int64(), pa.bool_(), *[pa.binary()] * 5]
    names = ["bucket", "answer", "keys", "counts", "names", "kinds", "flags"]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, types, strict=True)], names=names)


def packed(entries: list[Entry], buckets: int, width: int) -> Iterator[pa.RecordBatch]:
    """Entries of a task by bucket of their names: each name and kind once, with whether the task holds it twice.

    What repeats inside the task is answered here; the answers travel with the entries.
    """
    if not entries:
        return
    sizes = [len(entry.names) for entry in entries]
    owners = np.repeat(np.arange(len(entries), dtype=np.uint32), sizes)
    names, kinds = np.concatenate([entry.names for entry in entries]), np.concatenate([entry.kinds for entry in entries])
    held_keys = np.array([entry.key for entry in entries], np.int64)
    entries.clear()
    with_kinds = len(kinds) > 0
    order = np.lexsort((kinds, names)) if with_kinds else np.argsort(names, kind="stable")
    owners, names = owners[order], names[order]
    kinds = kinds[order] if with_kinds else kinds
    fresh = names[1:] != names[:-1]
    if with_kinds:
        fresh |= kinds[1:] != kinds[:-1]
    starts = np.flatnonzero(np.r_[True, fresh])
    many = np.diff(np.r_[starts, len(names)]) > 1
    answered = np.repeat(many, np.diff(np.r_[starts, len(names)]))
    yield from answers(held_keys[owners[answered]], (kinds if with_kinds else names)[answered], buckets, width, with_kinds)
    owners, names = owners[starts], names[starts]
    kinds = kinds[starts] if with_kinds else kinds
    bucket = (mixed(names) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((owners, bucket))
    rows = []
    for some in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
        held, counts = np.unique(owners[some], return_counts=True)
        keys = held_keys[held]
        rows.append((
            int(bucket[some[0]]), False, keys.tobytes(), counts.astype(np.uint32).tobytes(),
            narrow(names[some], width), kinds[some].tobytes() if with_kinds else b"", np.packbits(many[some]).tobytes(),
        ))
    yield rows_of(rows)


def narrow(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def wide(data: bytes | pa.Buffer, width: int) -> np.ndarray:
    values = np.zeros((len(data) // width, 8), np.uint8)
    values[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return values.view("<u8").ravel()


def answers(keys: np.ndarray, values: np.ndarray, buckets: int, width: int, with_kinds: bool, flags: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """What each text is told: its values that repeat, packed by bucket of the text."""
    if not len(keys):
        return
    flags = np.full(len(keys), REPEATED, np.uint8) if flags is None else flags
    bucket = keys % buckets
    order = np.lexsort((keys, bucket))
    keys, values, flags, bucket = keys[order], values[order], flags[order], bucket[order]
    rows = []
    for some in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(bucket)) + 1):
        owners, counts = np.unique(keys[some], return_counts=True)
        data = narrow(values[some], 8 if with_kinds else width)
        rows.append((int(bucket[some[0]]), True, owners.tobytes(), counts.astype(np.uint32).tobytes(), data, None, flags[some].tobytes()))
    yield rows_of(rows)


def repeated(sent: DataFrame, buckets: int, width: int) -> DataFrame:
    """(key, values, flags): for each text its names (kinds, where there are any) that stand elsewhere too.

    Names are sorted and compared with their neighbours. Where a name has several kinds, one text of each kind is its
    sender.
    """

    def judged(names: np.ndarray, kinds: np.ndarray, keys: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Texts to be told, their names or kinds, and flags."""
        with_kinds = len(kinds) > 0
        order = np.lexsort((keys, kinds, names) if with_kinds else (keys, names))
        names, keys, many = names[order], keys[order], many[order]
        kinds = kinds[order] if with_kinds else names
        name_starts = np.r_[True, names[1:] != names[:-1]]
        kind_starts = name_starts | np.r_[True, kinds[1:] != kinds[:-1]]
        firsts = np.flatnonzero(kind_starts)
        # Texts that hold the kind, as the copies of a text may come from several tasks.
        texts = np.add.reduceat(kind_starts | np.r_[True, keys[1:] != keys[:-1]], firsts, dtype=np.int32)
        twice = (texts > 1) | np.logical_or.reduceat(many, firsts)
        flags = np.repeat(np.where(twice, REPEATED, 0).astype(np.uint8), np.diff(np.r_[firsts, len(keys)]))
        if with_kinds:
            heads = np.flatnonzero(name_starts)
            several = np.add.reduceat(kind_starts, heads, dtype=np.int32) > 1
            flags[kind_starts & np.repeat(several, np.diff(np.r_[heads, len(keys)]))] |= SENDER
        told = (flags & SENDER > 0) | ((flags > 0) & ~many)
        return keys[told], kinds[told], flags[told]

    def compared(table: pa.Table) -> pa.Table:
        columns = ["bucket", "keys", "counts", "names", "flags"]
        done = table.filter(table["answer"]).select(columns)
        rows = table.filter(pa.compute.invert(table["answer"])).select(["keys", "counts", "names", "kinds", "flags"])
        total = sum(len(item.as_buffer()) for item in rows["names"]) // width
        if not total:
            return done
        with_kinds = any(len(item.as_buffer()) for item in rows["kinds"])
        names, keys, many = np.empty(total, np.uint64), np.empty(total, np.int64), np.empty(total, bool)
        kinds, at = np.empty(total if with_kinds else 0, np.uint64), 0
        for row in zip(*rows.columns, strict=True):
            owners, counts, some, some_kinds, twice = (item.as_buffer() for item in row)
            end = at + len(some) // width
            names[at:end] = wide(some, width)
            keys[at:end] = np.repeat(np.frombuffer(owners, np.int64), np.frombuffer(counts, np.uint32))
            many[at:end] = np.unpackbits(np.frombuffer(twice, np.uint8))[: end - at]
            if with_kinds:
                kinds[at:end] = np.frombuffer(some_kinds, np.uint64)
            at = end
        parts = []
        for share in range(SHARES):
            own = np.flatnonzero(names & np.uint64(SHARES - 1) == share)
            if len(own):
                parts.append(judged(names[own], kinds[own] if with_kinds else kinds, keys[own], many[own]))
        del names, keys, many, kinds
        texts, values, flags = map(np.concatenate, zip(*parts, strict=True))
        found = [pa.Table.from_batches([batch]).select(columns) for batch in answers(texts, values, buckets, width, with_kinds, flags)]
        return pa.concat_tables([done, *found])

    def sorted_names(key: tuple, table: pa.Table) -> pa.Table:
        found = compared(table)
        give_back()
        return found

    def gathered(key: tuple, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = np.concatenate([np.repeat(np.frombuffer(row["keys"], np.int64), np.frombuffer(row["counts"], np.uint32)) for row in rows])
        given = np.frombuffer(b"".join(row["flags"] for row in rows), np.uint8)
        size = sum(len(row["names"]) for row in rows) // max(len(keys), 1)
        values = np.frombuffer(b"".join(row["names"] for row in rows), np.uint8).reshape(-1, size)
        order = np.argsort(keys, kind="stable")
        owners, counts = np.unique(keys, return_counts=True)
        parts = np.split(order, np.cumsum(counts)[:-1])
        columns = [pa.array([side[part].tobytes() for part in parts], pa.binary()) for side in (values, given)]
        give_back()
        return pa.table([pa.array(owners), *columns], names=["key", "values", "flags"])

    answered = sent.groupBy("bucket").applyInArrow(sorted_names, "bucket long, keys binary, counts binary, names binary, flags binary")
    return answered.groupBy("bucket").applyInArrow(gathered, "key long, values binary, flags binary")


def told(values: pa.Scalar, flags: pa.Scalar, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values of a text and their flags, joined."""
    found = wide(values.as_py(), width)
    given = np.frombuffer(flags.as_py(), np.uint8)
    order = np.argsort(found, kind="stable")
    found, given = found[order], given[order]
    if not len(found):
        return found, given
    starts = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return found[starts], np.bitwise_or.reduceat(given, starts)


def looked_up(values: np.ndarray, found: np.ndarray, given: np.ndarray) -> np.ndarray:
    """The flags of each value; 0 for values that weren't found."""
    if not len(found):
        return np.zeros(len(values), np.uint8)
    at = np.minimum(np.searchsorted(found, values), len(found) - 1)
    return np.where(found[at] == values, given[at], 0).astype(np.uint8)


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of intervals that overlap or touch."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > reach[:-1]]
    return starts[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(starts) - 1]]


def spread(firsts: np.ndarray, lasts: np.ndarray) -> np.ndarray:
    """All places from each first to before its last."""
    sizes = lasts - firsts
    return np.repeat(firsts - np.r_[0, np.cumsum(sizes)[:-1]][: len(sizes)], sizes) + np.arange(sizes.sum())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, fewer at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def text_key(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def described(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, n_bytes, sha256) of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).cast("binary").alias("_data"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [memoryview(item.as_buffer()) for item in batch.column(1)]
            arrays = [pa.array([text_key(item) for item in data], pa.int64()), pa.array([len(item) for item in data], pa.int64())]
            hashes = pa.array([hashlib.sha256(item).hexdigest() for item in data], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, hashes], names=["doc_id", "key", "n_bytes", "sha256"])
        give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(keyed, f"doc_id {kind}, key long, n_bytes long, sha256 string")


def first_names(texts: DataFrame, length: int, cover: Cover, buckets: int, width: int) -> DataFrame:
    """Step 1: the names of the sampled positions of each text."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held, seen = [], 0, set()
        for batch in batches:
            for item in batch.column(0):
                data = item.as_buffer()
                if len(data) < length or (key := text_key(data)) in seen:
                    continue
                seen.add(key)
                for _, names in named(data, length, cover, width):
                    entries.append(Entry(key, names, np.zeros(0, np.uint64)))
                held += len(data)
                if held >= HELD:
                    yield from packed(entries, buckets, width)
                    entries, held, seen = [], 0, set()
        yield from packed(entries, buckets, width)
        give_back()

    return texts.mapInArrow(sent, REPLIES)


def chosen_texts(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """(key, data) of the texts of the keys, each once; other texts are read but not moved."""
    bits = presence(keys)

    def taken(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([text_key(item.as_buffer()) for item in batch.column(0)], np.int64)
            keep = pa.array(passes(bits, found), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()).filter(keep), batch.column(0).filter(keep)], names=["key", "data"])
        give_back()

    return texts.mapInArrow(taken, "key long, data binary").dropDuplicates(["key"])


SEGMENTS = "key long, size long, offset long, floor long, data binary, hits binary"


def segments(texts: DataFrame, replies: DataFrame, length: int, cover: Cover, width: int) -> DataFrame:
    """The parts of texts around sampled positions whose names repeat, with those positions."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = batch.column(1)[row].as_buffer()
                found, given = told(batch.column(2)[row], batch.column(3)[row], width)
                hits = [at[looked_up(names, found, given) > 0] for at, names in named(data, length, cover, width)]
                hits = np.concatenate(hits) if hits else np.zeros(0, np.int64)
                low, high = np.maximum(hits - cover.period + 1, 0), np.minimum(hits + length, len(data))
                rows = []
                for start, end in zip(*merged(low, high), strict=True):
                    inside = hits[np.searchsorted(hits, start) : np.searchsorted(hits, end)]
                    floor = int(start)  # a place is sent by one part only, though the parts of a long text overlap
                    for group in np.split(inside, np.flatnonzero(np.diff(inside // CHUNK)) + 1):
                        first, last = max(group[0] - cover.period + 1, 0), min(group[-1] + length, len(data))
                        rows.append((len(data), int(first), floor, bytes(data[first:last]), (group - first).astype(np.uint32).tobytes()))
                        floor = int(group[-1]) + 1
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                kinds = [*[pa.int64()] * 3, *[pa.binary()] * 2]
                arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
                keys = pa.array([batch.column(0)[row].as_py()] * len(rows), pa.int64())
                yield pa.RecordBatch.from_arrays([keys, *arrays], names=["key", "size", "offset", "floor", "data", "hits"])
        give_back()

    return texts.join(replies, "key").select("key", "data", "values", "flags").mapInArrow(cut, SEGMENTS)


def surroundings(data: bytes, size: int, offset: int, hits: bytes, length: int, cover: Cover) -> tuple[np.ndarray, ...]:
    """(names, kinds, first places, last places) of the strings that cover each hit's triple, relative to the part."""
    word = (length - cover.period + 1) // 3
    prints = Prints(np.frombuffer(data, np.uint8))
    at = np.frombuffer(hits, np.uint32).astype(np.int64)
    low, high = np.maximum(at - cover.period + 1, -offset), np.minimum(at + length, size - offset)
    names = prints.at(at, at + 3 * word)
    return names, mixed(prints.at(low, high) + (at - low).astype(np.uint64)), low, np.minimum(at, size - length - offset)


def second_names(parts: DataFrame, length: int, cover: Cover, buckets: int) -> DataFrame:
    """Step 2: the names of repeated positions with their surroundings as kinds."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0
        for batch in slices(batches):
            for key, size, offset, data, hits in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                names, kinds, _, _ = surroundings(data, size, offset, hits, length, cover)
                entries.append(Entry(key, names, kinds))
                held += len(data)
                if held >= HELD:
                    yield from packed(entries, buckets, 8)
                    entries, held = [], 0
        yield from packed(entries, buckets, 8)
        give_back()

    return parts.select("key", "size", "offset", "data", "hits").mapInArrow(sent, REPLIES)


def settled(parts: DataFrame, replies: DataFrame, length: int, cover: Cover) -> DataFrame:
    """(key, starts, ends, firsts, lasts, prints): runs of bytes that repeat, and the strings a sender has to have compared."""

    def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "starts", "ends", "firsts", "lasts", "prints"]
        for batch in slices(batches):
            rows = []
            for row in range(batch.num_rows):
                key, size, offset, data, hits, floor = (batch.column(at)[row].as_py() for at in range(6))
                _, kinds, first, last = surroundings(data, size, offset, hits, length, cover)
                flags = looked_up(kinds, *told(batch.column(6)[row], batch.column(7)[row], 8))
                some = last >= first
                known = some & (flags & REPEATED > 0)
                starts, ends = merged(first[known], last[known] + length)
                send = some & (flags & SENDER > 0)
                firsts, lasts = merged(first[send], last[send] + 1)
                firsts = np.maximum(firsts, floor - offset)
                firsts, lasts = firsts[firsts < lasts], lasts[firsts < lasts]
                places = spread(firsts, lasts)
                prints = Prints(np.frombuffer(data, np.uint8)).at(places, places + length)
                rows.append((key, *((side + offset).tobytes() for side in (starts, ends, firsts, lasts)), prints.tobytes()))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            kinds_ = [pa.int64(), *[pa.binary()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(columns, kinds_, strict=True)], names=names)
        give_back()

    both = parts.join(replies, "key").select("key", "size", "offset", "data", "hits", "floor", "values", "flags")
    return both.mapInArrow(told_apart, "key long, starts binary, ends binary, firsts binary, lasts binary, prints binary")


def third_names(places: DataFrame, buckets: int) -> DataFrame:
    """Step 3: the strings of the places in between."""

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries, held = [], 0
        for batch in slices(batches):
            for key, prints in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                entries.append(Entry(key, np.frombuffer(prints, np.uint64), np.zeros(0, np.uint64)))
                held += len(prints)
                if held >= HELD:
                    yield from packed(entries, buckets, 8)
                    entries, held = [], 0
        yield from packed(entries, buckets, 8)
        give_back()

    return places.select("key", "prints").filter(F.length("prints") > 0).mapInArrow(sent, REPLIES)


def runs(parts: DataFrame, replies: DataFrame, length: int) -> DataFrame:
    """(key, starts, ends) of all runs of bytes that repeat, a row for each text that has any."""

    def covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, firsts, lasts = [], [], []
            for row in range(batch.num_rows):
                parts_ = batch.column(1)[row].as_py()
                starts = [np.frombuffer(part["starts"], np.int64) for part in parts_]
                ends = [np.frombuffer(part["ends"], np.int64) for part in parts_]
                if batch.column(2)[row].is_valid:
                    runs_ = [[np.frombuffer(part[side], np.int64) for part in parts_] for side in ("firsts", "lasts")]
                    places = spread(*map(np.concatenate, runs_))
                    prints = np.concatenate([np.frombuffer(part["prints"], np.uint64) for part in parts_])
                    places = places[looked_up(prints, *told(batch.column(2)[row], batch.column(3)[row], 8)) > 0]
                    starts, ends = [*starts, places], [*ends, places + length]
                first, last = merged(np.concatenate(starts), np.concatenate(ends))
                if len(first):
                    keys.append(batch.column(0)[row].as_py())
                    firsts.append(first.tobytes())
                    lasts.append(last.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(firsts, pa.binary()), pa.array(lasts, pa.binary())], names=["key", "starts", "ends"])
        give_back()

    whole = parts.groupBy("key").agg(F.collect_list(F.struct("starts", "ends", "firsts", "lasts", "prints")).alias("parts"))
    return whole.join(replies, "key", "left").select("key", "parts", "values", "flags").mapInArrow(covered, "key long, starts binary, ends binary")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends) for each row.

    A byte goes if a string of `length` bytes that covers it also starts anywhere else, in the same text or another;
    strings never run from one text into another and are judged on the input. `starts` and `ends` are the removed runs.

    NULL and empty texts have no bytes. Texts that stand twice or more are worked on once, and go whole if they are long
    enough. Rows that repeat an id are rows like others, a NULL id stays NULL, other columns are ignored, and an empty
    table gives no rows. Very long texts are worked on in chunks. Texts are told apart by 64-bit hashes.
    """
    cover = cover_for(length)
    rows = pin(described(docs, id_col, text_col))
    texts = docs.select(whole_text(text_col).cast("binary").alias("_data"))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    samples = total * len(cover.residues) // cover.period
    buckets = max(1, -(-samples // BUCKET))
    # First names only choose candidates: one in 256 or fewer may match by chance.
    width = min(6, max(5, (samples.bit_length() + 15) // 8))

    replies = pin(repeated(first_names(texts, length, cover, buckets, width), buckets, width))
    parts = pin(segments(chosen_texts(texts, replies.select("key")), replies, length, cover, width))
    again = repeated(second_names(parts, length, cover, buckets), buckets, 8)
    apart = pin(settled(parts, again, length, cover))
    rest = repeated(third_names(apart, buckets), buckets, 8)
    found = pin(runs(apart, rest, length))

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for row in range(batch.num_rows):
                data, kept, at = batch.column(1)[row].as_buffer(), hashlib.sha256(), 0
                starts, ends = (np.frombuffer(batch.column(side)[row].as_py(), np.int64).tolist() for side in (2, 3))
                for start, end in zip(starts, ends, strict=True):
                    kept.update(memoryview(data)[at:start])
                    at = end
                kept.update(memoryview(data)[at:])
                hashes.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays([*(batch.column(at) for at in (0, 2, 3)), pa.array(hashes, pa.string())], names=["key", "starts", "ends", "kept"])
        give_back()

    with_runs = chosen_texts(texts, found.select("key")).join(found, "key").select("key", "data", "starts", "ends")
    cut = with_runs.mapInArrow(shortened, "key long, starts binary, ends binary, kept string")

    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    joined = rows.join(copies, "key", "left").join(cut, "key", "left")
    gone = F.col("_copies").isNotNull() & (F.col("n_bytes") >= length)
    kept = F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha256"))
    rows_out = joined.select("doc_id", "n_bytes", gone.alias("_gone"), kept.alias("kept_sha256"), "starts", "ends")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows_out.mapInArrow(
        opened, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, starts array<long>, ends array<long>"
    )


def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed runs as lists, with their number and length; a text that goes whole is one run."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "starts", "ends"]
    for batch in batches:
        sizes, gone = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        firsts, lasts = [], []
        for size, whole, start, end in zip(sizes, gone, batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            firsts.append([0] if whole else np.frombuffer(start, np.int64).tolist() if start else [])
            lasts.append([size] if whole else np.frombuffer(end, np.int64).tolist() if end else [])
        removed = [sum(last) - sum(first) for first, last in zip(firsts, lasts, strict=True)]
        arrays = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array([len(first) for first in firsts], pa.int64()), batch.column(3)]
        arrays += [pa.array(side, pa.list_(pa.int64())) for side in (firsts, lasts)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)
