"""Best-fit packing of documents into token sequences.

Best-fit decreasing looks at lengths only, and there are as many lengths as a sequence has tokens. So the packing is
planned on the count of pieces by length: pieces of one length are placed together, and bins that were filled alike are
one entry. A segment tree over remaining capacities finds the tightest open bins. The plan is as small as the capacity
allows, whatever the number of documents; each piece then looks its place up by its rank among the pieces of its length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catchment.llm.common import give_back, whole_text, worker_cache
from catchment.session import pin

TOKENIZER = "word_bpe_49k.json"
CAPACITY = 2048
#: Token id after each document.
END = 0
#: Bytes of words and ids that a worker remembers, by estimate, and what an entry takes beside its content.
REMEMBER = 192 << 20
ENTRY_BYTES = 200
#: Pieces of one length are ranked in so many groups by a hash of their id, so that a frequent length isn't one task.
SALTS = 64


_LETTERS = re.compile("[a-zß-öø-ÿ]+")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in prints]
    return {byte: chr(byte) for byte in prints} | {byte: chr(256 + at) for at, byte in enumerate(hidden)}


_BYTES = byte_letters()


class Capacities:
    """Segment tree over remaining capacities: which of them some open bin has."""

    def __init__(self, most: int) -> None:
        self.size = 1 << most.bit_length()
        self.counts = [0] * (2 * self.size)

    def add(self, capacity: int, bins: int) -> None:
        at = capacity + self.size
        while at:
            self.counts[at] += bins
            at >>= 1

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least `least` that a bin has."""
        at = least + self.size
        if self.counts[at]:
            return least
        while at > 1:
            if at % 2 == 0 and self.counts[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.counts[2 * at] else 2 * at + 1
                return at - self.size
            at >>= 1
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over piece counts by length, as (length, first rank, pieces, first bin, offset).

    The pieces of a length are ranked from 0; those of an entry go to consecutive bins, each at the same offset.
    """
    tree = Capacities(capacity)
    open_bins: dict[int, list[tuple[int, int]]] = {}
    entries, bins = [], 0

    def put(left: int, first: int, number: int) -> None:
        if left and number:
            open_bins.setdefault(left, []).append((first, number))
            tree.add(left, number)

    for length in sorted(counts, reverse=True):
        rank, pieces = 0, counts[length]
        while rank < pieces:
            left = tree.tightest(length)
            if left is None:
                left, first, number = capacity, bins, None
            else:
                first, number = open_bins[left].pop()
                tree.add(left, -number)
            # A bin that takes a piece is the tightest for the next one, so each takes as many as fit before another does.
            fit = left // length
            full, rest = divmod(pieces - rank, fit)
            if number is not None and full >= number:
                full, rest = number, 0
            for place in range(fit if full else 0):
                entries.append((length, rank, full, first, capacity - left + place * length))
                rank += full
            for place in range(rest):
                entries.append((length, rank, 1, first + full, capacity - left + place * length))
                rank += 1
            used = full + bool(rest)
            put(left - fit * length, first, full)
            put(left - rest * length, first + full, used - full)
            if number is None:
                bins += used
            else:
                put(left, first + used, number - used)
    return entries


class WordIds:
    """Token ids of texts as little-endian bytes.

    The tokenizer never looks across blanks and folds A-Z, so words are remembered in lower case; but it looks for
    special strings before it folds, so a word with the start of one is kept as it is. A word that ends in a letter or
    digit and then marks is the word and the marks, which the tokenizer tells apart too.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        #: A special string takes one id and parts what stands beside it.
        self.border = "<|endoftext|>"
        self.border_id = self.tokenizer.token_to_id(self.border)
        self.ids = [number.to_bytes(4, "little") for number in range(self.tokenizer.get_vocab_size())]
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.held = 0

    def learn(self, parts: list[bytes]) -> None:
        """Encode parts: words of small Latin letters one by one, the others together, a border between each two."""
        texts, tokenize = [], self.tokenizer.model.tokenize
        rest = []
        for part in parts:
            text = part.decode()
            if _LETTERS.fullmatch(text):
                # Nothing is left to fold or to split: the library's merges are all that the word goes through.
                self.parts[part] = b"".join([self.ids[token.id] for token in tokenize(part.decode("latin-1").translate(_BYTES))])
            else:
                rest.append(part)
                texts.append(text)
        parts = rest
        plain = [at for at, text in enumerate(texts) if "<|" not in text]
        for start in range(0, len(plain), 256):
            some = plain[start : start + 256]
            ids = np.array(self.tokenizer.encode(self.border.join(texts[at] for at in some), add_special_tokens=False).ids, "<u4")
            borders = np.flatnonzero(ids == self.border_id).tolist()
            for at, first, last in zip(some, [0, *(b + 1 for b in borders)], [*borders, len(ids)], strict=True):
                self.parts[parts[at]] = ids[first:last].tobytes()
        for at in set(range(len(texts))) - set(plain):
            self.parts[parts[at]] = np.array(self.tokenizer.encode(texts[at], add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [folded_words(text.encode()) for text in texts]
        if self.held > REMEMBER:
            self.words.clear()
            self.parts.clear()
            self.held = 0
        unknown = set().union(*split).difference(self.words)
        halves = {word: halved(word) for word in unknown}
        new = list({part for both in halves.values() for part in both}.difference(self.parts))
        self.learn(new)
        self.held += sum(ENTRY_BYTES + 3 * len(part) for part in new)
        for word, (first, second) in halves.items():
            self.words[word] = ids = self.parts[first] + self.parts[second] if second else self.parts[first]
            self.held += ENTRY_BYTES + (len(word) + len(ids) if second else 0)
        return [b"".join(map(self.words.__getitem__, words)) for words in split]


def folded_words(text: bytes) -> list[bytes]:
    if b"<|" not in text:
        return text.lower().split()
    return [word if b"<|" in word else word.lower() for word in text.split()]


def halved(word: bytes) -> tuple[bytes, bytes]:
    """The word and the marks at its end, where both stay what they are by themselves.

    That holds behind ASCII letters and digits and behind Latin letters of one code point in lower case; others may leave
    a combining mark, which goes with the marks that follow.
    """
    core = word.rstrip(b".,;:!?")
    if not core or len(core) == len(word) or b"<|" in word:
        return word, b""
    if core[-1:].isalnum():
        return core, word[len(core) :]
    last = core[-2:].decode(errors="ignore")
    if len(last) == 1 and "\u00c0" <= last <= "\u024f" and last.isalpha() and len(last.lower()) == 1:
        return core, word[len(core) :]
    return word, b""


@worker_cache
@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def encoded(encode, texts: pa.Array) -> Iterator[bytes]:
    """Ids of each text, so many texts at a time as hold a few million characters."""
    some, held = [], 0
    for text in texts:
        some.append(text.as_py())
        held += len(some[-1])
        if held > 1 << 21:
            yield from encode(some)
            some, held = [], 0
    yield from encode(some)


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of each row's ids, cut after every `capacity` tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = word_ids(tokenizer).encode, END.to_bytes(4, "little")
        for batch in batches:
            owners, numbers, starts, lengths, sums = [], [], [], [], []
            for row, ids in enumerate(encoded(encode, batch.column(1))):
                ids += end
                for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    owners.append(row)
                    numbers.append(number)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            arrays = [batch.column(0).take(pa.array(owners, pa.int32())), pa.array(numbers, pa.int32())]
            arrays += [pa.array(values, pa.int64()) for values in (starts, lengths, sums)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])
        give_back(word_ids)

    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("_text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    capacity: int = CAPACITY,
    salts: int = SALTS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row.

    A row's tokens are those of its text and one end token; only rows of more than `capacity` tokens are cut. NULL and
    empty texts are one end token. Rows that repeat an id are packed each, a NULL id stays NULL, other columns are
    ignored, and an empty table gives no rows. Equal pieces are interchangeable, so ties don't matter.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    # Written once: ranks must be taken of the same rows that were counted.
    cut = pin(pieces(docs, id_col, text_col, tokenizer, capacity))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    # At most capacity x salts small rows; they say how many pieces of a length come before each group.
    groups = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # One count for each length that occurs, so at most `capacity` rows.
    counts = {row[0]: row[1] for row in cut.groupBy("length").count().collect()}
    entries = plan(counts, capacity)
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_at", F.row_number().over(within) - 1).join(groups, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_at") + F.col("_before"))
    # The entries of each length as sorted arrays: a rank finds its entry by the number of entries that begin before it.
    spark = docs.sparkSession
    rows: dict[int, list[tuple[int, int, int]]] = {}
    for length, rank, _, first, offset in entries:
        rows.setdefault(length, []).append((rank, first, offset))
    listed = [(length, sorted(places)) for length, places in rows.items()]
    schema = "length long, _entries array<struct<rank: long, bin: long, offset: long>>"
    table = F.broadcast(spark.createDataFrame(listed, schema))  # bounded by the capacity, not by the documents
    entry = F.element_at(F.filter("_entries", lambda e: e["rank"] <= F.col("_rank")), -1)
    placed = ranked.join(table, "length").withColumn("_entry", entry)
    return placed.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("_entry.bin") + F.col("_rank") - F.col("_entry.rank")).alias("sequence_id"),
        F.col("_entry.offset").alias("offset"),
    )
