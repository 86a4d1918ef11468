"""Spelling variants of a corpus vocabulary: words one edit apart, found in a bidirectional FM-index.

A word one edit from another shares one of its halves exactly. Words are dealt out by their halves, and each share of the
vocabulary is indexed, each word ended by a delimiter: by the words for searches that match the right half and extend to
the left, by the reversed words for those that match the left half and extend to the right. A search keeps an interval
of suffix ranks; when it has read the delimiter, the ranks left are the numbers of the words found.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.session import pin

MIN_CHARS = 6
MIN_COUNT = 5
#: A form stands at least so many times as often as the word.
FACTOR = 5
#: One in so many (id, word) keys loses a letter.
NOISE = 199
#: Code points of text that are read at a time, and distinct words a task holds before it passes them on.
CHUNK = 1 << 20
HELD = 200_000
#: Code points of one share of the index, about.
SHARE = 500_000
#: Searches that go on side by side.
BLOCK = 4096

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LETTERS = "a-zÀ-ÿ"


def runs(text: bytes, min_chars: int, chunk: int = CHUNK) -> Iterator[Counter]:
    """Maximal runs of letters of at least `min_chars`, counted for a piece of text at a time; pieces end between runs."""
    find, apart = re.compile(f"[{_LETTERS}]{{{min_chars},}}").findall, re.compile(f"[^{_LETTERS}]")
    folded, at = text.translate(_LOWER).decode(), 0
    while at < len(folded):
        end = len(folded)
        if end - at > chunk and (gap := apart.search(folded, at + chunk)):
            end = gap.end()
        yield Counter(find(folded, at, end) if chunk < len(folded) else find(folded))
        at = end


def noisy(doc: str, counts: Counter, noise: int, min_chars: int) -> Iterator[tuple[str, int]]:
    """Words and counts of a document; where the check sum of id and word says so, a letter is missing."""
    start = crc32(f"{doc}:".encode())
    for word, number in counts.items():
        value = crc32(word.encode(), start)
        if not noise or value % noise:
            yield word, number
        elif len(word) > min_chars:
            at = value % len(word)
            yield word[:at] + word[at + 1 :], number


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_count: int, noise: int) -> DataFrame:
    """(word, n) of all texts; tasks add up their own words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}

        def told() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return rows

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for counts in runs(text.as_buffer().to_pybytes() if text.is_valid else b"", min_chars):
                    for word, number in noisy("" if doc is None else doc, counts, noise, min_chars):
                        held[word] = held.get(word, 0) + number
                    if len(held) >= HELD:
                        yield told()
        if held:
            yield told()

    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class Index:
    """FM-index of distinct words, each ended by a delimiter that leads back to its own start.

    Suffixes are ordered up to their delimiter and then by word, so the delimiters' ranks are the words' ranks.
    """

    def __init__(self, words: list[str]) -> None:
        self.words = sorted(words)
        codes = np.frombuffer("".join(word + "\0" for word in self.words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        ends = np.flatnonzero(codes == 0)
        self.letters, symbols = np.unique(codes, return_inverse=True)
        self.size, self.sigma = len(codes), len(self.letters)
        starts = np.r_[0, ends[:-1] + 1]
        stop = np.repeat(ends, ends - starts + 1)
        order = self._order(symbols, stop)
        before = np.arange(-1, self.size - 1)
        before[starts] = ends
        self.bwt = symbols[before[order]]
        by_symbol = np.argsort(self.bwt, kind="stable")
        #: Where each row goes when its symbol is put in front, and (symbol, row) keys in that order, for ranks.
        self.step = np.empty(self.size, np.int64)
        self.step[by_symbol] = np.arange(self.size)
        self.keys = self.bwt[by_symbol] * self.size + by_symbol

    def _order(self, symbols: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Suffix order: as many symbols as fit into a key at first, doubled until all keys have met their delimiter."""
        bits, at = max(1, int(self.sigma - 1).bit_length()), np.arange(self.size)
        width, key = 63 // bits, np.zeros(self.size, np.int64)
        for ahead in range(width):
            there = at + ahead <= stop
            key = (key << bits) | np.where(there, symbols[np.where(there, at + ahead, 0)], 0)
        longest = int((stop - at).max(initial=0)) + 1
        while True:
            order = np.argsort(key, kind="stable")
            if width >= longest:
                return order
            ranks = np.empty(self.size, np.int64)
            ranks[order] = np.cumsum(np.r_[1, np.diff(key[order]) != 0])
            there = at + width <= stop
            key = ranks * (self.size + 1) + np.where(there, ranks[np.where(there, at + width, 0)], 0)
            width *= 2

    def symbols_of(self, word: str) -> np.ndarray:
        """A word as numbers of its letters; a letter that no word has is beyond them all."""
        codes = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.searchsorted(self.letters, codes)
        found = self.letters[np.minimum(at, self.sigma - 1)] == codes
        return np.where(found, at, self.sigma)

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals with one more symbol in front."""
        base = symbol * self.size
        return np.searchsorted(self.keys, base + low), np.searchsorted(self.keys, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(state, symbol, low, high) for every letter in front of every interval; delimiters are left out."""
        width = high - low
        wide = np.flatnonzero(width > self.sigma)
        narrow = np.flatnonzero(width <= self.sigma)
        sizes = width[narrow]
        rows = np.repeat(low[narrow] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        kind = np.repeat(narrow, sizes) * self.sigma + self.bwt[rows]
        order = np.argsort(kind, kind="stable")
        kind, rows = kind[order], rows[order]
        first = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]][: len(kind)])
        last = np.r_[first[1:], len(kind)][: len(first)] - 1
        parts = [(kind[first] // self.sigma, kind[first] % self.sigma, self.step[rows[first]], self.step[rows[last]] + 1)]
        if len(wide):
            state, symbol = np.repeat(wide, self.sigma), np.tile(np.arange(self.sigma), len(wide))
            parts.append((state, symbol, *self.extend(low[state], high[state], symbol)))
        state, symbol, below, above = (np.concatenate(column) for column in zip(*parts, strict=True))
        some = (symbol > 0) & (above > below)
        return state[some], symbol[some], below[some], above[some]

    def near(self, queries: list[str], halves: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of all words one edit from a query whose edit lies in front of its last `halves` letters.

        The end of a query is matched exactly; in front of it each letter is matched, or once replaced, left out or
        preceded by another. A pair may come more than once from a run of equal letters; it is told once.
        """
        pairs = [np.zeros(0, np.int64)]
        for at in range(0, len(queries), BLOCK):
            pairs.append(self._near(queries[at : at + BLOCK], np.array(halves[at : at + BLOCK], np.int64)) + at * len(self.words))
        found = np.concatenate(pairs)
        return found // max(1, len(self.words)), found % max(1, len(self.words))

    def _near(self, queries: list[str], halves: np.ndarray) -> np.ndarray:
        # All queries, read from their ends, in one row of symbols; the delimiter in front of the word comes last.
        lengths = np.array([len(query) for query in queries], np.int64)
        firsts = np.cumsum(lengths + 1) - lengths - 1
        symbols = np.zeros(int((lengths + 1).sum()), np.int64)
        for first, query in zip(firsts.tolist(), queries, strict=True):
            symbols[first : first + len(query)] = self.symbols_of(query)[::-1]
        query, low, high = np.arange(len(queries)), np.zeros(len(queries), np.int64), np.full(len(queries), len(self.words))
        done = np.zeros(len(queries), np.int64)
        # States with one error: (query, letters read, interval).
        wrong = [np.zeros(0, np.int64)] * 4
        found = []
        while len(query) or len(wrong[0]):
            if len(query):
                free = np.flatnonzero(done >= halves[query])
                if len(free):
                    born = self._errors(query[free], done[free], low[free], high[free], lengths, firsts, symbols)
                    wrong = [np.concatenate(column) for column in zip(wrong, born, strict=True)]
                # Beyond the last letter there is nothing left to get wrong.
                on = np.flatnonzero(done < lengths[query])
                query, done, low, high = query[on], done[on], low[on], high[on]
                low, high = self.extend(low, high, symbols[firsts[query] + done])
                some = np.flatnonzero(high > low)
                query, done, low, high = query[some], done[some] + 1, low[some], high[some]
            at, read, below, above = wrong
            if not len(at):
                continue
            below, above = self.extend(below, above, symbols[firsts[at] + read])
            some = np.flatnonzero(above > below)
            at, read, below, above = at[some], read[some] + 1, below[some], above[some]
            # A delimiter's rank is its word's rank; whole words are distinct, so one is left.
            ended = read > lengths[at]
            found.append(at[ended] * len(self.words) + below[ended])
            wrong = [column[~ended] for column in (at, read, below, above)]
        return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def _errors(self, query, done, low, high, lengths, firsts, symbols) -> list[np.ndarray]:  # noqa: ANN001
        """All ways to make the one error in front of what has been read."""
        left = done < lengths[query]
        state, symbol, below, above = self.children(low, high)
        other = left[state] & (symbol != symbols[firsts[query[state]] + done[state]])
        replaced, more = state[other], state
        return [
            np.concatenate(column)
            for column in (
                (query[left], query[replaced], query[more]),
                (done[left] + 1, done[replaced] + 1, done[more]),
                (low[left], below[other], below),
                (high[left], above[other], above),
            )
        ]


def best_near(held: dict[str, int], asks: list[str], right: bool) -> list[tuple[str, int, str, int]]:
    """(word, near words, best of them, its count) of the words that ask, by their right halves or by their left ones.

    A pair that shares the left half is told by the left halves alone, so no pair is told twice.
    """
    if not held or not asks:
        return []
    turn = (lambda word: word) if right else (lambda word: word[::-1])
    turned = {turn(word): word for word in held}
    index = Index(list(turned))
    halves = [len(word) - len(word) // 2 if right else len(word) // 2 for word in asks]
    ask, found = index.near([turn(word) for word in asks], halves)
    words = [turned[word] for word in index.words]
    best: dict[int, tuple[int, int, str]] = {}
    for at, number in zip(ask.tolist(), found.tolist(), strict=True):
        word, asked = words[number], asks[at]
        if right and word.startswith(asked[: len(asked) // 2]):
            continue
        own = (-held[word], word)
        old = best.get(at)
        best[at] = (1, *own) if old is None else (old[0] + 1, *min(old[1:], own))
    return [(asks[at], number, word, -less) for at, (number, less, word) in best.items()]


def placements(words: DataFrame, min_chars: int) -> DataFrame:
    """(right, half, word, n, asked): a word under its own half, to ask, and under those that partners of other lengths have."""
    length, places = F.length("word"), []
    for right in (False, True):
        # Half of a word of this length, of one more, and of one less; two of the three are alike.
        own, more, less = ((F.floor((length + (by + 1 if right else by)) / 2)).cast("int") for by in (0, 1, -1))
        cut = (lambda n: F.substring("word", length - n + 1, n)) if right else (lambda n: F.substring("word", F.lit(1), n))
        other = F.when(more == own, F.when(length > min_chars, less)).otherwise(more)
        places.append(F.struct(F.lit(right).alias("right"), cut(own).alias("half"), F.lit(True).alias("asked")))
        places.append(F.when(other.isNotNull(), F.struct(F.lit(right).alias("right"), cut(other).alias("half"), F.lit(False).alias("asked"))))
    return words.select("word", "n", F.explode(F.array_compact(F.array(*places))).alias("place")).select("place.*", "word", "n")


def near_words(words: DataFrame, min_chars: int = MIN_CHARS, share: int = SHARE) -> DataFrame:
    """(word, n_near, form, form_n): number of words one edit away, and the most frequent of them; words without any are left out.

    Halves are dealt over shares of about `share` code points. A half that more words hold has shares of its own: each
    of its words is in one of them, and the words that ask are sent to all.
    """
    placed = placements(words, min_chars)
    sizes = pin(placed.groupBy("right", "half").agg(F.sum(F.length("word") + 1).alias("size")))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    hot = sizes.filter(F.col("size") > share).select("right", "half", F.ceil(F.col("size") / share).cast("int").alias("parts"))
    bucket = F.pmod(F.xxhash64("right", "half"), F.lit(max(1, -(-total // share))))
    shares = ("bucket", "apart", "part")
    if hot.isEmpty():
        dealt = placed.select(bucket.alias("bucket"), F.lit(None).cast("string").alias("apart"), F.lit(0).alias("part"), "right", "word", "n", "asked", F.lit(True).alias("held"))
    else:
        is_hot, own = F.col("parts").isNotNull(), F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
        parts = F.when(is_hot & F.col("asked"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.coalesce(own, F.lit(0))))
        dealt = placed.join(hot, ["right", "half"], "left").select("*", F.explode(parts).alias("part")).select(
            F.when(~is_hot, bucket).alias("bucket"), F.when(is_hot, F.col("half")).alias("apart"), "part", "right", "word", "n", "asked",
            (~is_hot | (F.col("part") == own)).alias("held"),
        )

    def search(key: tuple, table: pa.Table) -> pa.Table:
        held: tuple[dict[str, int], dict[str, int]] = ({}, {})
        asks: tuple[set[str], set[str]] = (set(), set())
        for batch in table.select(["right", "word", "n", "asked", "held"]).to_batches():
            for right, word, n, asked, here in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if here:
                    held[right][word] = n
                if asked:
                    asks[right].add(word)
        rows = [row for right in (False, True) for row in best_near(held[right], sorted(asks[right]), right)]
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)], names=["word", "n_near", "form", "form_n"])

    some = dealt.groupBy(*shares).applyInArrow(search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return some.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best")).select(
        "word", "n_near", F.col("_best.form").alias("form"), (-F.col("_best.less")).alias("form_n")
    )


def roots(links: DataFrame, steps: int) -> DataFrame:
    """(word, root): the last form that `links` (word, form) lead to, by doubling; no way is longer than `steps`."""
    found, reach = pin(links.select("word", F.col("form").alias("root"))), 1
    while reach < steps:
        onward = found.select(F.col("word").alias("_at"), F.col("root").alias("_on"))
        found = pin(found.join(onward, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")))
        if found.filter("moved").isEmpty():
            break
        found, reach = found.drop("moved"), reach * 2
    return found.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    factor: int = FACTOR,
    noise: int = NOISE,
    share: int = SHARE,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of at least `min_chars` code points that stands `min_count` times.

    Words are maximal runs of Latin letters, A-Z in lower case. Where `noise` (0: never) divides the check sum of id and
    run, the run loses one letter first. Words are near that differ by one letter put in, left out or replaced; a word's
    form is the near word that stands most often (ties: the first in code-point order), if `factor` (2 or more) times as
    often as the word; its root is the last of its forms' forms, or itself.

    NULL and empty texts have no words; a NULL id counts as an empty one in the check sum. Rows that repeat are counted
    like others, texts and words of any length are read whole, other columns are ignored, an empty table gives no rows.
    """
    words = pin(vocabulary(docs, id_col, text_col, min_chars, min_count, noise))
    is_form = F.col("form_n") >= factor * F.col("n")
    told = words.join(near_words(words, min_chars, share), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n"),
    )
    told = pin(told)
    # Each form stands `factor` times as often as the one before, so the largest count bounds the way to the root.
    most = words.agg(F.max("n")).first()[0] or 1
    steps = 1
    while min_count * factor**steps <= most:
        steps += 1
    last = roots(told.filter("form IS NOT NULL").select("word", "form"), steps)
    return told.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
