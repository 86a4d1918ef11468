"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text and normalised by length.

Folding lowers the text, replaces letters of other alphabets that look Latin, full-width letters and digits or signs that
stand for letters, and turns the rest into blanks. The lexicon holds whole words and beginnings of words; it is learned
from labelled rows, and so are the two slopes that turn weights into a score.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import give_back, whole_text
from catchment.session import pin

#: Letters that look Latin, and digits and signs that stand for letters (fixed values).
HOMOGLYPHS = dict(zip("авекмнорстухіѕјԁɡαεικνορτυχ", "abekmhopctyxisjdgaeiknoptux", strict=True))
DIGITS = dict(zip("0134578@$", "oieastbas", strict=True))
#: Harmless phrases that hold a word of the lexicon.
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "sore loser")
#: Bounds of the fit: labelled rows that are read, terms that are kept.
SAMPLE_ROWS = 20_000
MAX_TERMS = 1_000
#: A term stands in this share of the toxic rows of the sample, and so many times oftener there than in clean ones.
MIN_SHARE = 0.02
MIN_RATIO = 16.0
BEGINNINGS = (4, 5, 6)


class Folding(dict):
    """Character to folded character, worked out as texts bring them up."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        plain = unicodedata.normalize("NFKC", char).lower()
        plain = plain[0] if plain else " "
        plain = HOMOGLYPHS.get(plain, DIGITS.get(plain, plain))
        self[code] = plain if plain.isalpha() else " "
        return self[code]


_FOLDING = Folding()


def fold(text: str) -> str:
    return text.translate(_FOLDING)


def terms_of(text: str) -> set[tuple[str, str]]:
    """Candidate terms of a text, words as " word " and beginnings as " word", each with the word before it."""
    words = fold(text).split()
    found = set()
    for before, word in zip(["", *words], words, strict=False):
        found |= {(f" {word[:size]}", before) for size in BEGINNINGS if len(word) > size}
        if len(word) >= BEGINNINGS[0]:
            found.add((f" {word} ", before))
    return found


@dataclass(frozen=True)
class Lexicon:
    """Weights of terms, harmless phrases, and the slopes of the score: a constant and one for each feature."""

    weights: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...] = EXCEPTIONS
    slopes: tuple[float, ...] = (-4.0, 1.0, 1.0, 0.5, 0.0)


@lru_cache(maxsize=4)
def automaton(weights: tuple[tuple[str, float], ...], exceptions: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for term, weight in weights:
        found.add_word(term, (len(term), weight, False))
    for phrase in exceptions:
        found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
    if len(found):
        found.make_automaton()
    return found


def evidence(text: str, lexicon: Lexicon) -> tuple[float, ...]:
    """Features of a text: log weight of its hits, the same for each hundred words, the heaviest hit, log of its words."""
    machine = automaton(lexicon.weights, lexicon.exceptions)
    words = fold(text).split()
    if not words or not len(machine):
        return 0.0, 0.0, 0.0, 0.0
    hits, harmless = [], []
    for end, (size, weight, exempt) in machine.iter(" ".join(["", *words, ""])):
        (harmless if exempt else hits).append((end - size + 1, end, weight))
    best: dict[int, float] = {}
    for start, end, weight in hits:
        if not any(first <= start and end <= last for first, last, _ in harmless):
            best[start] = max(weight, best.get(start, 0.0))  # a word counts once, however many terms it begins with
    total = sum(best.values())
    return math.log1p(total), math.log1p(100 * total / len(words)), max(best.values(), default=0.0), math.log1p(len(words))


def score(text: str, lexicon: Lexicon) -> float:
    constant, *slopes = lexicon.slopes
    sum_ = constant + sum(slope * feature for slope, feature in zip(slopes, evidence(text, lexicon), strict=True))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, sum_))))


def logistic(rows: Iterable[tuple[float, ...]], rounds: int = 25, ridge: float = 0.1) -> tuple[float, ...]:
    """Slopes of a logistic fit to (feature, ..., label) rows by Newton steps; the rarer class weighs more."""
    import numpy as np

    data = np.array(list(rows), dtype=float)
    if not data.size or len(set(data[:, -1])) < 2:
        return Lexicon.slopes
    x, y = np.column_stack([np.ones(len(data)), data[:, :-1]]), data[:, -1]
    w = np.where(y == 1, min(3.0, (len(y) - y.sum()) / y.sum()), 1.0)
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (y - p)) - ridge * b
        b = b + np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), slope)
    return tuple(float(v) for v in b)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    max_terms: int = MAX_TERMS,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """The lexicon of at most `sample_rows` labelled rows that aren't held out, taken by a hash of the id.

    A term counts once for each word that stands before it, so that the words of a text that was copied with small
    changes don't look like many. Rows with a NULL id, label or text teach nothing; of rows that repeat an id each text is taken. Without toxic or
    without clean rows the lexicon is empty and every text scores low.
    """
    wanted = (
        labels.filter(F.col("toxic").isin(0, 1) & ~held_out(id_col))
        .select(F.col(id_col).alias("_id"), F.col("toxic").cast("int").alias("toxic"))
        .dropDuplicates(["_id"])
        .orderBy(F.xxhash64("_id"), "_id")
        .limit(sample_rows)
    )
    # At most `sample_rows` small rows, so the texts need not be moved.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).filter("_text IS NOT NULL")
    sample = texts.join(F.broadcast(wanted), "_id").select("toxic", "_text").dropDuplicates(["_text"])
    sample = pin(sample)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                terms, before = zip(*found, strict=True) if (found := terms_of(text)) else ((), ())
                arrays = [pa.array([label] * len(terms), pa.int32()), pa.array(terms, pa.string()), pa.array(before, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "term", "before"])
        give_back()

    classes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    bad, good = classes.get(1, 0), classes.get(0, 0)
    if not bad or not good:
        return Lexicon((), exceptions)
    places = sample.mapInArrow(candidates, "toxic int, term string, before string").groupBy("term", "before").agg(
        F.max("toxic").alias("bad"), F.max(1 - F.col("toxic")).alias("good")
    )
    counted = places.groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    ratio = ((F.col("bad") + 0.5) / (bad + 1)) / ((F.col("good") + 0.5) / (good + 1))
    chosen = (
        counted.filter((F.col("bad") >= max(3, MIN_SHARE * bad)) & (ratio >= MIN_RATIO))
        .withColumn("weight", F.log(ratio))
        .orderBy(F.desc("bad"), F.desc("weight"), "term")
        .limit(max_terms)
        .select("term", "weight")
        .collect()
    )
    plain = Lexicon(tuple(sorted((row["term"], float(row["weight"])) for row in chosen)), exceptions)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(evidence(text, plain)) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(0)], names=["features", "toxic"])
        give_back()

    # A few numbers for each row of the bounded sample, in a fixed order.
    features = sample.mapInArrow(measure, "features array<double>, toxic int").collect()
    return Lexicon(plain.weights, exceptions, logistic(sorted((*row[0], row[1]) for row in features)))


def toxicity(docs: DataFrame, lexicon: Lexicon, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and `_score`, from 0 to 1, higher for texts that are likelier toxic.

    Whole texts are scored, each by itself; NULL and empty texts score like texts without hits. Very long texts are held
    to the same weights by length. Rows that repeat an id are rows like others; an empty table gives no rows.
    """
    from pyspark.sql.types import DoubleType, StructField, StructType

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([score(text.as_py() or "", lexicon) for text in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, "_score"])
        give_back()

    at = docs.columns.index(text_col)
    return docs.mapInArrow(scored, StructType([*docs.schema.fields, StructField("_score", DoubleType())]))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row."""
    rows = docs.select("doc_id", "text")
    scored = toxicity(rows, fit(rows, labels.select("doc_id", "toxic")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        F.when(F.col("_score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
