"""Lines that many documents share: explode, hash, count documents per hash, drop, reassemble. Native columns only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import BLANKS, lower_ascii, whole_text

MIN_CHARS = 20
MIN_DOCUMENTS = 3


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_hashes(text: Column, min_chars: int) -> Column:
    """Hash of each line's key by position; NULL for lines too short to count."""

    def key_hash(line: Column) -> Column:
        return F.when(F.length(line) >= min_chars, F.md5(lower_ascii(line).cast("binary")))

    # Lines are stripped in a step of their own: within one, each use of the stripped line would strip it again.
    return F.transform(F.transform(split_lines(text), lambda line: F.btrim(line, F.lit(BLANKS))), key_hash)


def kept_lines(lines: Column, drop: Column) -> Column:
    """`lines` without the sorted 0-based positions of `drop`: the slices between them."""

    def between(i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(drop, i - 1) + 1)
        end = F.coalesce(F.get(drop, i), F.size(lines))
        return F.slice(lines, start + 1, end - start)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(drop)), between))


def line_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """All columns of `docs` with the kept lines as text, and `_n_lines`, `_n_dropped`.

    A line's key is the line without blanks at its ends, A-Z in lower case. Keys of `min_chars` code points or more that
    stand in `min_documents` rows or more lose all their lines, except in the row with the largest id that holds them.

    NULL or empty text is one empty line. A repeated id counts once for each row; rows that repeat the largest id all
    keep their lines, a NULL id loses to any other. Lines of any length and documents of any number of lines are
    handled; a document that loses all its lines is left with empty text. Documents per key are counted before the
    shuffle, so a line of a third of the corpus is one row of each task.
    """
    text = whole_text(text_col)
    # A fingerprint beside the id tells rows apart that repeat an id.
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_print"), text.alias("_text"))
    hashes = line_hashes(F.col("_text"), min_chars)
    keys = rows.select("_id", F.explode(F.array_compact(F.array_distinct(hashes))).alias("_hash"))
    shared = (
        keys.groupBy(F.unhex("_hash").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keep"))
        .filter(F.col("_n") >= min_documents)
        .select("_key", "_keep")
    )
    # Opened as an expression: a column of hashes would be made twice, as Spark filters by its size first.
    lines = rows.select("_id", "_print", F.posexplode(hashes).alias("_at", "_hash")).filter("_hash IS NOT NULL")
    lost = (
        lines.select("_id", "_print", "_at", F.unhex("_hash").alias("_key"))
        .join(shared, "_key")
        .filter(~F.col("_id").eqNullSafe(F.col("_keep")))
        .groupBy("_id", "_print")
        .agg(F.array_sort(F.collect_set("_at")).alias("_drop"))
        .select(F.col("_id").alias("_lost_id"), F.col("_print").alias("_lost_print"), "_drop")
    )
    marked = docs.withColumn("_print", F.xxhash64(text))
    same = marked[id_col].eqNullSafe(lost["_lost_id"]) & (marked["_print"] == lost["_lost_print"])
    cut = marked.join(lost, same, "left").withColumn("_lines", split_lines(text))
    kept = F.when(F.col("_drop").isNull(), F.col(text_col)).otherwise(
        F.array_join(kept_lines(F.col("_lines"), F.col("_drop")), "\n")
    )
    return cut.select(
        *[kept.alias(name) if name == text_col else F.col(f"`{name}`") for name in docs.columns],
        F.size("_lines").cast("long").alias("_n_lines"),
        F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("_n_dropped"),
    )


def line_report(docs: DataFrame) -> DataFrame:
    cut = line_dedup(docs.select("doc_id", "text"))
    return cut.select(
        "doc_id",
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2(whole_text().cast("binary"), 256).alias("kept_sha256"),
    )


ORACLE = """
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (
  SELECT key, max(doc_id) AS keep FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (
  SELECT k.doc_id, k.pos, k.line, s.key IS NOT NULL AND k.doc_id <> s.keep AS lost FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
