"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash. Native columns only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catchment.llm.common import lower_ascii, whole_text
from catchment.session import pin

PREFIX = 256


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prefix: int = PREFIX, hash_all: bool = False
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row.

    Rows are grouped by byte length; rows that share a length go on to a hash of the first `prefix` characters, and
    only rows that share that too are told apart by SHA-256 of the whole text. A group keeps its largest id. Without
    `hash_all`, `text_sha256` is NULL for rows that were settled earlier and their texts are not hashed; with it, the
    hash is taken of every row in the scan that takes length and prefix.

    Only A-Z are folded. NULL text counts as empty, and empty texts form a group. Rows that repeat an id are rows like
    others; when several hold the largest id of a group, `kept` is true for each of them. A NULL id loses to any other.
    Other columns are ignored, and an empty table gives no rows. Groups of any size are counted before the shuffle.
    """
    text = lower_ascii(whole_text(text_col))
    sha = F.sha2(text.cast("binary"), 256)
    light = [
        F.col(id_col).alias("doc_id"),
        F.octet_length(text).alias("_length"),
        F.xxhash64(F.substring(text, 1, prefix)).alias("_head"),
    ]
    rows = pin(docs.select(*light, sha.alias("text_sha256")) if hash_all else docs.select(*light))

    lengths = rows.groupBy("_length").count().filter("count > 1").drop("count")
    same_length = rows.join(lengths, "_length", "left_semi")
    heads = same_length.groupBy("_length", "_head").count().filter("count > 1").drop("count")
    left = same_length.join(heads, ["_length", "_head"], "left_semi")
    keys = ["_length", "_head", "text_sha256"]
    if not hash_all:
        # The rows left are few; at size the runtime filter of the join drops the others before texts are moved.
        wanted = left.select("doc_id", "_length", "_head").distinct()
        on = [F.col("doc_id").eqNullSafe(F.col("_id")), F.col("_length") == F.col("_len"), F.col("_head") == F.col("_first")]
        names = [F.col(a).alias(b) for a, b in (("doc_id", "_id"), ("_length", "_len"), ("_head", "_first"))]
        texts = docs.select(*light, text.alias("_text")).join(wanted.select(*names), on, "left_semi")
        left = pin(texts.select("doc_id", "_length", "_head", F.sha2(F.col("_text").cast("binary"), 256).alias("text_sha256")))
        settled = rows.join(heads, ["_length", "_head"], "left_anti").withColumn("text_sha256", F.lit(None).cast("string"))
        rows = settled.unionByName(left)
    groups = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.max("doc_id").alias("_keep")).filter("_size > 1")
    joined = rows.join(groups, keys, "left")
    keep = F.when(F.col("_size").isNull(), F.col("doc_id")).otherwise(F.col("_keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


ORACLE = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
