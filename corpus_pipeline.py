"""The corpus pipeline: each stage works on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.llm.common import table, whole_text
from catchment.llm.line_dedup import line_dedup
from catchment.llm.mixing import mix
from catchment.llm.ngram_join import ngram_join
from catchment.llm.packing import pack
from catchment.llm.toxicity import fit, toxicity
from catchment.session import ensure_checkpoint_dir, pin

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


REJECT = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents of a score of 0.5 or more go; the lexicon is learned from labelled rows that aren't held out."""
    lexicon = fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity(docs, lexicon).filter(F.col("_score") < REJECT).select(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: lines that three documents or more share stay in one of them; documents left without text go."""
    cut = line_dedup(docs)
    emptied = (F.col("_n_dropped") > 0) & (F.length(F.trim("text")) == 0)
    return cut.filter(~F.coalesce(emptied, F.lit(False))).select(
        *[F.length("text").cast("long").alias("n_chars") if name == "n_chars" else F.col(name) for name in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: of documents that links join, one row stays, of the smallest id; texts without words all stay.

    A fingerprint beside the id tells rows apart that repeat an id. A NULL id is larger than any other.
    """
    text, words = whole_text(), whole_text().rlike(r"[^\x20\x09-\x0D]")
    marked = docs.withColumn("_print", F.xxhash64(text))
    ids = (
        marked.filter(words)
        .groupBy(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("_id"), F.col("_print").alias("_same"))
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    firsts = ids.groupBy("_same").agg(F.min(F.struct("none", "_id", "_same", "_copies")).alias("first"))
    # With the fingerprint as id, a component's name is its own.
    linked = ngram_join(marked.select(F.col("_print").alias("doc_id"), "text")).filter("n_shingles > 0")
    linked = linked.select(F.col("doc_id").alias("_same"), "component_id").distinct()
    stays = pin(linked.join(firsts, "_same").groupBy("component_id").agg(F.min("first").alias("first")).select("first._id", "first._same", "first._copies"))
    same = marked["doc_id"].eqNullSafe(F.col("_id")) & (marked["_print"] == F.col("_same"))
    once = marked.filter(words).join(stays.filter("_copies = 1"), same, "left_semi")
    # Rows that repeat both id and text are few; only they are moved.
    repeated = marked.filter(words).join(stays.filter("_copies > 1"), same, "left_semi").dropDuplicates(["doc_id", "_print"])
    return marked.filter(~words).unionByName(once).unionByName(repeated).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents are drawn so that sources, languages and topics meet their target shares of tokens."""
    return mix(docs).filter("_kept").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: the tokens of what is left, packed into sequences; a row for each piece of a document."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`; what a stage keeps is written as Parquet to the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
