"""The operators' queries over whole tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catchment.llm import exact_dedup, importance, line_dedup, mixing, ngram_join, packing, secret_scan, spelling, suffix_dedup, token_counts, topk, toxicity, warc
from catchment.llm.common import Query, table

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).drop("starts", "ends")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), hash_all=True)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_report(spark, table(spark, sf_dir, "pages"))


for _query in (
    op1_suffix_dedup, op2_token_counts, op3_exact_topk, op4_best_fit_packing, op5_ngram_join, op6_toxicity, op7_mixing, op8_line_dedup, op9_exact_dedup, op10_secret_scan,
    op11_spelling_variants, op12_importance_resampling, op13_warc,
):
    QUERIES[_query.__name__] = _query

SQL |= {"op3_exact_topk": topk.ORACLE, "op7_mixing": mixing.oracle(), "op8_line_dedup": line_dedup.ORACLE, "op9_exact_dedup": exact_dedup.ORACLE, "op13_warc": warc.ORACLE}
