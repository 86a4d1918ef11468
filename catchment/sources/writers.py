"""Writers: raw landing, append tables, checked releases, CSV."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.functions.text import partition_label
from catchment.sources.schemas import DAY_FIELD, TABLES, conform_to_schema

BOM = "﻿"
# Rows per released file and per sample.
ROWS_PER_FILE = 1_000_000
SAMPLE_ROWS = 1000
#: Bytes of a file that are hashed at a time.
PIECE = 1 << 20

# The envelope of a landed document.
ENVELOPE_FIELDS = [
    "snapshot_id",
    "job_id",
    "provider",
    "postcode",
    "planned_window",
    "scheduled_at",
    "captured_at",
    "source_url",
    "response",
]


def raw_landing_rows(raw: DataFrame, text: str | None = None) -> DataFrame:
    """Documents with the folder columns provider, date and window: the text as it came, or else the envelope's columns."""
    document = F.col(text) if text else F.to_json(F.struct(*[F.col(name) for name in ENVELOPE_FIELDS]))
    return raw.select(
        F.col("provider"),
        F.to_date(F.left("captured_at", F.lit(10))).cast("string").alias("date"),
        F.col("planned_window").alias("window"),
        document.alias("value"),
    )


def write_raw_landing(raw: DataFrame, path: str, mode: str = "append", text: str | None = None) -> None:
    """Envelopes as gzip JSON lines under provider=/date=/window=; large folders get several files.

    With `text`, the column of the documents as they came, they land complete and aren't put together again.
    """
    rows = raw_landing_rows(raw, text).hint("rebalance", F.col("provider"), F.col("date"), F.col("window"))
    rows.write.mode(mode).partitionBy("provider", "date", "window").option("compression", "gzip").text(path)


def folders_of(table: str) -> list[str]:
    """The folders of a stored table: by run where it has runs, then by day where it has a day."""
    by_run = ["run_id"] if "run_id" in TABLES[table].fieldNames() else []
    return by_run + (["day"] if table in DAY_FIELD else [])


def append_rows(df: DataFrame, path: str, table: str) -> None:
    """Append rows of a known table, in its schema, under run and day folders where the table has them."""
    rows, folders = conform_to_schema(df, TABLES[table]), folders_of(table)
    if "day" in folders:
        rows = rows.withColumn("day", F.to_date(DAY_FIELD[table]))
    if not folders:
        rows.write.mode("append").parquet(path)
        return
    rows.hint("rebalance", *[F.col(name) for name in folders]).write.mode("append").partitionBy(*folders).parquet(path)


def read_table(spark: SparkSession, path: str, table: str, runs: Iterable[str] | None = None, days: tuple[str, str] | None = None) -> DataFrame:
    """A stored table in its current schema; a column that older files lack is NULL, one that it doesn't know is left out.

    `runs` and `days` (the first and the last) choose folders, and so does a filter on `run_id` of the result.
    """
    stored = T.StructType([T.StructField(field.name, field.dataType) for field in TABLES[table]])
    folders = folders_of(table)
    if "day" in folders:
        stored = stored.add("day", T.DateType())
    rows = spark.read.schema(stored).parquet(path)
    if runs is not None:
        rows = rows.filter(F.col("run_id").isin(list(runs)))
    if days is not None:
        rows = rows.filter(F.col("day").between(*[F.lit(day).cast("date") for day in days]))
    return conform_to_schema(rows.drop("day"), TABLES[table], check_required=False)


@dataclass(frozen=True)
class ReleaseSpec:
    dataset: str
    source_table: str
    description: str
    sample_order: tuple[str, ...]
    partition_field: str | None = None
    included: tuple[str, ...] | None = None


# The released datasets and their four collection windows.
RELEASE = {
    "profile": ReleaseSpec("restaurant_profile", "restaurant_profile", "What is known of each outlet.", ("restaurant_id",)),
    "opening_times": ReleaseSpec(
        "restaurant_opening_times",
        "restaurant_opening_times",
        "Hours of each outlet, an interval per row.",
        ("restaurant_id", "service_type", "day_of_week", "interval_index", "opening_time_id"),
    ),
    "static_coverage": ReleaseSpec(
        "static_coverage", "postcode_restaurant_delivery_map", "Which outlets deliver where, open or not.", ("postcode", "restaurant_id")
    ),
    "observed_availability": ReleaseSpec(
        "observed_availability",
        "restaurant_snapshots",
        "Outlets seen open at collection time.",
        ("postcode", "ListingId", "captured_at"),
        "planned_window",
        ("weekday_afternoon", "weekday_evening", "weekday_early_hours", "saturday_peak"),
    ),
}


def select_specs(names: list[str]) -> list[ReleaseSpec]:
    """Specs by name in the order asked, once each; 'all' means every one."""
    wanted = list(RELEASE) if "all" in names else list(dict.fromkeys(names))
    return [RELEASE[name] for name in wanted]


def labelled(df: DataFrame, spec: ReleaseSpec) -> DataFrame:
    """Add `partition_label`; without a partition field it is 'all'."""
    label = partition_label(F.col(spec.partition_field)) if spec.partition_field else F.lit("all")
    return df.withColumn("partition_label", label)


def is_included(spec: ReleaseSpec):
    return F.lit(True) if spec.included is None else F.col("partition_label").isin(list(spec.included))


def release_partitions(df: DataFrame, spec: ReleaseSpec) -> DataFrame:
    """Rows per released partition."""
    kept = labelled(df, spec).filter(is_included(spec))
    return kept.groupBy("partition_label").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(spec.dataset).alias("dataset"), F.col("partition_label").alias("partition"), "rows"
    )


def release_summary(df: DataFrame, spec: ReleaseSpec, max_rows: int | None = None) -> DataFrame:
    """Source, exported and excluded rows of a dataset."""
    return labelled(df, spec).agg(
        F.lit(spec.dataset).alias("dataset"),
        F.lit(spec.source_table).alias("source_table"),
        F.lit(spec.description).alias("description"),
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(is_included(spec)).alias("exported_rows"),
        F.count_if(~is_included(spec)).alias("excluded_rows"),
        F.lit(spec.partition_field or "").alias("partition_field"),
        F.lit(max_rows is not None).alias("is_sample_export"),
    )


def release_sample(df: DataFrame, spec: ReleaseSpec, n: int = SAMPLE_ROWS) -> DataFrame:
    """The first n rows of every released partition in the spec's order.

    Spark limits the ranks inside each task before the shuffle, so a hot partition does not meet in one task; it does so
    up to the limit in `spark.sql.optimizer.windowGroupLimitThreshold`, which `build_session` raises.
    """
    return first_rows(labelled(df, spec).filter(is_included(spec)), list(spec.sample_order), n)


def data_dictionary(df: DataFrame, dataset: str, source_table: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per column: name, type, mode, description."""
    rows = [
        (
            dataset,
            source_table,
            field.name,
            field.dataType.simpleString(),
            "NULLABLE" if field.nullable else "REQUIRED",
            (field.metadata or {}).get("description", ""),
        )
        for field in (schema or df.schema).fields
    ]
    names = "dataset string, source_table string, field_name string, field_type string, mode string, description string"
    return df.sparkSession.createDataFrame(rows, names)


def write_csv(df: DataFrame, path: str, header_bom: bool = True, single_file: bool = False, blank_nulls: bool = True) -> None:
    """CSV with a byte order mark before the first header name."""
    named = df.toDF(*[(BOM if header_bom and at == 0 else "") + name for at, name in enumerate(df.columns)])
    out = named.coalesce(1) if single_file else named
    out.write.mode("errorifexists").option("nullValue", "" if blank_nulls else "NULL").option("emptyValue", "").csv(path, header=True)


def write_samples(sample: DataFrame, path: str) -> None:
    """One CSV for each partition, in a folder of its label; a sample is as small as its number of rows."""
    named = sample.toDF(*[(BOM if at == 0 and name != "partition_label" else "") + name for at, name in enumerate(sample.columns)])
    out = named.repartition("partition_label").write.mode("errorifexists").partitionBy("partition_label")
    out.option("nullValue", "").option("emptyValue", "").csv(path, header=True)


def _is_empty_dir(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return not system.exists(target) or not system.listStatus(target)


def ensure_empty_release_dir(spark: SparkSession, path: str) -> None:
    if not _is_empty_dir(spark, path):
        raise RuntimeError(f"Release directory is not empty: {path}")


def export_dataset(df: DataFrame, spec: ReleaseSpec, out_dir: str, rows_per_file: int = ROWS_PER_FILE, max_rows: int | None = None) -> None:
    """Snappy Parquet of at most `rows_per_file` rows each, under label folders where the spec has a field.

    Rebalancing splits a large label over several tasks and keeps a small one in few files.
    """
    source = df.limit(max_rows) if max_rows is not None else df
    kept = labelled(source, spec).filter(is_included(spec))
    writer_of = lambda rows: rows.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).option("compression", "snappy")
    target = f"{out_dir}/{spec.dataset}"
    if spec.partition_field is None:
        writer_of(kept.drop("partition_label")).parquet(target)
        return
    # The label takes the field's name in the folders; the stored column keeps the field under its own name.
    stored = kept.withColumnRenamed(spec.partition_field, f"{spec.partition_field}_value").withColumnRenamed(
        "partition_label", spec.partition_field
    )
    writer_of(stored.hint("rebalance", F.col(spec.partition_field))).partitionBy(spec.partition_field).parquet(target)


def released_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of the Parquet files below a folder; nothing of them is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.col("length").alias("bytes"))


def with_content_facts(files: DataFrame) -> DataFrame:
    """Add `rows`, out of each Parquet footer, and `sha256`, of files of any size, read a piece at a time in tasks over the list."""

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sums = [], []
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    rows.append(pq.read_metadata(file).num_rows)
                digest = hashlib.sha256()
                with system.open_input_stream(name, compression=None) as stream:
                    while part := stream.read(PIECE):
                        digest.update(part)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64()), pa.array(sums)], names=["path", "bytes", "rows", "sha256"])

    return files.mapInArrow(facts, "path string, bytes bigint, rows bigint, sha256 string")


def file_manifest(spark: SparkSession, release_dir: str, specs: list[ReleaseSpec]) -> DataFrame:
    """Per released file: dataset, partition, rows, relative path, bytes and SHA-256."""
    listed = reduce(lambda left, right: left.unionByName(right), [released_files(spark, f"{release_dir}/{spec.dataset}") for spec in specs])
    files = with_content_facts(listed.repartition(spark.sparkContext.defaultParallelism))
    relative = F.regexp_extract("path", r"/((?:" + "|".join(spec.dataset for spec in specs) + r")/[^/]*(?:/[^/]*)?\.parquet)$", 1)
    return files.select(
        F.substring_index(relative, "/", 1).alias("dataset"),
        F.coalesce(F.nullif(F.regexp_extract(relative, r"/[^/=]+=([^/]*)/", 1), F.lit("")), F.lit("")).alias("partition"),
        "rows",
        relative.alias("relative_path"),
        "bytes",
        "sha256",
    )


def partition_manifest(files: DataFrame) -> DataFrame:
    """Rows, files and bytes per dataset and partition."""
    return files.groupBy("dataset", F.coalesce(F.nullif(F.col("partition"), F.lit("")), F.lit("all")).alias("partition")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("parquet_files"), F.sum("bytes").alias("bytes")
    )


def released_rows(spark: SparkSession, out_dir: str, spec: ReleaseSpec) -> DataFrame:
    """A released dataset as it was written, with `partition_label`."""
    rows = spark.read.parquet(f"{out_dir}/{spec.dataset}")
    if spec.partition_field is None:
        return rows.withColumn("partition_label", F.lit("all"))
    named = rows.withColumn("partition_label", F.col(spec.partition_field).cast("string")).drop(spec.partition_field)
    return named.withColumnRenamed(f"{spec.partition_field}_value", spec.partition_field)


def first_rows(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first n rows of each `partition_label`, numbered from one as `sample_rank`."""
    first = Window.partitionBy("partition_label").orderBy(*[F.col(name) for name in order if name in rows.columns])
    return rows.withColumn("sample_rank", F.row_number().over(first)).filter(F.col("sample_rank") <= n)


def source_count(source: DataFrame, spec: ReleaseSpec, max_rows: int | None) -> int | None:
    """Rows of the source where they aren't just those exported; a scan of the partition field alone."""
    if spec.included is None and max_rows is None:
        return None
    return (source.select(spec.partition_field) if spec.partition_field else source).count()


def export_release(
    tables: dict[str, DataFrame],
    out_dir: str,
    names: list[str] | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    sample_rows: int = SAMPLE_ROWS,
    max_rows: int | None = None,
) -> DataFrame:
    """Write the chosen datasets with samples, summary, dictionary and manifests; return the file manifest.

    `tables` maps source table names to frames. The target must be empty. Each source is read in full once, when it is
    written; samples come from the written files and row counts from their footers, and only where rows may be left out
    are the source's rows counted beside it.
    """
    specs = select_specs(names or ["all"])
    spark = next(iter(tables.values())).sparkSession
    ensure_empty_release_dir(spark, out_dir)
    sources, dictionaries = {}, []
    for spec in specs:
        source = tables[spec.source_table]
        export_dataset(source, spec, out_dir, rows_per_file, max_rows)
        sources[spec.dataset] = source_count(source, spec, max_rows)
        dictionaries.append(data_dictionary(source, spec.dataset, spec.source_table))
        sample = first_rows(released_rows(spark, out_dir, spec), list(spec.sample_order), sample_rows)
        write_samples(sample.drop("sample_rank"), f"{out_dir}/csv_samples/{spec.dataset}")
    manifest = file_manifest(spark, out_dir, specs).persist()
    written = {row["dataset"]: row["rows"] for row in manifest.groupBy("dataset").agg(F.sum("rows").alias("rows")).collect()}
    summary = []
    for spec in specs:
        exported = written.get(spec.dataset, 0)
        known = sources[spec.dataset]
        # A row limit takes some rows of all, so the excluded ones can't be told from those beyond the limit.
        excluded = known - exported if known is not None and max_rows is None else 0
        if excluded < 0:
            raise RuntimeError(f"row count mismatch for {spec.dataset}: {exported} written of {known}")
        summary.append((spec.dataset, spec.source_table, spec.description, exported if known is None else known, exported, excluded, spec.partition_field or "", max_rows is not None))
    shape = "dataset string, source_table string, description string, source_rows long, exported_rows long, excluded_rows long, partition_field string, is_sample_export boolean"
    parts = partition_manifest(manifest).groupBy("dataset").agg(F.sum("parquet_files").alias("parquet_files"))
    write_csv(spark.createDataFrame(summary, shape).join(parts, "dataset", "left").orderBy("dataset"), f"{out_dir}/release_summary")
    write_csv(reduce(lambda left, right: left.unionByName(right), dictionaries).coalesce(1), f"{out_dir}/data_dictionary")
    write_csv(manifest.orderBy("dataset", "relative_path"), f"{out_dir}/file_manifest")
    write_csv(partition_manifest(manifest).orderBy("dataset", "partition"), f"{out_dir}/partition_manifest")
    return manifest
