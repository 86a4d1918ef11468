import hashlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from catchment.sources import writers
from catchment.sources.schemas import SNAPSHOTS


@pytest.fixture
def tables(spark):
    snapshots = spark.sql(
        """SELECT CASE id % 6 WHEN 0 THEN 'smoke' WHEN 1 THEN NULL WHEN 2 THEN 'saturday peak' WHEN 3 THEN 'saturday_peak' ELSE 'weekday_evening' END AS planned_window,
        'p' || id AS postcode, CAST(id AS STRING) AS ListingId, timestamp_seconds(id) AS captured_at FROM range(600)"""
    )
    profile = spark.range(50).select(F.col("id").cast("string").alias("restaurant_id"))
    return {"restaurant_snapshots": snapshots, "restaurant_profile": profile}


def test_release(spark, tables, tmp_path, rows):
    out = str(tmp_path / "release")
    manifest = rows(writers.export_release(tables, out, ["profile", "observed_availability"], rows_per_file=40, sample_rows=5), "relative_path")
    parts = rows(writers.partition_manifest(writers.file_manifest(spark, out, writers.select_specs(["profile", "observed_availability"]))), "dataset", "partition")
    # Two raw values that clean to one label merge.
    assert [(row["dataset"], row["partition"], row["rows"]) for row in parts] == [("observed_availability", "saturday_peak", 200), ("observed_availability", "weekday_evening", 200), ("restaurant_profile", "all", 50)]
    assert all(row["rows"] <= 40 for row in manifest) and sum(row["rows"] for row in manifest) == 450
    for row in manifest:
        path = tmp_path / "release" / row["relative_path"]
        assert path.stat().st_size == row["bytes"] and hashlib.sha256(path.read_bytes()).hexdigest() == row["sha256"]
        assert pq.ParquetFile(path).metadata.row_group(0).column(0).compression == "SNAPPY"
    summary = next((tmp_path / "release" / "release_summary").glob("*.csv")).read_text(encoding="utf-8")
    assert summary.startswith("﻿") and "observed_availability,restaurant_snapshots" in summary and ",600,400,200," in summary
    samples = {path.parent.name: path.read_text(encoding="utf-8") for path in (tmp_path / "release" / "csv_samples" / "observed_availability").rglob("*.csv")}
    # One file with a header and five rows for each partition.
    assert set(samples) == {"partition_label=saturday_peak", "partition_label=weekday_evening"}
    assert all(text.startswith("\ufeff") and text.count("\n") == 6 for text in samples.values())
    assert ",smoke," not in "".join(samples.values()) and "saturday peak" in samples["partition_label=saturday_peak"]
    with pytest.raises(RuntimeError, match="not empty"):
        writers.export_release(tables, out, ["profile"])


def test_sample_export(tables, tmp_path, rows):
    found = rows(writers.export_release(tables, str(tmp_path / "small"), ["profile"], max_rows=7))
    assert sum(row["rows"] for row in found) == 7
    summary = next((tmp_path / "small" / "release_summary").glob("*.csv")).read_text(encoding="utf-8")
    assert f",{tables['restaurant_profile'].count()},7,0," in summary


def test_specs_and_dictionary(spark, tables, rows):
    assert [spec.dataset for spec in writers.select_specs(["profile", "profile", "static_coverage"])] == ["restaurant_profile", "static_coverage"]
    assert len(writers.select_specs(["all"])) == 4
    found = rows(writers.data_dictionary(tables["restaurant_snapshots"], "d", "t", SNAPSHOTS))
    assert found[0] == {"dataset": "d", "source_table": "t", "field_name": "snapshot_id", "field_type": "string", "mode": "REQUIRED", "description": ""}
    assert len(found) == 20


def test_summary_counts(tables, rows):
    row = rows(writers.release_summary(tables["restaurant_snapshots"], writers.RELEASE["observed_availability"]))[0]
    assert (row["source_rows"], row["exported_rows"], row["excluded_rows"], row["is_sample_export"]) == (600, 400, 200, False)


def test_sample_limits_ranks_before_the_shuffle(tables):
    plan = writers.release_sample(tables["restaurant_snapshots"], writers.RELEASE["observed_availability"], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("n", [1000, 1001])
def test_the_plan_doesnt_change_with_the_sample(tables, n):
    many = tables["restaurant_snapshots"].withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(100))))
    plan = writers.release_sample(many, writers.RELEASE["observed_availability"], n)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_each_source_is_read_in_full_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(rows):
        for batch in rows:
            seen.add(batch.num_rows)
            yield batch

    shape = "planned_window string, postcode string, ListingId string, captured_at timestamp"
    source = spark.sql("SELECT 'saturday_peak' AS planned_window, 'p' || id AS postcode, 'x' AS ListingId, timestamp_seconds(id) AS captured_at FROM range(300)").mapInArrow(count, shape)
    profile = spark.range(70).select(F.col("id").cast("string").alias("restaurant_id")).mapInArrow(count, "restaurant_id string")
    writers.export_release({"restaurant_profile": profile}, str(tmp_path / "one"), ["profile"])
    assert seen.value == 70
    writers.export_release({"restaurant_snapshots": source}, str(tmp_path / "two"), ["observed_availability"])
    assert seen.value == 70 + 2 * 300  # once for the files, once for the rows that an allow-list leaves out


def test_hashes_of_pieces(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(writers, "PIECE", 100)
    spark.range(5000).repartition(3).write.parquet(str(tmp_path / "files"))
    found = rows(writers.with_content_facts(writers.released_files(spark, str(tmp_path / "files"))))
    assert sum(row["rows"] for row in found) == 5000 and len(found) == 3
    for row in found:
        data = open(row["path"].removeprefix("file:"), "rb").read()
        assert (row["bytes"], row["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
