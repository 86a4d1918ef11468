"""What a task holds or generates must not grow with the table: read off the plans, on rows made here."""

import contextlib
import io

from pyspark.sql import functions as F

from catchment.operators import grocery, jobs, listing
from catchment.plans import adapters
from catchment.sources import readers


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        df.explain()
    return shown.getvalue()


def test_large_tables_are_cut_into_stretches_of_their_key(spark):
    df = spark.range(20_000).repartition(2).select(F.col("id").alias("key"), (F.col("id") % 7).alias("other"))
    parts = adapters.spread(df, "key", 500).select("*", F.spark_partition_id().alias("part"))
    found = parts.groupBy("part").agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).orderBy("low").collect()
    assert len(found) == 40 and max(row["n"] for row in found) < 1500
    assert all(one["high"] < other["low"] for one, other in zip(found, found[1:]))  # noqa: B905
    assert adapters.spread(df, "key", 50_000).count() == adapters.spread(df).count() == 20_000


def test_profiles_are_sorted_without_their_address(spark):
    raw = spark.createDataFrame([('{"captured_at": "2026-01-01T08:00:00", "response": {"restaurants": [{"id": 7, "uniqueName": "x"}]}}', "u")], "value string, raw_uri string")
    profiles = listing.profile_rows(readers.parse_envelopes(raw, keep=("raw_uri",)))
    assert profiles.columns[:4] == ["restaurant_id", "restaurant_name", "restaurant_unique_name", "restaurant_url"]
    assert profiles.first()["restaurant_url"] == "https://listings.example/restaurants-x/menu"
    last = plan(profiles).splitlines()
    assert all("/menu" not in line for line in last[next(at for at, line in enumerate(last) if "SortAggregate" in line) :])


def test_outcomes_are_told_without_bodies(spark):
    log = spark.createDataFrame(
        [("t", "original", "u", 404, 1, 1, "no"), ("t", "v2_2", "v", 200, 1, 2, "yes"), ("t", "v2_2", "w", 200, 1, 3, None)],
        "task_id string, source string, url string, status long, latency_ms long, finished_at long, body string",
    )
    chosen = jobs.manifest_attempts(log)
    assert [(row["manifest_source"], row["outcome"], row["body"]) for row in chosen.collect()] == [("v2_2", "succeeded", "yes")]
    short = plan(chosen.select("task_id", "outcome")).split("SortAggregate")[1]
    assert "_body" not in short and "chosen.body" not in short and ", body" not in short


def test_grocery_pairs_move_numbers_of_sources(spark):
    profile = spark.createDataFrame([("1", "Coop", "Groceries")], "restaurant_id string, restaurant_name string, cuisine_names string")
    coverage = spark.createDataFrame([("a", "1", True)], "postcode string, restaurant_id string, is_delivery boolean")
    snapshots = spark.createDataFrame([("t", "a", "1"), ("u", None, "1"), (None, "a", "1")], "planned_window string, postcode string, ListingId string")
    found = grocery.grocery_availability(coverage, snapshots, profile, iter(["u", "t", "t"]))
    rows = {(row["source_dataset"], row["source_tag"], row["postcode"], row["big_brand_grocery_count"], row["has_coop"], row["has_asda"]) for row in found.collect()}
    assert rows == {("static_map", "full_coverage", "a", 1, "yes", "no"), ("temporal_snapshot", "t", "a", 1, "yes", "no"), ("temporal_snapshot", "u", None, 1, "yes", "no")}
    assert "hashpartitioning(_source" in plan(found) and "hashpartitioning(source_dataset" not in plan(found)
    assert grocery.grocery_availability(coverage, snapshots, profile, []).count() == 1


def test_many_brands_have_masks_of_their_own(spark):
    rules = grocery.BrandRules(big_brands=tuple((f"b{at}", f"brand{at}") for at in range(130)))
    profile = spark.createDataFrame([("1", "brand3", None), ("2", "brand129 ", None)], "restaurant_id string, restaurant_name string, cuisine_names string")
    coverage = spark.createDataFrame([("a", "1", True), ("a", "2", True)], "postcode string, restaurant_id string, is_delivery boolean")
    snapshots = spark.createDataFrame([], "planned_window string, postcode string, ListingId string")
    row = grocery.grocery_availability(coverage, snapshots, profile, ["t"], rules=rules).first().asDict()
    assert [name for name, value in row.items() if value == "yes"] == ["has_b3", "has_b129"] and row["big_brand_grocery_count"] == 2
