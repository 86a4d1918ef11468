import pytest
from pyspark.sql import functions as F

from catchment.operators import grocery
from catchment.sources import readers

TAGS = ["weekday_afternoon", "saturday_peak"]

NAMES = [
    ("Co-op Food", "coop", True), ("Co op", "coop", True), ("Coop", "coop", True), ("Cooperative", None, False), ("  Morrisons Daily", "morrisons", True),
    ("Morrisonson", None, False), ("Sainsbury's Local", "sainsburys", True), ("Sainsbury’s", "sainsburys", True), ("SAINSBURYS", "sainsburys", True),
    ("Asda", "asda", True), ("Asda  Cafe", None, False), ("asda café", "asda", True), ("Iceland", "iceland", True), ("Waitrose", "waitrose", True),
    ("Morrisonsé", "morrisons", True), ("SPAR", None, True), ("Spark", None, False), ("Shop N Drive", None, True), ("ShopNDrive", None, True), ("best-one", None, True),
    ("The Co-op", None, False), (None, None, False),
]
CUISINES = [
    ("Groceries", True), ("Pizza, Grocery", False), ("Groceries, Convenience", False), ("Groceriesx", False), ("supermarket , groceries", False),
    ("Pizza,groceries ,Thai", True), (None, False), ("Convenience", False),
]


def profiles(spark, *rows):
    return spark.createDataFrame(list(rows), "restaurant_id string, restaurant_name string, cuisine_names string")


def test_brand_and_tag_rules(spark, rows):
    df = profiles(spark, *[(str(at), name, None) for at, (name, _, _) in enumerate(NAMES)])
    found = {row["restaurant_id"]: (row["big_brand"], row["is_general_grocery"]) for row in rows(grocery.classify_profiles(df))}
    assert found == {str(at): (brand, general) for at, (_, brand, general) in enumerate(NAMES)}
    df = profiles(spark, *[(str(at), None, cuisine) for at, (cuisine, _) in enumerate(CUISINES)])
    found = {row["restaurant_id"]: row["has_groceries_tag"] for row in rows(grocery.classify_profiles(df))}
    assert found == {str(at): tagged for at, (_, tagged) in enumerate(CUISINES)}


@pytest.fixture
def tables(spark):
    profile = profiles(spark, ("1", "Coop", "Groceries"), ("1", "Co-op again", None), ("2", "Asda", None), ("3", "Cafe", "Pizza"), (None, "Coop", None))
    coverage = spark.createDataFrame(
        [("l", "a", "1", True), ("l", "a", "1", True), ("l", "a", "2", None), ("l", "a", "3", True), ("l", "b", "3", True), ("l", "c", "9", True), ("l", "d", "2", False)],
        "snapshot_label string, postcode string, restaurant_id string, is_delivery boolean",
    )
    snapshots = spark.createDataFrame(
        [("weekday_afternoon", "a", "2"), ("weekday_afternoon", "a", "2"), ("smoke", "a", "1"), (None, "a", "1"), ("saturday_peak", "b", None)],
        "planned_window string, postcode string, ListingId string",
    )
    return coverage, snapshots, profile


def test_availability_counts_distinct_outlets(tables, rows):
    found = {(row["source_tag"], row["postcode"]): row for row in rows(grocery.grocery_availability(*tables, TAGS))}
    assert set(found) == {("full_coverage", "a"), ("full_coverage", "b"), ("weekday_afternoon", "a")}
    row = found["full_coverage", "a"]
    assert (row["big_brand_grocery_count"], row["general_grocery_count"], row["groceries_cuisine_tag_count"], row["has_coop"], row["has_asda"]) == (1, 1, 1, "yes", "no")
    assert found["full_coverage", "b"]["big_brand_grocery_count"] == 0
    assert found["weekday_afternoon", "a"]["has_asda"] == "yes"


def test_pairs_with_classification(tables, rows):
    coverage, snapshots, profile = tables
    assert len(rows(grocery.static_restaurants(coverage, profile))) == 4  # outlet 1 has two differing profiles
    assert len(rows(grocery.temporal_restaurants(snapshots, profile, TAGS))) == 1


def test_grid_keeps_every_area_and_key(spark, tables, rows):
    ew = spark.createDataFrame([("E1", " A "), ("E2", "a"), ("E1", "A"), (None, "b"), ("E9", None)], "LSOA21CD string, POSTCODE string")
    sc = spark.createDataFrame([("S1", "z z")], "DZCode string, Postcode string")
    geography = readers.read_geography(ew, sc)
    assert sorted((row["postcode"], row["geo_code"], row["geo_type"]) for row in rows(geography)) == [("a", "E1", "lsoa"), ("a", "E2", "lsoa"), ("zz", "S1", "dz")]
    intervals = readers.read_window_config(spark, {"weekday_afternoon": [["2026-06-17T14:00:00", "2026-06-17T18:00:00"]], "saturday_peak": [["2026-06-20T14:00:00", "2026-06-20T22:00:00"]]})
    grid = grocery.grocery_grid(geography, grocery.source_keys(intervals), grocery.grocery_availability(*tables, TAGS))
    found = rows(grid)
    assert len(found) == 9
    zero = [row for row in found if row["postcode"] == "zz"]
    assert all(row["big_brand_grocery_count"] == 0 and row["has_coop"] == "no" for row in zero)
    static = [row for row in found if row["source_dataset"] == "static_map"]
    assert all(row["window_start_local"] is None for row in static) and {row["geo_code"] for row in static if row["has_coop"] == "yes"} == {"E1", "E2"}
    assert {row["window_end_local"] for row in found if row["source_tag"] == "saturday_peak"} == {"22:00"}
    assert {row["rows"] for row in rows(grocery.rows_by_tag(grid))} == {3}


def test_labels_and_bounds_are_checked(spark, tables, rows):
    coverage, _, _ = tables
    assert rows(grocery.static_label(coverage)) == [{"snapshot_label": "l"}]
    for other in (coverage.withColumn("snapshot_label", F.col("postcode")), coverage.filter("false"), coverage.withColumn("snapshot_label", F.lit(None).cast("string"))):
        with pytest.raises(Exception, match="exactly one static snapshot label"):
            grocery.static_label(other).collect()
    uneven = readers.read_window_config(spark, {"t": [["2026-06-17T14:00:00", "2026-06-17T18:00:00"], ["2026-06-18T14:00:00", "2026-06-18T19:00:00"]]})
    with pytest.raises(Exception, match="inconsistent local times"):
        grocery.window_bounds(uneven).collect()


def test_combined_postcodes(spark, rows):
    one = spark.createDataFrame([("A 1",), (None,)], "postcode string")
    two = spark.createDataFrame([("a1",), ("B2",)], "postcode string")
    assert [row["postcode"] for row in rows(readers.combine_postcodes(one, two), "postcode")] == ["a1", "b2"]


def test_flagship_plan_has_no_expand_and_no_python(spark, tables):
    plan = grocery.grocery_availability(*tables, TAGS)._jdf.queryExecution().toString()
    assert "Expand" not in plan and "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
