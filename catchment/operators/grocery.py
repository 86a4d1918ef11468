"""Grocery availability per postcode: brand classification, counts, and the geography grid."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.brands import DEFAULT_RULES, BrandRules, big_brand, has_groceries_tag, is_general_grocery

STATIC = ("static_map", "full_coverage")
TEMPORAL = "temporal_snapshot"
GROUP = ("source_dataset", "source_tag", "postcode")
COUNTS = ("big_brand_grocery_count", "general_grocery_count", "groceries_cuisine_tag_count")


def brand_flags(rules: BrandRules = DEFAULT_RULES) -> list[str]:
    return [f"has_{brand}" for brand, _ in rules.big_brands]


def classify_profiles(profile: DataFrame, rules: BrandRules = DEFAULT_RULES) -> DataFrame:
    return profile.select(
        F.col("restaurant_id").cast("string").alias("restaurant_id"),
        big_brand(F.col("restaurant_name"), rules).alias("big_brand"),
        is_general_grocery(F.col("restaurant_name"), rules).alias("is_general_grocery"),
        has_groceries_tag(F.col("cuisine_names"), rules).alias("has_groceries_tag"),
    )


def static_pairs(coverage: DataFrame) -> DataFrame:
    return coverage.filter(F.col("is_delivery")).select(
        F.lit(STATIC[0]).alias("source_dataset"),
        F.lit(STATIC[1]).alias("source_tag"),
        "postcode",
        F.col("restaurant_id").cast("string").alias("restaurant_id"),
    )


def temporal_pairs(snapshots: DataFrame, tags: Iterable[str], id_column: str = "ListingId") -> DataFrame:
    return snapshots.filter(F.col("planned_window").isin(list(tags))).select(
        F.lit(TEMPORAL).alias("source_dataset"),
        F.col("planned_window").alias("source_tag"),
        "postcode",
        F.col(id_column).cast("string").alias("restaurant_id"),
    )


def static_restaurants(coverage: DataFrame, profile: DataFrame, rules: BrandRules = DEFAULT_RULES) -> DataFrame:
    """Distinct deliverable (postcode, restaurant) pairs with their classification."""
    pairs = static_pairs(coverage).distinct()
    return pairs.join(classify_profiles(profile, rules).distinct(), "restaurant_id").select(
        *GROUP, "restaurant_id", "big_brand", "is_general_grocery", "has_groceries_tag"
    )


def temporal_restaurants(snapshots: DataFrame, profile: DataFrame, tags: Iterable[str], id_column: str = "ListingId", rules: BrandRules = DEFAULT_RULES) -> DataFrame:
    """Distinct observed (tag, postcode, restaurant) triples of the wanted tags with their classification."""
    pairs = temporal_pairs(snapshots, tags, id_column).distinct()
    return pairs.join(classify_profiles(profile, rules).distinct(), "restaurant_id").select(
        *GROUP, "restaurant_id", "big_brand", "is_general_grocery", "has_groceries_tag"
    )


def outlet_flags(profile: DataFrame, rules: BrandRules = DEFAULT_RULES) -> DataFrame:
    """One row of yes/no flags per restaurant, whatever the number of its profile rows.

    Outlets without a flag stay in: a postcode that has only those still reports zero counts.
    """
    classified = classify_profiles(profile, rules)
    flags = [
        F.bool_or(F.col("big_brand").isNotNull()).alias("any_brand"),
        F.bool_or("is_general_grocery").alias("general"),
        F.bool_or("has_groceries_tag").alias("tagged"),
    ]
    for brand, _ in rules.big_brands:
        flags.append(F.bool_or(F.coalesce(F.col("big_brand") == brand, F.lit(False))).alias(f"is_{brand}"))
    return classified.filter(F.col("restaurant_id").isNotNull()).groupBy("restaurant_id").agg(*flags)


#: Brands whose flags one number holds.
MASK = 60


def packed_flags(flags: DataFrame, rules: BrandRules) -> DataFrame:
    """The flags of `outlet_flags` as (restaurant_id, _counted, _brands_0, ...): bits of numbers, to be grouped in little room."""

    def bits(names: list[str], name: str) -> Column:
        parts = [F.shiftleft(F.coalesce(F.col(flag), F.lit(False)).cast("long"), at) for at, flag in enumerate(names)]
        return reduce(Column.bitwiseOR, parts, F.lit(0).cast("long")).alias(name)

    brands = [f"is_{brand}" for brand, _ in rules.big_brands]
    masks = [bits(brands[at : at + MASK], f"_brands_{at // MASK}") for at in range(0, len(brands), MASK)]
    return flags.select("restaurant_id", bits(["any_brand", "general", "tagged"], "_counted"), *masks)


def availability_columns(rules: BrandRules) -> tuple[list[Column], list[Column]]:
    """What is grouped of packed flags, and the report's columns made of that."""
    found = [F.count_if(F.col("_counted").bitwiseAND(1 << at) != 0).alias(name) for at, name in enumerate(COUNTS)]
    found += [F.bit_or(f"_brands_{at // MASK}").alias(f"_brands_{at // MASK}") for at in range(0, len(rules.big_brands), MASK)]
    shown: list[Column] = [F.col(name) for name in COUNTS]
    for at, name in enumerate(brand_flags(rules)):
        shown.append(F.when(F.col(f"_brands_{at // MASK}").bitwiseAND(1 << at % MASK) != 0, "yes").otherwise("no").alias(name))
    return found, shown


def grocery_availability(
    coverage: DataFrame,
    snapshots: DataFrame,
    profile: DataFrame,
    tags: Iterable[str],
    id_column: str = "ListingId",
    rules: BrandRules = DEFAULT_RULES,
) -> DataFrame:
    """Brand, grocer and tag counts per (source_dataset, source_tag, postcode).

    Distinct counts become two plain groupings: first to distinct (source, postcode, restaurant), whose shuffle key
    is spread however hot one postcode or restaurant is, then per postcode with partial sums.
    """
    sources = [STATIC, *((TEMPORAL, tag) for tag in dict.fromkeys(tags))]
    static = static_pairs(coverage).withColumn("_source", F.lit(0))
    temporal = temporal_pairs(snapshots, [tag for _, tag in sources[1:]], id_column)
    tag_names = F.array(*[F.lit(tag) for _, tag in sources[1:]]).cast("array<string>")
    temporal = temporal.withColumn("_source", F.array_position(tag_names, F.col("source_tag")).cast("int"))
    # Sources travel as their numbers and flags as bits: a task holds as many rows as fit its share of the shuffle, which is
    # packed, so what a row takes in memory decides how much that is.
    pairs = static.unionByName(temporal).select("_source", "postcode", "restaurant_id").distinct()
    found, shown = availability_columns(rules)
    flagged = pairs.join(packed_flags(outlet_flags(profile, rules), rules), "restaurant_id")
    grouped = flagged.groupBy("_source", "postcode").agg(*found)
    names = [F.get(F.array(*[F.lit(source[at]) for source in sources]), F.col("_source")).alias(GROUP[at]) for at in (0, 1)]
    return grouped.select(*names, "postcode", *shown)


def static_label(coverage: DataFrame) -> DataFrame:
    """The one snapshot label of the coverage table; none or several raise."""
    labels = coverage.agg(F.min("snapshot_label").alias("low"), F.max("snapshot_label").alias("high"), F.count_if(F.col("snapshot_label").isNull()).alias("blank"))
    wrong = F.col("low").isNull() | (F.col("low") != F.col("high")) | (F.col("blank") > 0)
    message = F.concat(
        F.lit("expected exactly one static snapshot label, found: "),
        F.concat_ws(", ", F.coalesce("low", F.lit("none")), F.nullif(F.col("high"), F.col("low"))),
    )
    return labels.select(F.when(wrong, F.raise_error(message).cast("string")).otherwise(F.col("low")).alias("snapshot_label"))


def window_bounds(intervals: DataFrame) -> DataFrame:
    """One (tag, local start, local end) per tag; intervals of a tag that differ in local time raise."""
    start, end = F.substring("local_start", 12, 5), F.substring("local_end", 12, 5)
    grouped = intervals.groupBy("tag").agg(
        F.min(start).alias("low_start"), F.max(start).alias("high_start"), F.min(end).alias("low_end"), F.max(end).alias("high_end")
    )
    steady = (F.col("low_start") == F.col("high_start")) & (F.col("low_end") == F.col("high_end"))
    return grouped.select(
        F.lit(TEMPORAL).alias("source_dataset"),
        F.col("tag").alias("source_tag"),
        F.when(steady, F.col("low_start"))
        .otherwise(F.raise_error(F.concat(F.lit("inconsistent local times for tag "), F.col("tag"))).cast("string"))
        .alias("window_start_local"),
        F.col("low_end").alias("window_end_local"),
    )


def source_keys(intervals: DataFrame) -> DataFrame:
    """The static key and one temporal key per tag."""
    text = F.lit(None).cast("string")
    static = intervals.sparkSession.range(1).select(
        F.lit(STATIC[0]).alias("source_dataset"),
        F.lit(STATIC[1]).alias("source_tag"),
        text.alias("window_start_local"),
        text.alias("window_end_local"),
    )
    return static.unionByName(window_bounds(intervals))


def grocery_grid(geography: DataFrame, keys: DataFrame, aggregates: DataFrame, rules: BrandRules = DEFAULT_RULES) -> DataFrame:
    """Every geography row for every source key, with zero counts and 'no' where nothing was found.

    The keys are settings (one per collection tag), so they travel as one array in each row; the grid needs no join.
    """
    settings = [
        F.struct(*[F.lit(row[name]).cast("string").alias(name) for name in keys.columns]) for row in keys.collect()
    ]
    grid = geography.select("postcode", "geo_code", "geo_type", F.inline(F.array(*settings)))
    joined = grid.join(aggregates, list(GROUP), "left")
    filled = {name: 0 for name in COUNTS} | {name: "no" for name in brand_flags(rules)}
    return joined.fillna(filled).select(
        "postcode",
        "geo_code",
        "geo_type",
        "source_dataset",
        "source_tag",
        "window_start_local",
        "window_end_local",
        *COUNTS,
        *brand_flags(rules),
    )


def rows_by_tag(output: DataFrame) -> DataFrame:
    return output.groupBy("source_dataset", "source_tag").agg(F.count(F.lit(1)).alias("rows"))
