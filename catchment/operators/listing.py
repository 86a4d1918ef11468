"""Listing jobs: raw envelopes to open-now rows, coverage and outlet profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.ids import key_of, uuid5
from catchment.functions.loose import json_flag, json_truth, number, whole
from catchment.functions.rows import open_array
from catchment.functions.text import (
    blank_to_null,
    format_eta,
    format_money,
    is_blank,
    join_distinct_sorted,
    join_present,
    menu_page_url,
)

PROVENANCE = ("snapshot_id", "job_id", "provider", "postcode", "planned_window", "scheduled_at", "captured_at")
DEFAULT_BASE_URL = "https://listings.example"


def _of_outlets(*names: str) -> tuple[str, ...]:
    return tuple(f"response.restaurants.{name}" for name in names)


#: The envelope fields that each job reads, so that a document is parsed no further.
KEY_READS = _of_outlets("id", "restaurantId", "uniqueName", "seoName")
LISTING_READS = (
    *PROVENANCE,
    "response.filters",
    *_of_outlets("id", "name", "uniqueName", "cuisines", "rating", "deliveryEtaMinutes", "deliveryCost", "minimumDeliveryValue", "deals", "tags"),
)
OPEN_READS = (*LISTING_READS, *_of_outlets("isDelivery", "isOpenNowForDelivery", "isTemporarilyOffline"))
COVERAGE_READS = (
    "postcode",
    *KEY_READS,
    *_of_outlets("isDelivery", "deliveryCost", "minimumDeliveryValue", "deliveryEtaMinutes", "driveDistanceMeters"),
)
PROFILE_READS = ("captured_at", *KEY_READS, *_of_outlets("name", "address", "cuisines", "rating", "logoUrl"))


def restaurants_of(raw: DataFrame, keep: list[str]) -> DataFrame:
    """One row per listed restaurant: the kept columns, `position` and `restaurant`."""
    return open_array(raw, keep, "response.restaurants", "restaurant", "position")


def is_open_now(restaurant: Column) -> Column:
    """Delivers and is open for delivery; a missing offline flag counts as online."""
    return (
        json_truth(restaurant["isDelivery"])
        & json_truth(restaurant["isOpenNowForDelivery"])
        & ~json_truth(restaurant["isTemporarilyOffline"])
    )


def listing_fields(
    restaurant: Column, grocery_ids: Column | None = None, base_url: str = DEFAULT_BASE_URL, id_name: str = "ListingId"
) -> list[Column]:
    """The normalised listing columns of one restaurant struct."""
    identifier = restaurant["id"]
    vertical = F.lit("restaurants")
    if grocery_ids is not None:
        listed = F.coalesce(F.array_contains(F.coalesce(grocery_ids, F.array().cast("array<string>")), identifier), F.lit(False))
        vertical = F.when(listed, "groceries").otherwise("restaurants")
    linked = F.when(~F.coalesce(identifier, F.lit("")).isin("", "0"), restaurant["uniqueName"])
    deals = F.filter(restaurant["deals"]["description"], lambda text: ~is_blank(text))
    eta = restaurant["deliveryEtaMinutes"]
    return [
        restaurant["name"].alias("Name"),
        number(restaurant["rating"]["starRating"]).alias("Rating"),
        whole(restaurant["rating"]["count"]).alias("ReviewCount"),
        join_present(restaurant["cuisines"]["name"]).alias("Categories"),
        format_eta(eta["rangeLower"], eta["rangeUpper"], eta["approximate"]).alias("DeliveryTime"),
        format_money(restaurant["deliveryCost"]).alias("DeliveryFee"),
        format_money(restaurant["minimumDeliveryValue"]).alias("MinimumOrder"),
        blank_to_null(F.array_join(deals, "; ")).alias("Offer"),
        blank_to_null(F.array_join(restaurant["tags"], ", ")).alias("Tags"),
        menu_page_url(linked, base_url).alias("Url"),
        vertical.alias("Vertical"),
        identifier.alias(id_name),
        join_distinct_sorted(restaurant["cuisines"]["uniqueName"]).alias("CuisineIds"),
    ]


def listing_rows(raw: DataFrame, keep: tuple[str, ...] = PROVENANCE, open_only: bool = False, base_url: str = DEFAULT_BASE_URL, id_name: str = "ListingId") -> DataFrame:
    """Normalised rows of every listed restaurant, stamped with the kept envelope columns."""
    grocery_ids = F.col("response.filters.groceries.restaurantIds").alias("_grocery_ids")
    staged = open_array(raw, [*keep, grocery_ids], "response.restaurants", "_restaurant")
    if open_only:
        staged = staged.filter(is_open_now(F.col("_restaurant")))
    return staged.select(*keep, *listing_fields(F.col("_restaurant"), F.col("_grocery_ids"), base_url, id_name))


def snapshot_id(job: Column, captured: Column) -> Column:
    return uuid5(key_of(F.lit("snapshot"), job, captured))


def open_now(raw: DataFrame, base_url: str = DEFAULT_BASE_URL, id_name: str = "ListingId") -> DataFrame:
    """Observed availability: open-now rows with provenance; a missing snapshot id is derived from job and time."""
    stamped = raw.withColumn(
        "snapshot_id", F.coalesce(F.col("snapshot_id"), snapshot_id(F.col("job_id"), F.col("captured_at")))
    )
    return listing_rows(stamped, PROVENANCE, open_only=True, base_url=base_url, id_name=id_name)


def restaurant_key(restaurant: Column) -> Column:
    """First usable identifier; blank and zero fall through, and none at all gives NULL."""
    names = ("id", "restaurantId", "uniqueName", "seoName")
    usable = [F.when(~restaurant[name].isin("", "0"), restaurant[name]) for name in names[:2]]
    usable += [F.when(restaurant[name] != "", restaurant[name]) for name in names[2:]]
    return F.coalesce(*usable)


def coverage_rows(raw: DataFrame, snapshot_label: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Static coverage: every listed restaurant that has an identifier, open or not.

    Minutes and metres keep the decimals they came with; the stored table has whole ones.
    """
    staged = restaurants_of(raw, [*keep, "postcode"]).withColumn("restaurant_id", restaurant_key(F.col("restaurant")))
    restaurant = F.col("restaurant")
    return staged.filter(F.col("restaurant_id").isNotNull()).select(
        *keep,
        F.lit(snapshot_label).alias("snapshot_label"),
        "postcode",
        "restaurant_id",
        json_flag(restaurant["isDelivery"]).alias("is_delivery"),
        number(restaurant["deliveryCost"]).alias("delivery_fee"),
        number(restaurant["minimumDeliveryValue"]).alias("minimum_delivery_value"),
        number(restaurant["deliveryEtaMinutes"]["rangeLower"]).alias("delivery_eta_lower_minutes"),
        number(restaurant["deliveryEtaMinutes"]["rangeUpper"]).alias("delivery_eta_upper_minutes"),
        number(restaurant["driveDistanceMeters"]).alias("drive_distance_meters"),
    )


def profile_fields(restaurant: Column) -> list[Column]:
    """What a profile takes from the document; its address on the site is made of these."""
    address = restaurant["address"]
    place = address["location"]["coordinates"]
    complete = F.size(F.coalesce(place, F.array().cast("array<string>"))) >= 2
    return [
        restaurant["name"].alias("restaurant_name"),
        restaurant["uniqueName"].alias("restaurant_unique_name"),
        address["firstLine"].alias("address_first_line"),
        address["city"].alias("city"),
        address["postalCode"].alias("postal_code"),
        F.when(complete, number(F.get(place, 1))).alias("latitude"),
        F.when(complete, number(F.get(place, 0))).alias("longitude"),
        join_present(restaurant["cuisines"]["name"]).alias("cuisine_names"),
        join_present(restaurant["cuisines"]["uniqueName"]).alias("cuisine_unique_names"),
        whole(restaurant["rating"]["count"]).alias("rating_count"),
        number(restaurant["rating"]["starRating"]).alias("rating_star"),
        restaurant["logoUrl"].alias("logo_url"),
    ]


def profile_rows(raw: DataFrame, arrival: tuple[str, ...] = ("captured_at", "raw_uri"), base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """One profile per restaurant, the last seen by (arrival columns, position in the listing).

    The first arrival column is an instant; its text may carry any offset from UTC.
    """
    staged = restaurants_of(raw, list(arrival)).withColumn("restaurant_id", restaurant_key(F.col("restaurant")))
    staged = staged.filter(F.col("restaurant_id").isNotNull()).select(
        "restaurant_id",
        F.struct(*profile_fields(F.col("restaurant"))).alias("_profile"),
        F.struct(F.col(arrival[0]).try_cast("timestamp").alias("_instant"), *arrival, "position").alias("_seen"),
    )
    latest = staged.groupBy("restaurant_id").agg(F.max_by("_profile", "_seen").alias("_profile"))
    # Rows are sorted to be grouped, so they hold nothing that can be made of the last ones later.
    name, slug, *others = (F.col(f"_profile.{field}") for field in latest.schema["_profile"].dataType.names)
    return latest.select("restaurant_id", name, slug, menu_page_url(slug, base_url).alias("restaurant_url"), *others)


def new_profiles(profiles: DataFrame, existing: DataFrame) -> DataFrame:
    return profiles.join(existing.select("restaurant_id"), "restaurant_id", "left_anti")


def backfill_stats(raw: DataFrame, existing: DataFrame) -> DataFrame:
    """Counters of a backfill: coverage rows, profiles before and after de-duplication, skipped, known and new.

    A document's own counts are taken in its row, so only its distinct restaurants go on to be grouped.
    """
    keys = F.coalesce(F.transform("response.restaurants", restaurant_key), F.array().cast("array<string>"))
    named = F.array_compact(keys)
    counted = raw.select(
        F.size(named).alias("named"), (F.size(keys) - F.size(named)).alias("nameless"), F.array_distinct(named).alias("ids")
    )
    opened = counted.select("named", "nameless", F.posexplode_outer("ids").alias("at", "restaurant_id"))
    once = F.coalesce(F.col("at"), F.lit(0)) == 0
    per_restaurant = opened.groupBy("restaurant_id").agg(
        F.count("restaurant_id").alias("documents"),
        F.sum(F.when(once, F.col("named")).otherwise(0)).alias("named"),
        F.sum(F.when(once, F.col("nameless")).otherwise(0)).alias("nameless"),
    )
    known = existing.select("restaurant_id").distinct().withColumn("known", F.lit(True))
    joined = per_restaurant.join(known, "restaurant_id", "left")
    has_id, is_known = F.col("restaurant_id").isNotNull(), F.coalesce(F.col("known"), F.lit(False))

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0).cast("long"))

    return joined.agg(
        total("named").alias("map_rows"),
        total("documents").alias("profiles_seen"),
        F.count_if(has_id).alias("profiles_unique"),
        total("nameless").alias("skipped_without_id"),
        F.count_if(has_id & is_known).alias("profiles_existing"),
        F.count_if(has_id & ~is_known).alias("profiles_new"),
    )


def reparse_audit(parsed_now: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that a fresh parse and the stored table do not share, with how often and on which side.

    Counting both sides in one grouping needs one shuffle; two exceptAll runs would need four.
    """
    columns = stored.columns
    both = parsed_now.select(*columns, F.lit(1).alias("_side")).unionByName(
        stored.select(*columns, F.lit(-1).alias("_side"))
    )
    balance = both.groupBy(*columns).agg(F.sum("_side").alias("_balance")).filter("_balance <> 0")
    return balance.select(
        *columns,
        F.when(F.col("_balance") > 0, "reparsed").otherwise("stored").alias("only_in"),
        F.abs("_balance").alias("copies"),
    )
