"""Table schemas and the additive conform step."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STRING, LONG, DOUBLE, BOOLEAN, TIMESTAMP = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()

# The stored tables, column by column, in stored order.

SCRAPE_JOBS = T.StructType(
    [
        T.StructField("job_id", STRING, nullable=False),
        T.StructField("provider", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("planned_window", STRING, nullable=False),
        T.StructField("scheduled_at", TIMESTAMP, nullable=False),
        T.StructField("status", STRING, nullable=False),
        T.StructField("attempt_count", LONG, nullable=False),
        T.StructField("max_attempts", LONG, nullable=False),
        T.StructField("created_at", TIMESTAMP, nullable=False),
        T.StructField("started_at", TIMESTAMP, nullable=True),
        T.StructField("finished_at", TIMESTAMP, nullable=True),
        T.StructField("raw_uri", STRING, nullable=True),
        T.StructField("processed_rows", LONG, nullable=True),
        T.StructField("error", STRING, nullable=True),
    ]
)

JOB_MANIFEST = T.StructType(
    [
        T.StructField("job_id", STRING, nullable=False),
        T.StructField("run_id", STRING, nullable=True),
        T.StructField("provider", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("planned_window", STRING, nullable=False),
        T.StructField("scheduled_at", TIMESTAMP, nullable=False),
        T.StructField("created_at", TIMESTAMP, nullable=False),
        T.StructField("task_name", STRING, nullable=True),
        T.StructField("status", STRING, nullable=True),
        T.StructField("attempt_count", LONG, nullable=True),
        T.StructField("max_attempts", LONG, nullable=True),
        T.StructField("started_at", TIMESTAMP, nullable=True),
        T.StructField("finished_at", TIMESTAMP, nullable=True),
        T.StructField("raw_uri", STRING, nullable=True),
        T.StructField("processed_rows", LONG, nullable=True),
        T.StructField("error", STRING, nullable=True),
    ]
)

JOB_EVENTS = T.StructType(
    [
        T.StructField("event_id", STRING, nullable=False),
        T.StructField("job_id", STRING, nullable=False),
        T.StructField("provider", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("planned_window", STRING, nullable=False),
        T.StructField("event_type", STRING, nullable=False),
        T.StructField("event_time", TIMESTAMP, nullable=False),
        T.StructField("message", STRING, nullable=True),
        T.StructField("raw_uri", STRING, nullable=True),
        T.StructField("processed_rows", LONG, nullable=True),
    ]
)

JOB_DIAGNOSTICS = T.StructType(
    [
        T.StructField("diagnostic_id", STRING, nullable=False),
        T.StructField("job_id", STRING, nullable=False),
        T.StructField("run_id", STRING, nullable=True),
        T.StructField("provider", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("planned_window", STRING, nullable=False),
        T.StructField("diagnostic_time", TIMESTAMP, nullable=False),
        T.StructField("worker_received_at", TIMESTAMP, nullable=True),
        T.StructField("worker_started_at", TIMESTAMP, nullable=True),
        T.StructField("limiter_enabled", BOOLEAN, nullable=True),
        T.StructField("limiter_key", STRING, nullable=True),
        T.StructField("limiter_acquire_started_at", TIMESTAMP, nullable=True),
        T.StructField("limiter_acquire_finished_at", TIMESTAMP, nullable=True),
        T.StructField("limiter_attempts", LONG, nullable=True),
        T.StructField("limiter_spacing_ms", LONG, nullable=True),
        T.StructField("limiter_previous_next_allowed_ms", LONG, nullable=True),
        T.StructField("limiter_token_reserved_for_ms", LONG, nullable=True),
        T.StructField("limiter_token_reserved_for", TIMESTAMP, nullable=True),
        T.StructField("limiter_wait_ms", LONG, nullable=True),
        T.StructField("api_request_started_at", TIMESTAMP, nullable=True),
        T.StructField("api_request_finished_at", TIMESTAMP, nullable=True),
        T.StructField("api_latency_ms", LONG, nullable=True),
        T.StructField("api_url", STRING, nullable=True),
        T.StructField("http_status", LONG, nullable=True),
        T.StructField("outcome", STRING, nullable=True),
        T.StructField("processed_rows", LONG, nullable=True),
        T.StructField("raw_uri", STRING, nullable=True),
        T.StructField("error", STRING, nullable=True),
    ]
)

SNAPSHOTS = T.StructType(
    [
        T.StructField("snapshot_id", STRING, nullable=False),
        T.StructField("job_id", STRING, nullable=False),
        T.StructField("provider", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("planned_window", STRING, nullable=False),
        T.StructField("scheduled_at", TIMESTAMP, nullable=False),
        T.StructField("captured_at", TIMESTAMP, nullable=False),
        T.StructField("Name", STRING, nullable=True),
        T.StructField("Rating", DOUBLE, nullable=True),
        T.StructField("ReviewCount", LONG, nullable=True),
        T.StructField("Categories", STRING, nullable=True),
        T.StructField("DeliveryTime", STRING, nullable=True),
        T.StructField("DeliveryFee", STRING, nullable=True),
        T.StructField("MinimumOrder", STRING, nullable=True),
        T.StructField("Offer", STRING, nullable=True),
        T.StructField("Tags", STRING, nullable=True),
        T.StructField("Url", STRING, nullable=True),
        T.StructField("Vertical", STRING, nullable=True),
        T.StructField("ListingId", STRING, nullable=True),
        T.StructField("CuisineIds", STRING, nullable=True),
    ]
)

MENU_TASKS = T.StructType(
    [
        T.StructField("task_id", STRING, nullable=False),
        T.StructField("run_id", STRING, nullable=False),
        T.StructField("restaurant_id", STRING, nullable=False),
        T.StructField("restaurant_name", STRING, nullable=True),
        T.StructField("restaurant_unique_name", STRING, nullable=False),
        T.StructField("restaurant_url", STRING, nullable=True),
        T.StructField("cuisine_names", STRING, nullable=True),
        T.StructField("scheduled_at", TIMESTAMP, nullable=False),
        T.StructField("created_at", TIMESTAMP, nullable=False),
        T.StructField("task_name", STRING, nullable=True),
    ]
)

MENU_RESULTS = T.StructType(
    [
        T.StructField("result_id", STRING, nullable=False),
        T.StructField("task_id", STRING, nullable=False),
        T.StructField("run_id", STRING, nullable=False),
        T.StructField("restaurant_id", STRING, nullable=False),
        T.StructField("restaurant_name", STRING, nullable=True),
        T.StructField("restaurant_unique_name", STRING, nullable=False),
        T.StructField("restaurant_url", STRING, nullable=True),
        T.StructField("cuisine_names", STRING, nullable=True),
        T.StructField("fetched_at", TIMESTAMP, nullable=False),
        T.StructField("manifest_source", STRING, nullable=True),
        T.StructField("manifest_url", STRING, nullable=True),
        T.StructField("http_status", LONG, nullable=True),
        T.StructField("latency_ms", LONG, nullable=True),
        T.StructField("fallback_used", BOOLEAN, nullable=True),
        T.StructField("manifest_restaurant_id", STRING, nullable=True),
        T.StructField("manifest_name", STRING, nullable=True),
        T.StructField("timezone", STRING, nullable=True),
        T.StructField("is_offline", BOOLEAN, nullable=True),
        T.StructField("menu_count", LONG, nullable=True),
        T.StructField("items_url", STRING, nullable=True),
        T.StructField("item_details_url", STRING, nullable=True),
        T.StructField("opening_time_count", LONG, nullable=True),
        T.StructField("opening_service_types", STRING, nullable=True),
        T.StructField("outcome", STRING, nullable=True),
        T.StructField("error", STRING, nullable=True),
    ]
)

OPENING_TIMES = T.StructType(
    [
        T.StructField("opening_time_id", STRING, nullable=False),
        T.StructField("task_id", STRING, nullable=False),
        T.StructField("run_id", STRING, nullable=False),
        T.StructField("restaurant_id", STRING, nullable=False),
        T.StructField("restaurant_unique_name", STRING, nullable=False),
        T.StructField("service_type", STRING, nullable=True),
        T.StructField("day_of_week", STRING, nullable=True),
        T.StructField("interval_index", LONG, nullable=True),
        T.StructField("opens_at_local", STRING, nullable=True),
        T.StructField("closes_at_local", STRING, nullable=True),
        T.StructField("crosses_midnight", BOOLEAN, nullable=True),
        T.StructField("timezone", STRING, nullable=True),
        T.StructField("source", STRING, nullable=True),
        T.StructField("fetched_at", TIMESTAMP, nullable=False),
    ]
)

COVERAGE = T.StructType(
    [
        T.StructField("snapshot_label", STRING, nullable=False),
        T.StructField("postcode", STRING, nullable=False),
        T.StructField("restaurant_id", STRING, nullable=False),
        T.StructField("is_delivery", BOOLEAN, nullable=True),
        T.StructField("delivery_fee", DOUBLE, nullable=True),
        T.StructField("minimum_delivery_value", DOUBLE, nullable=True),
        T.StructField("delivery_eta_lower_minutes", LONG, nullable=True),
        T.StructField("delivery_eta_upper_minutes", LONG, nullable=True),
        T.StructField("drive_distance_meters", LONG, nullable=True),
    ]
)

PROFILE = T.StructType(
    [
        T.StructField("restaurant_id", STRING, nullable=False),
        T.StructField("restaurant_name", STRING, nullable=True),
        T.StructField("restaurant_unique_name", STRING, nullable=True),
        T.StructField("restaurant_url", STRING, nullable=True),
        T.StructField("address_first_line", STRING, nullable=True),
        T.StructField("city", STRING, nullable=True),
        T.StructField("postal_code", STRING, nullable=True),
        T.StructField("latitude", DOUBLE, nullable=True),
        T.StructField("longitude", DOUBLE, nullable=True),
        T.StructField("cuisine_names", STRING, nullable=True),
        T.StructField("cuisine_unique_names", STRING, nullable=True),
        T.StructField("rating_count", LONG, nullable=True),
        T.StructField("rating_star", DOUBLE, nullable=True),
        T.StructField("logo_url", STRING, nullable=True),
    ]
)

TABLES = {
    "scrape_jobs": SCRAPE_JOBS,
    "job_manifest": JOB_MANIFEST,
    "job_events": JOB_EVENTS,
    "job_diagnostics": JOB_DIAGNOSTICS,
    "restaurant_snapshots": SNAPSHOTS,
    "menu_manifest_tasks": MENU_TASKS,
    "menu_manifest_results": MENU_RESULTS,
    "restaurant_opening_times": OPENING_TIMES,
    "postcode_restaurant_delivery_map": COVERAGE,
    "restaurant_profile": PROFILE,
}
DAY_FIELD = {
    "scrape_jobs": "scheduled_at",
    "job_manifest": "scheduled_at",
    "job_events": "event_time",
    "job_diagnostics": "diagnostic_time",
    "restaurant_snapshots": "captured_at",
    "menu_manifest_tasks": "scheduled_at",
    "menu_manifest_results": "fetched_at",
    "restaurant_opening_times": "fetched_at",
}

# Raw JSON shapes, read by key. Numbers are declared as text, since providers also send them as text, and flags as
# Variant, since they are tested for truth; `functions/loose.py` types both.
LISTING = (
    "struct<filters:struct<groceries:struct<restaurantIds:array<string>>>,"
    "restaurants:array<struct<id:string,restaurantId:string,name:string,uniqueName:string,seoName:string,"
    "isDelivery:variant,isOpenNowForDelivery:variant,isTemporarilyOffline:variant,"
    "cuisines:array<struct<name:string,uniqueName:string>>,rating:struct<starRating:string,count:string>,"
    "deliveryEtaMinutes:struct<rangeLower:string,rangeUpper:string,approximate:string>,"
    "deliveryCost:string,minimumDeliveryValue:string,deals:array<struct<description:string>>,tags:array<string>,"
    "address:struct<firstLine:string,city:string,postalCode:string,location:struct<coordinates:array<string>>>,"
    "logoUrl:string,driveDistanceMeters:string>>>"
)
ENVELOPE = (
    "snapshot_id string, job_id string, provider string, postcode string, planned_window string, scheduled_at string,"
    f" captured_at string, source_url string, response {LISTING}"
)
OPENING_SERVICES = (
    "array<struct<ServiceType:string,TimesPerDay:array<struct<DayOfWeek:string,"
    "Times:array<struct<FromLocalTime:string,ToLocalTime:string>>>>>>"
)
MENU_MANIFEST = (
    "RestaurantId string, ItemsUrl string, ItemDetailsUrl string, Menus array<struct<Id:string>>,"
    f" RestaurantInfo struct<Name:string,TimeZone:string,IsOffline:boolean,RestaurantOpeningTimes:{OPENING_SERVICES}>"
)


def _cut(kind: T.DataType, paths: Iterable[str]) -> T.DataType:
    if "" in paths:
        return kind
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_cut(kind.elementType, paths))
    wanted: dict[str, list[str]] = {}
    for path in paths:
        name, _, rest = path.partition(".")
        wanted.setdefault(name, []).append(rest)
    if missing := wanted.keys() - set(kind.fieldNames()):
        raise ValueError(f"no such fields: {sorted(missing)}")
    return T.StructType([T.StructField(field.name, _cut(field.dataType, wanted[field.name])) for field in kind if field.name in wanted])


def narrowed(schema: str, paths: Iterable[str]) -> str:
    """A JSON shape cut down to the fields at the dotted paths; a path names a field with all that is in it."""
    return ",".join(f"{field.name} {field.dataType.simpleString()}" for field in _cut(T.StructType.fromDDL(schema), list(paths)))


def conform_to_schema(df: DataFrame, schema: T.StructType, check_required: bool = True) -> DataFrame:
    """Add missing columns as NULL, cast the known ones, keep extra ones at the end.

    A required field that is missing or NULL raises when the row is read.
    """
    present = {name: True for name in df.columns}
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`") if field.name in present else F.lit(None)
        value = value.cast(field.dataType)
        if check_required and not field.nullable:
            value = F.when(
                value.isNull(), F.raise_error(F.lit(f"required field is NULL: {field.name}")).cast(field.dataType)
            ).otherwise(value)
        columns.append(value.alias(field.name, metadata=field.metadata or {}))
    known = set(schema.fieldNames())
    extras = [F.col(f"`{name}`") for name in df.columns if name not in known]
    return df.select(*columns, *extras)


def missing_required(df: DataFrame, fields: list[str]) -> DataFrame:
    """Add `missing_fields`: the sorted names of the fields that are absent or NULL, NULL when none is."""
    present = set(df.columns)
    flags = [
        F.when(F.col(name).isNull(), F.lit(name)) if name in present else F.lit(name) for name in sorted(fields)
    ]
    names = F.array_join(F.array_compact(F.array(*flags)), ", ")
    return df.withColumn("missing_fields", F.nullif(names, F.lit("")))
