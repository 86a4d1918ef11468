import gzip
import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catchment.operators import listing, planning
from catchment.sources import readers, writers
from catchment.sources.schemas import COVERAGE, SNAPSHOTS, conform_to_schema, missing_required, narrowed

RESTAURANTS = [
    {
        "id": 77, "name": "Corner Larder", "uniqueName": "corner-larder", "isDelivery": True, "isOpenNowForDelivery": True,
        "cuisines": [{"name": "Bakery", "uniqueName": "bakery"}, {"name": "Deli", "uniqueName": "deli"}], "rating": {"starRating": 3.9, "count": 8},
        "deliveryEtaMinutes": {"rangeLower": 5, "rangeUpper": 15}, "deliveryCost": 0.99, "minimumDeliveryValue": 7.5,
    },
    {"id": 78, "name": "Night Noodles", "isDelivery": True, "isOpenNowForDelivery": False},
    {"id": 79, "name": "Paused Pies", "isDelivery": True, "isOpenNowForDelivery": True, "isTemporarilyOffline": True},
    {"id": 80, "name": "Pick-up Pasta", "isDelivery": False, "isOpenNowForDelivery": True},
    {"name": "No number", "isDelivery": None, "isOpenNowForDelivery": True, "isTemporarilyOffline": None},
]


def envelope(restaurants, job="j1", captured="2026-06-17T13:05:00+00:00", grocery_ids=("77", "80")):
    return {
        "snapshot_id": None, "job_id": job, "provider": "listing", "postcode": "ls42sw", "planned_window": "weekday_afternoon",
        "scheduled_at": "2026-06-17T13:00:00+00:00", "captured_at": captured, "source_url": "https://x.example",
        "response": {"filters": {"groceries": {"restaurantIds": list(grocery_ids)}}, "restaurants": restaurants},
    }


def raw(spark, *documents):
    df = spark.createDataFrame([(json.dumps(doc), f"raw/{at}") for at, doc in enumerate(documents)], "value string, raw_uri string")
    return readers.parse_envelopes(df, keep=("raw_uri",))


def test_only_the_open_delivery_outlet_stays(spark, rows):
    found = rows(listing.open_now(raw(spark, envelope(RESTAURANTS)), base_url="https://b.example"))
    assert len(found) == 1
    row = found[0]
    assert (row["ListingId"], row["Vertical"], row["DeliveryFee"], row["MinimumOrder"]) == ("77", "groceries", "£0.99", "£7.50")
    assert (row["DeliveryTime"], row["Url"]) == ("5-15 mins", "https://b.example/restaurants-corner-larder/menu")
    assert row["snapshot_id"] and row["job_id"] == "j1"


def test_without_grocery_ids_everything_is_a_restaurant(spark, rows):
    found = rows(listing.listing_rows(raw(spark, envelope(RESTAURANTS, grocery_ids=()))))
    assert {row["Vertical"] for row in found} == {"restaurants"} and len(found) == 5


def test_edges_of_the_listing_fields(spark, rows):
    odd = [
        {"id": 0, "uniqueName": "zero", "isDelivery": True, "isOpenNowForDelivery": True},
        {"id": "abc", "isDelivery": True, "isOpenNowForDelivery": True, "cuisines": [{"name": "B", "uniqueName": "b"}, {"name": "", "uniqueName": ""}, {"name": "A", "uniqueName": "a"}, {"name": "B", "uniqueName": "b"}],
         "deals": [{"description": "  "}, {"description": None}, {"description": " two  words "}], "deliveryEtaMinutes": {"approximate": 15}, "deliveryCost": "abc", "minimumDeliveryValue": 0},
    ]
    found = {row["ListingId"]: row for row in rows(listing.open_now(raw(spark, envelope(odd))))}
    assert found["0"]["Url"] is None
    row = found["abc"]
    assert (row["Categories"], row["CuisineIds"], row["Offer"], row["DeliveryTime"]) == ("B, A, B", "a, b", " two  words ", "15 mins")
    assert (row["DeliveryFee"], row["MinimumOrder"], row["Url"]) == ("abc", "Free", None)


def test_coverage_and_profiles(spark, rows):
    first = [
        {"id": "", "restaurantId": 7, "name": "Old", "isDelivery": True, "deliveryCost": "abc"},
        {"id": 0, "seoName": "by-seo", "name": "Seo"},
        {"name": "Nameless"},
        {"id": 8, "uniqueName": "eight", "address": {"firstLine": "1 St", "city": "Leeds", "postalCode": "LS1", "location": {"coordinates": [-1.5, 53.8]}}},
    ]
    second = [{"restaurantId": 7, "name": "New", "address": {"location": {"coordinates": [1.0]}}}]
    documents = raw(spark, envelope(first, "j1", "2026-06-17T10:00:00"), envelope(second, "j2", "2026-06-18T10:00:00"))
    coverage = rows(conform_to_schema(listing.coverage_rows(documents, "label"), COVERAGE), "restaurant_id")
    assert [row["restaurant_id"] for row in coverage] == ["7", "7", "8", "by-seo"]
    assert all(row["delivery_fee"] is None for row in coverage)
    profiles = {row["restaurant_id"]: row for row in rows(listing.profile_rows(documents))}
    assert profiles["7"]["restaurant_name"] == "New" and profiles["7"]["latitude"] is None
    assert (profiles["8"]["latitude"], profiles["8"]["longitude"], profiles["8"]["city"]) == (53.8, -1.5, "Leeds")
    known = spark.createDataFrame([("8",)], "restaurant_id string")
    assert {row["restaurant_id"] for row in rows(listing.new_profiles(listing.profile_rows(documents), known))} == {"7", "by-seo"}
    stats = rows(listing.backfill_stats(documents, known))[0]
    assert stats == {"map_rows": 4, "profiles_seen": 4, "profiles_unique": 3, "skipped_without_id": 1, "profiles_existing": 1, "profiles_new": 2}


def test_raw_files_round_trip(spark, tmp_path, rows):
    """Several documents in a file, one in each line, as the landing writer puts them."""
    folder = tmp_path / "files"
    folder.mkdir()
    for at in range(3):
        lines = "\n".join(json.dumps(envelope(RESTAURANTS, f"j{at}-{n}")) for n in range(4))
        (folder / f"{at}.json.gz").write_bytes(gzip.compress(lines.encode()))
    documents = readers.read_raw_listings(spark, str(folder))
    assert documents.count() == 12
    landed = str(tmp_path / "landed")
    writers.write_raw_landing(documents.coalesce(1), landed)
    back = readers.read_raw_listings(spark, landed)
    same = lambda df: rows(df.select("job_id", "captured_at", F.to_json(F.struct("response")).alias("text")), "job_id")
    assert same(back) == same(documents)
    assert (tmp_path / "landed" / "provider=listing" / "date=2026-06-17" / "window=weekday_afternoon").is_dir()
    assert readers.read_raw_rejects(spark, landed).count() == 0


def test_odd_documents_are_counted_and_the_rest_stays(spark, rows):
    odd = [{"address": "x"}, {"driveDistanceMeters": "far"}, {"isDelivery": [1]}, {"rating": {"count": {"n": 12}, "starRating": 4.0}}]
    documents = [envelope([{"id": at, "name": f"R{at}", **fields}], f"j{at}") for at, fields in enumerate(odd)]
    texts = [json.dumps(document) for document in documents] + ["{", "[1]", "", None, *json.dumps(envelope([]), indent=1).split("\n")[:2], json.dumps(envelope([{"id": 9}], "good"))]
    df = spark.createDataFrame([(text, f"raw/{at}") for at, text in enumerate(texts)], "value string, raw_uri string")
    parsed = readers.parse_envelopes(df, keep=("raw_uri",))
    assert {row["job_id"] for row in rows(parsed)} == {"j0", "j1", "j2", "j3", "good"}
    names = rows(listing.listing_rows(parsed), "ListingId")
    assert [row["Name"] for row in names] == ["R0", "R1", "R2", "R3", None]
    flaws = Counter(row["flaw"] for row in rows(readers.envelope_rejects(df, keep=("raw_uri",))))
    assert flaws == {"odd field": 3, "unreadable": 6}


def test_values_of_other_types_keep_what_they_say(spark, rows):
    flags = [(1, True), (0, False), ("yes", True), ("false", True), ("0", True), ("", False), ([], False), ([0], True), ({}, False), ({"a": 0}, True), (0.0, False), (2.5, True), (None, False)]
    outlets = [{"id": at, "isDelivery": flag, "isOpenNowForDelivery": True} for at, (flag, _) in enumerate(flags)]
    outlets += [{"id": 100 + at, "isDelivery": True, "isOpenNowForDelivery": 1, "isTemporarilyOffline": flag} for at, (flag, _) in enumerate(flags)]
    documents = raw(spark, envelope(outlets))
    found = {int(row["ListingId"]) for row in rows(listing.open_now(documents))}
    assert found == {at for at, (_, truth) in enumerate(flags) if truth} | {100 + at for at, (_, truth) in enumerate(flags) if not truth}
    coverage = {int(row["restaurant_id"]): row["is_delivery"] for row in rows(listing.coverage_rows(documents, "x")) if 0 < int(row["restaurant_id"]) < 100}
    assert coverage == {at: None if flag is None else truth for at, (flag, truth) in enumerate(flags) if at}


def test_numbers_as_text_and_with_decimals(spark, rows):
    odd = [
        {"id": 1, "driveDistanceMeters": 12.5, "rating": {"count": "12", "starRating": "4.5"}, "deliveryEtaMinutes": {"rangeLower": "5", "rangeUpper": 7.5}},
        {"id": 2, "driveDistanceMeters": "300", "rating": {"count": 12.0, "starRating": 4}, "address": {"location": {"coordinates": ["-1.5", 53]}}},
        {"id": 3, "driveDistanceMeters": "far", "rating": {"count": "many"}, "deliveryEtaMinutes": 5},
    ]
    documents = raw(spark, envelope(odd))
    coverage = rows(listing.coverage_rows(documents, "x"), "restaurant_id")
    assert [row["drive_distance_meters"] for row in coverage] == [12.5, 300.0, None]
    assert [row["drive_distance_meters"] for row in rows(conform_to_schema(listing.coverage_rows(documents, "x"), COVERAGE), "restaurant_id")] == [12, 300, None]
    assert [row["delivery_eta_upper_minutes"] for row in coverage] == [7.5, None, None]
    listed = rows(listing.listing_rows(documents), "ListingId")
    assert [(row["ReviewCount"], row["Rating"], row["DeliveryTime"]) for row in listed] == [(12, 4.5, "5-7.5 mins"), (12, 4.0, None), (None, None, None)]
    profiles = rows(listing.profile_rows(documents), "restaurant_id")
    assert (profiles[1]["latitude"], profiles[1]["longitude"]) == (53.0, -1.5)


@pytest.mark.parametrize("job", ["listing_rows", "open_now", "coverage_rows", "profile_rows", "backfill_stats"])
def test_a_document_is_parsed_once(spark, job):
    reads = {"listing_rows": listing.LISTING_READS, "open_now": listing.OPEN_READS, "coverage_rows": listing.COVERAGE_READS, "profile_rows": listing.PROFILE_READS, "backfill_stats": listing.KEY_READS}[job]
    df = spark.createDataFrame([(json.dumps(envelope(RESTAURANTS)), "raw/0")], "value string, raw_uri string").repartition(2)
    documents = readers.parse_envelopes(df, keep=("raw_uri",), reads=reads)
    known = spark.createDataFrame([("8",)], "restaurant_id string")
    extra = {"coverage_rows": ("label",), "backfill_stats": (known,)}.get(job, ())
    plan = getattr(listing, job)(documents, *extra)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "parse_json" not in plan


def test_shapes_are_cut_to_what_a_job_reads(spark):
    assert narrowed("a string, b array<struct<c:struct<d:int,e:int>,f:variant>>, g int", ["b.c.e", "b.f", "a"]) == "a string,b array<struct<c:struct<e:int>,f:variant>>"
    with pytest.raises(ValueError, match="zz"):
        narrowed("a struct<b:int>", ["a.zz"])


def test_last_seen_is_by_instant(spark, rows):
    early, late = "2026-06-17T13:30:00+01:00", "2026-06-17T13:05:00+00:00"
    documents = raw(spark, envelope([{"id": 1, "name": "late"}], "a", late), envelope([{"id": 1, "name": "early"}], "b", early))
    assert [row["restaurant_name"] for row in rows(listing.profile_rows(documents))] == ["late"]


def test_reparse_audit_finds_both_sides(spark, rows):
    parsed = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    stored = spark.createDataFrame([("a", 1), ("c", None)], "k string, v int")
    found = rows(listing.reparse_audit(parsed, stored), "k")
    assert [(row["k"], row["only_in"], row["copies"]) for row in found] == [("a", "reparsed", 1), ("b", "reparsed", 1), ("c", "stored", 1)]


def test_conform_adds_casts_and_checks(spark, rows):
    df = spark.createDataFrame([("s", "5", "x")], "snapshot_id string, Rating string, extra string")
    made = conform_to_schema(df, SNAPSHOTS, check_required=False)
    assert made.columns == SNAPSHOTS.fieldNames() + ["extra"] and rows(made)[0]["Rating"] == 5.0
    with pytest.raises(Exception, match="required field is NULL: job_id"):
        conform_to_schema(df, SNAPSHOTS).collect()
    checked = rows(missing_required(df, ["extra", "job_id", "provider"]))[0]
    assert checked["missing_fields"] == "job_id, provider"


def test_append_rows_by_day(spark, tmp_path, rows):
    path = str(tmp_path / "events")
    events = spark.sql("SELECT 'e' || id AS event_id, 'j' AS job_id, 'p' AS provider, 'x' AS postcode, 'w' AS planned_window, 'started' AS event_type, TIMESTAMP '2026-06-17 10:00:00' + make_interval(0,0,0,CAST(id AS INT)) AS event_time FROM range(3)")
    writers.append_rows(events, path, "job_events")
    writers.append_rows(events, path, "job_events")
    back = writers.read_table(spark, path, "job_events")
    assert back.count() == 6 and len(list((tmp_path / "events").glob("day=*"))) == 3
    assert back.columns == ["event_id", "job_id", "provider", "postcode", "planned_window", "event_type", "event_time", "message", "raw_uri", "processed_rows"]


def test_stored_tables_are_pruned_by_run_and_day(spark, tmp_path):
    path = str(tmp_path / "manifest")
    rows = spark.sql("SELECT 'j' || id AS job_id, CASE id % 3 WHEN 0 THEN '20260617' WHEN 1 THEN 'b/c' END AS run_id, 'p' AS provider, 'x' || id AS postcode, 'w' AS planned_window, TIMESTAMP '2026-06-17 10:00:00' + make_interval(0,0,0,CAST(id AS INT)) AS scheduled_at, TIMESTAMP '2026-06-01' AS created_at FROM range(9)")
    writers.append_rows(rows, path, "job_manifest")
    whole = writers.read_table(spark, path, "job_manifest")
    assert sorted((row.job_id, row.run_id) for row in whole.collect()) == sorted((row.job_id, row.run_id) for row in rows.collect())
    some = writers.read_table(spark, path, "job_manifest", runs=["b/c"], days=("2026-06-18", "2026-06-21"))
    assert sorted(row.job_id for row in some.collect()) == ["j1", "j4"]
    window, run = "w", planning.Run("b/c", "p", "2026-06-17T00:00:00+00:00")
    codes = spark.createDataFrame([(0, "x1"), (1, "zz")], "ordinal long, postcode string")
    jobs = planning.missing_jobs(codes, [window], whole, run)
    assert [row.postcode for row in jobs.collect()] == ["zz"]
    for frame in (some, jobs, planning.skipped_counts(codes, [window], whole, run), planning.new_manifest_rows(rows, whole, "b/c")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
        assert scans and all("PartitionFilters: [" in line and "run_id" in line.split("PartitionFilters: [")[1].split("]")[0] for line in scans)


def test_postcodes_from_csv(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_bytes("﻿name,postcode\nx,AA1 1AA\ny,\nz, bb2 2BB \nw,AA1 1AA\n".encode())
    found = [(row.ordinal, row.postcode) for row in readers.read_postcodes(spark, str(path)).orderBy("ordinal").collect()]
    assert found == [(0, "aa11aa"), (1, "bb22bb"), (2, "aa11aa")]
    assert readers.read_postcodes(spark, str(path), limit=2).count() == 2
    (tmp_path / "q.csv").write_text("code\nx\n")
    with pytest.raises(ValueError, match="postcode"):
        readers.read_postcodes(spark, str(tmp_path / "q.csv"))


def test_storage_addresses():
    assert readers.split_uri("gs://bucket/a/b.json.gz", "gs") == ("bucket", "a/b.json.gz")
    for bad in ("s3://bucket/a", "gs://bucket", "gs:///a", "plain"):
        with pytest.raises(ValueError):
            readers.split_uri(bad, "gs")


def test_succeeded_uris(spark, rows):
    events = spark.createDataFrame([("succeeded", "b", 2), ("succeeded", "a", 1), ("succeeded", None, 0), ("failed", "c", 0)], "event_type string, raw_uri string, event_time int")
    assert {row["raw_uri"] for row in rows(readers.succeeded_uris(events))} == {"a", "b"}
    assert [row["raw_uri"] for row in rows(readers.succeeded_uris(events, 1))] == ["a"]
