import json

from pyspark.sql import functions as F

from catchment.operators import jobs

MANIFEST = "job_id string, run_id string, provider string, postcode string, planned_window string, scheduled_at string, created_at int, max_attempts bigint"
EVENTS = "event_id string, job_id string, event_type string, event_time int, raw_uri string, processed_rows bigint"
TASKS = "job_id string, run_id string, provider string, postcode string, planned_window string, scheduled_at string, window_end_at string, limiter_key string"


def manifest(spark, *rows):
    return spark.createDataFrame(list(rows), MANIFEST)


def events(spark, *rows):
    return spark.createDataFrame([(str(at), *row, None, None) for at, row in enumerate(rows)], EVENTS)


def base(job="j", **changes):
    row = {"job_id": job, "run_id": "r", "provider": "p", "postcode": "LS4 2SW", "planned_window": "w", "scheduled_at": "2026-06-17", "window_end_at": None, "limiter_key": "k"}
    return tuple({**row, **changes}.values())


def test_newest_manifest_row_and_default_attempts(spark, rows):
    df = manifest(spark, ("j", "old", "p", "x", "w", "t", 1, 9), ("j", "new", "p", "x", "w", "t", 2, None))
    assert rows(jobs.latest_manifest(df)) == [{"job_id": "j", "run_id": "new", "provider": "p", "postcode": "x", "planned_window": "w", "scheduled_at": "t", "max_attempts": 3}]


def test_success_is_final_and_attempts_count_starts(spark, rows):
    df = events(spark, ("a", "started", 1), ("a", "succeeded", 2), ("a", "failed", 3), ("b", "deferred", 1), ("b", "started", 2), ("b", "failed", 3), ("c", "expired_window", 1))
    found = {row["job_id"]: (row["status"], row["attempts"]) for row in rows(jobs.job_status(df))}
    assert found == {"a": ("succeeded", 1), "b": ("failed", 1), "c": ("expired_window", 0)}
    assert {row["job_id"]: row["attempts"] for row in rows(jobs.job_attempts(df))} == {"a": 1, "b": 1}


def test_admission_rules_in_order(spark, rows):
    known = [(job, "r", "p", "ls42sw", "w", "t", 1, 3) for job in ("ok", "won", "tired", "late", "held", "changed")] + [("none", None, "p", "ls42sw", "w", "t", 1, 3)]
    log = [("won", "succeeded", 1), ("won", "failed", 2)] + [("tired", "started", at) for at in range(3)] + [("late", "started", 1)] * 2
    tasks = spark.createDataFrame(
        [
            base("ok"), base("won"), base("tired"), base("late", window_end_at="2026-06-17 12:00:00"), base("held", limiter_key="banned"),
            base("changed", planned_window="other", postcode="zz"), base("absent"), base("ok", run_id=None), base("ok", window_end_at="2026-06-17 12:00:01"),
            base("none", run_id="None"),
        ],
        TASKS,
    ).withColumn("window_end_at", F.col("window_end_at").cast("timestamp"))
    bans = spark.sql("SELECT 'banned' AS limiter_key, TIMESTAMP '2026-06-17 12:30:00' AS ban_until")
    found = rows(jobs.admission(tasks, manifest(spark, *known), events(spark, *log), bans, F.lit("2026-06-17 12:00:00").cast("timestamp")))
    got = sorted((row["job_id"], str(row["run_id"]), row["decision"], row["status_code"]) for row in found)
    assert got == sorted(
        [
            ("ok", "r", "run", 200), ("won", "r", "already_succeeded", 200), ("tired", "r", "max_attempts_reached", 200), ("late", "r", "window_expired", 200),
            ("held", "r", "deferred", 503), ("changed", "r", "rejected", 409), ("absent", "r", "rejected", 404), ("ok", "None", "missing_fields", 400), ("ok", "r", "run", 200),
            ("none", "None", "run", 200),
        ]
    )
    assert {row["message"] for row in found if row["status_code"] == 409} == {"Task payload does not match job_manifest: postcode, planned_window"}


BODY = {
    "RestaurantId": 1001, "Menus": [{"Id": "m"}],
    "RestaurantInfo": {
        "Name": "Example", "TimeZone": "Europe/London", "IsOffline": False,
        "RestaurantOpeningTimes": [
            {
                "ServiceType": "Delivery",
                "TimesPerDay": [
                    {"DayOfWeek": "Monday", "Times": [{"FromLocalTime": "11:00", "ToLocalTime": "14:00"}, {"FromLocalTime": "17:00", "ToLocalTime": "22:00"}]},
                    {"DayOfWeek": "Friday", "Times": [{"FromLocalTime": "23:00", "ToLocalTime": "02:00"}]},
                    {"DayOfWeek": "Sunday"},
                ],
            }
        ],
    },
}


def menu_inputs(spark):
    tasks = spark.createDataFrame([(task, "r", "1001", "Example", " example ", None, None) for task in ("t1", "t2", "t3")], "task_id string, run_id string, restaurant_id string, restaurant_name string, restaurant_unique_name string, restaurant_url string, cuisine_names string")
    log = [
        ("t1", 1, "original", "u1", 200, 10, 1, json.dumps(BODY)),
        ("t2", 1, "original", "u1", 404, 10, 1, None), ("t2", 2, "v2_2", "u2", 200, 20, 2, json.dumps({"RestaurantInfo": None})),
        ("t3", 1, "original", "u1", None, None, 1, None), ("t3", 2, "v2_2", "u2", 500, 30, 2, None),
    ]
    return tasks, spark.createDataFrame(log, "task_id string, attempt int, source string, url string, status bigint, latency_ms bigint, finished_at int, body string")


def test_manifest_choice_and_counts(spark, rows):
    tasks, log = menu_inputs(spark)
    found = {row["task_id"]: row for row in rows(jobs.manifest_results(tasks, jobs.manifest_attempts(log)))}
    first = found["t1"]
    assert (first["opening_time_count"], first["opening_service_types"], first["menu_count"], first["fallback_used"], first["outcome"]) == (3, "Delivery", 1, False, "succeeded")
    assert first["restaurant_unique_name"] == "example" and first["is_offline"] is False
    second = found["t2"]
    assert (second["manifest_source"], second["fallback_used"], second["opening_time_count"], second["opening_service_types"], second["menu_count"]) == ("v2_2", True, 0, None, 0)
    third = found["t3"]
    assert (third["outcome"], third["fallback_used"], third["http_status"], third["manifest_source"], third["menu_count"]) == ("failed", True, 500, None, 0)
    assert third["error"] == "Menu manifest returned HTTP 500: u2 | attempts=original:error; v2_2:500"


def test_opening_times(spark, rows):
    tasks, log = menu_inputs(spark)
    chosen = jobs.manifest_attempts(log).filter("outcome = 'succeeded'")
    found = rows(jobs.opening_times(tasks, chosen), "day_of_week", "interval_index")
    assert [(row["day_of_week"], row["interval_index"], row["crosses_midnight"]) for row in found] == [("Friday", 1, True), ("Monday", 1, False), ("Monday", 2, False)]
    assert len({row["opening_time_id"] for row in found}) == 3
    assert rows(jobs.opening_times(tasks, chosen), "opening_time_id") == sorted(found, key=lambda row: row["opening_time_id"])


def test_pending_and_availability(spark, rows):
    tasks, _ = menu_inputs(spark)
    results = spark.createDataFrame([("t1", "succeeded"), ("t2", "failed")], "task_id string, outcome string")
    assert {row["task_id"] for row in rows(jobs.menu_pending(tasks, results))} == {"t2", "t3"}
    log = spark.createDataFrame([("s", "manifest", 404, 1), ("s", "manifest", 200, 2), ("s", "items", 404, 1)], "slug string, label string, status int, finished_at int")
    assert rows(jobs.fetch_availability(log)) == [{"slug": "s", "manifest": 200, "manifest_v2_2": None, "items": 404, "item_details": None}]
