import re
import uuid

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catchment.functions import clock, ids, text


def one(spark, values, build):
    """Values through a column builder, in order."""
    df = spark.createDataFrame(list(enumerate(values)), "i int, x string").coalesce(1)
    return [row.y for row in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]


SPACES = ["LS4 2SW", " ls4 2sw\t", "a\u0085b", "a\u001cb\u001fc", "", "  ", "MiXeD Case", None]


def test_clean_postcode_removes_every_kind_of_space(spark):
    expected = [None if value is None else re.sub(r"\s+", "", value).lower() for value in SPACES]
    assert one(spark, SPACES, text.clean_postcode) == expected


def test_clean_text_collapses_spaces(spark):
    expected = [None if value is None else re.sub(r"\s+", " ", value).strip() for value in SPACES]
    assert one(spark, SPACES, text.clean_text) == expected


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aBz \t\n  \u0085\u001c9-", max_size=12), min_size=1, max_size=60))
def test_cleaning_matches_python(spark, values):
    assert one(spark, values, text.clean_postcode) == [re.sub(r"\s+", "", value).lower() for value in values]
    assert one(spark, values, text.clean_text) == [re.sub(r"\s+", " ", value).strip() for value in values]


def test_money(spark):
    values = ["0", "-1", "1.5", "10", " ask  us ", None, "2.99"]
    assert one(spark, values, text.format_money) == ["Free", "Free", "£1.50", "£10.00", "ask us", None, "£2.99"]


def test_partition_labels(spark):
    values = [None, "weekday evening", "__a__", "///", "a-b_c.d", "é"]
    assert one(spark, values, text.partition_label) == ["null", "weekday_evening", "a", "empty", "a-b_c.d", "empty"]


def test_ratings_and_places(spark):
    labels = ["4.5 stars from 1,234 reviews", "1 star from 1 review", "none", None]
    stars, count = (lambda x: text.parse_rating(x)[0]), (lambda x: text.parse_rating(x)[1])
    assert one(spark, labels, stars) == [4.5, 1.0, None, None]
    assert one(spark, labels, count) == [1234, 1, None, None]
    assert one(spark, ["Open: 1,234 Places", "x"], text.parse_place_count) == [1234, None]


def test_verticals(spark):
    values = ["grocery, Restaurants", "", "groceries groceries"]
    got = one(spark, values, text.parse_verticals)
    assert got == [["groceries", "restaurants"], ["restaurants", "groceries"], ["groceries", "groceries"]]


def test_unknown_vertical_raises(spark):
    try:
        one(spark, ["florists"], text.parse_verticals)
    except Exception as problem:  # noqa: BLE001
        assert "Unsupported vertical: florists" in str(problem)
    else:
        raise AssertionError("expected an error")


def test_url_parts(spark):
    urls = ["https://a.example:8080/x/y?one=1&blank=&two=a%20b&flag#z", "http://b.example", "not a url"]
    assert one(spark, urls, text.url_host) == ["a.example:8080", "b.example", ""]
    assert one(spark, urls, text.url_path) == ["/x/y", "", ""]
    assert one(spark, urls, text.url_query_keys) == ["one,two", "", ""]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(min_size=0, max_size=30), min_size=1, max_size=60))
def test_uuid5_matches_the_standard(spark, keys):
    keys = [key for key in keys if not any(0xD800 <= ord(mark) < 0xE000 for mark in key)]
    assert one(spark, keys, ids.uuid5) == [str(uuid.uuid5(uuid.NAMESPACE_URL, key)) for key in keys]


def test_job_id_is_stable_and_window_specific(spark):
    df = spark.createDataFrame([("weekday_evening",), ("weekday_morning",)], "w string")
    made = [row.y for row in df.select(ids.job_id(F.lit("run-1"), F.lit("listing"), F.col("w"), F.lit("ls42sw")).alias("y")).collect()]
    assert made[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "run-1|listing|weekday_evening|ls42sw"))
    assert made[0] != made[1]


def test_crosses_midnight(spark):
    df = spark.createDataFrame([("23:00", "02:00"), ("10:00", "10:00"), ("09:00", "17:00"), (None, "1"), ("", "02:00")], "o string, c string").coalesce(1)
    assert [row.y for row in df.select(clock.crosses_midnight(F.col("o"), F.col("c")).alias("y")).collect()] == [True, True, False, None, None]


def test_local_time_to_utc(spark):
    values = [
        "2026-06-17T14:00:00",  # summer
        "2026-01-17T14:00:00",  # winter
        "2026-10-25T01:30:00",  # repeated hour: the earlier reading
        "2026-06-17T14:00:00+02:00",  # an offset is converted
        "2026-06-17T14:00:00Z",
    ]
    got = one(spark, values, lambda x: F.date_format(clock.to_utc(clock.wall_time(x)), "yyyy-MM-dd HH:mm"))
    assert got == ["2026-06-17 13:00", "2026-01-17 14:00", "2026-10-25 00:30", "2026-06-17 12:00", "2026-06-17 14:00"]


def test_window_expiry_is_at_the_exact_end(spark):
    df = spark.createDataFrame([("2026-06-17 17:00:00",), (None,)], "e string").select(F.col("e").cast("timestamp").alias("e")).coalesce(1)
    for now, expected in (("2026-06-17 16:59:00", [False, False]), ("2026-06-17 17:00:00", [True, False])):
        got = df.select(clock.window_expired(F.col("e"), F.lit(now).cast("timestamp")).alias("y")).collect()
        assert [row.y for row in got] == expected
