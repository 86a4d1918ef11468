"""Shaping of listing rows: flags are looked at once, and lists are joined without a function for each member."""

import contextlib
import io
import json

import pytest
from pyspark.sql import functions as F

from catchment.functions.loose import json_flag, json_truth
from catchment.functions.text import clean_text, is_blank, join_distinct_sorted, join_present
from catchment.operators import listing
from catchment.sources import readers

NOTHING = ["false", "null", "0", "-0", "0.0", "-0.00", "0e5", "0E-3", "0.000e+7", '""', "[]", "{}", " [ ] ", "{ }", "1e-400"]
SOMETHING = ["true", "1", "-1", "0.5", "0.000000000001", "1e-9", "10", "1e400", '"0"', '"false"', '"null"', '"[]"', '"{}"', '" "', '"\\n"', '"0\\n"', '"-0.0"', "[0]", '[""]', "[null]", '{"a": null}', "12345678901234567890123"]


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as shown:
        df.explain()
    return shown.getvalue()


def test_flags_of_all_kinds(spark):
    rows = [(text, text in SOMETHING, json.loads(text) is None) for text in NOTHING + SOMETHING] + [(None, False, True)]
    values = spark.createDataFrame(rows, "text string, wanted boolean, none boolean").withColumn("value", F.parse_json("text"))
    found = values.select("text", "wanted", "none", json_truth(F.col("value")).alias("truth"), json_flag(F.col("value")).alias("flag")).collect()
    assert [(row["text"], row["truth"]) for row in found] == [(text, wanted) for text, wanted, _ in rows]
    assert [row["flag"] for row in found] == [None if none else wanted for _, wanted, none in rows]


def test_open_rows_look_at_each_flag_once(spark):
    outlets = [{"id": 1, "isDelivery": True, "isOpenNowForDelivery": 1, "isTemporarilyOffline": []}, {"id": 2, "isDelivery": "", "isOpenNowForDelivery": True}, {"id": 3, "isDelivery": True, "isOpenNowForDelivery": True, "isTemporarilyOffline": "no"}]
    raw = spark.createDataFrame([(json.dumps({"snapshot_id": "s", "response": {"restaurants": outlets}}),)], "value string")
    rows = listing.open_now(readers.parse_envelopes(raw, reads=listing.OPEN_READS))
    assert [row["ListingId"] for row in rows.collect()] == ["1"]
    shown = plan(rows)
    assert "variant_get" not in shown and sum(line.count("RLIKE") for line in shown.splitlines() if " Filter " in line) == 3


LISTS = [None, [], [None], [""], ["b", "", None, "a", "b"], ["", "é", "a", "B", "a"], [" ", "x"], ["z", None, "z"]]


@pytest.mark.parametrize(("join", "wanted"), [(join_present, [None, None, None, None, "b, a, b", "é, a, B, a", " , x", "z, z"]), (join_distinct_sorted, [None, None, None, None, "a, b", "B, a, é", " , x", "z"])])
def test_lists_are_joined_without_functions(spark, join, wanted):
    rows = spark.createDataFrame([(at, items) for at, items in enumerate(LISTS)], "at int, items array<string>").select("at", join(F.col("items")).alias("text"))
    assert [row["text"] for row in rows.orderBy("at").collect()] == wanted
    assert "lambda" not in plan(rows)


def test_blank_is_what_cleaning_leaves_nothing_of(spark):
    texts = ["", " ", "\t\n", " ", " \u0085", "\x1c\x1f", "​", " x", " y ", "\x00", "0", None]
    rows = spark.createDataFrame([(text,) for text in texts], "text string").select("text", is_blank(F.col("text")).alias("blank"), (clean_text(F.col("text")) == "").alias("wanted")).collect()
    assert [(row["text"], row["blank"]) for row in rows] == [(row["text"], row["wanted"]) for row in rows]
