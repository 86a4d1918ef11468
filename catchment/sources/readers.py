"""Readers: postcode lists, geography lookups, window settings, raw listings."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catchment.functions.clock import wall_text, wall_time
from catchment.functions.loose import is_odd_number
from catchment.functions.text import clean_postcode
from catchment.operators.ordered import global_ordinal
from catchment.sources.schemas import ENVELOPE, narrowed

INPUT_ORDER = ("source_file", "source_offset", "source_row")


def with_input_order(df: DataFrame) -> DataFrame:
    """Columns that sort the rows of a file scan as they stand in the files."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("source_offset"),
        F.monotonically_increasing_id().alias("source_row"),
    )


def postcode_rows(df: DataFrame) -> DataFrame:
    """Drop empty cells, then clean; a blank but non-empty cell survives as ''."""
    if "postcode" not in df.columns:
        raise ValueError("Input must contain a 'postcode' column.")
    kept = df.filter(F.col("postcode").isNotNull() & (F.col("postcode") != ""))
    return kept.withColumn("postcode", clean_postcode(F.col("postcode")))


def read_postcodes(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Postcodes of a CSV in file order, as (ordinal, postcode); duplicates stay."""
    raw = spark.read.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = global_ordinal(postcode_rows(with_input_order(raw)), F.struct("source_file", "source_offset"), list(INPUT_ORDER))
    if limit:
        rows = rows.filter(F.col("ordinal") < limit)
    return rows.select("ordinal", "postcode")


def combine_postcodes(*frames: DataFrame) -> DataFrame:
    """Distinct clean postcodes of several lists; sort at the sink."""
    lists = [df.select("postcode").filter(F.col("postcode").isNotNull()) for df in frames]
    combined = lists[0]
    for other in lists[1:]:
        combined = combined.unionByName(other)
    return combined.select(clean_postcode(F.col("postcode")).alias("postcode")).distinct()


def read_geography(
    england_wales: DataFrame,
    scotland: DataFrame,
    england_wales_columns: tuple[str, str] = ("LSOA21CD", "POSTCODE"),
    scotland_columns: tuple[str, str] = ("DZCode", "Postcode"),
) -> DataFrame:
    """(postcode, geo_code, geo_type); a postcode with several areas keeps them all."""
    parts = []
    for df, (code, postcode), kind in (
        (england_wales, england_wales_columns, "lsoa"),
        (scotland, scotland_columns, "dz"),
    ):
        parts.append(
            df.select(
                F.col(postcode).cast("string").alias("postcode"),
                F.col(code).cast("string").alias("geo_code"),
                F.lit(kind).alias("geo_type"),
            )
        )
    both = parts[0].unionByName(parts[1]).dropna(subset=["postcode", "geo_code"])
    return both.withColumn("postcode", clean_postcode(F.col("postcode"))).distinct()


def interval_rows(df: DataFrame) -> DataFrame:
    """Check and normalise (tag, ordinal, local_start, local_end) interval texts to local ISO time."""
    start, end = wall_time(F.col("local_start")), wall_time(F.col("local_end"))
    checked = F.when(
        end <= start, F.raise_error(F.concat(F.lit("interval must end after it starts: "), F.col("tag"))).cast("string")
    )
    return df.select(
        "tag",
        F.col("ordinal").cast("int").alias("ordinal"),
        F.coalesce(checked, wall_text(start)).alias("local_start"),
        wall_text(end).alias("local_end"),
    )


def window_config_rows(payload: DataFrame, tags: Iterable[str] | None = None) -> DataFrame:
    """Interval rows out of `payload`, a column of JSON objects tag -> [[local_start, local_end], ...]."""
    parsed = payload.select(
        F.when(~F.ltrim("payload").startswith("{"), F.raise_error(F.lit("window intervals must be a JSON object")).cast("string"))
        .otherwise(F.col("payload"))
        .alias("payload")
    ).select(F.from_json("payload", "map<string,array<array<string>>>", {"mode": "FAILFAST"}).alias("config"))
    if tags is None:
        wanted = parsed.select(F.explode("config").alias("tag", "intervals"))
    else:
        names = F.array(*[F.lit(tag) for tag in tags])
        wanted = parsed.select(F.explode(names).alias("tag"), "config").select(
            "tag", F.try_element_at("config", F.col("tag")).alias("intervals")
        )
    complete = F.when(
        F.col("intervals").isNull() | (F.size("intervals") == 0),
        F.raise_error(F.concat(F.lit("no intervals configured for window: "), F.col("tag"))).cast("array<array<string>>"),
    ).otherwise(F.col("intervals"))
    rows = wanted.select("tag", F.posexplode(complete).alias("ordinal", "pair"))
    bad = F.col("pair").isNull() | (F.size("pair") != 2) | F.exists("pair", lambda side: side.isNull() | (side == ""))
    pair = F.when(
        bad, F.raise_error(F.lit("each interval must be [local_start, local_end]")).cast("array<string>")
    ).otherwise(F.col("pair"))
    return interval_rows(
        rows.select("tag", "ordinal", F.get(pair, 0).alias("local_start"), F.get(pair, 1).alias("local_end"))
    )


def read_window_config(spark: SparkSession, path_or_json: str | dict, tags: Iterable[str] | None = None) -> DataFrame:
    if isinstance(path_or_json, dict):
        path_or_json = json.dumps(path_or_json)
    if path_or_json.lstrip().startswith(("{", "[")):
        payload = spark.createDataFrame([(path_or_json,)], "payload string")
    else:
        payload = spark.read.text(path_or_json, wholetext=True).toDF("payload")
    return window_config_rows(payload, tags)


def _opened_envelopes(raw: DataFrame, text: str, keep: tuple[str, ...], schema: str) -> tuple[DataFrame, Column]:
    """The kept columns, the text and its envelope, and whether a row's envelope was read.

    The text is parsed once: a generator hands the envelope on, and no filter on it can be moved below a generator. A
    text that is no JSON object has no envelope, or one with nothing but the text that couldn't be read.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    object_text = F.when(F.ltrim(F.col(text)).startswith("{"), F.col(text))
    parsed = F.from_json(object_text, f"{schema}, _corrupt string", options)
    names = T.StructType.fromDDL(schema).fieldNames()
    opened = raw.select(*keep, F.col(text).alias("_text"), F.explode_outer(F.array(parsed)).alias("envelope"))
    something = reduce(or_, [F.col(f"envelope.{name}").isNotNull() for name in names])
    return opened, F.col("envelope").isNotNull() & (F.col("envelope._corrupt").isNull() | something)


def parse_envelopes(raw: DataFrame, text: str = "value", keep: tuple[str, ...] = (), schema: str = ENVELOPE, reads: Iterable[str] | None = None) -> DataFrame:
    """Envelope columns out of JSON text; `reads` names the fields of the schema that are wanted, by dotted path.

    Numbers stay text and flags stay Variant, as `functions/loose.py` types them. A field of another shape than expected
    is NULL and the rest of the document stays; a text that is no JSON object is left out. `envelope_rejects` gives both.
    """
    schema = schema if reads is None else narrowed(schema, reads)
    opened, readable = _opened_envelopes(raw, text, keep, schema)
    return opened.filter(readable).select(*keep, "envelope.*").drop("_corrupt")


def odd_numbers(restaurant: Column) -> Column:
    """Whether a number of an outlet can't be read as one."""
    eta, place = restaurant["deliveryEtaMinutes"], restaurant["address"]["location"]["coordinates"]
    single = [restaurant["rating"]["starRating"], restaurant["rating"]["count"], eta["rangeLower"], eta["rangeUpper"], restaurant["driveDistanceMeters"]]
    found = F.coalesce(F.exists(place, is_odd_number), F.lit(False))
    for text in single:
        found = found | is_odd_number(text)
    return found


def envelope_rejects(raw: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Texts that couldn't be read, or not in full: the kept columns, `flaw` and the text.

    "unreadable" is no JSON object; "odd field" holds a field of another shape than expected, or a number that is none.
    """
    opened, readable = _opened_envelopes(raw, text, keep, ENVELOPE)
    odd = F.col("envelope._corrupt").isNotNull() | F.coalesce(F.exists("envelope.response.restaurants", odd_numbers), F.lit(False))
    flawed = opened.withColumn("flaw", F.when(~readable, "unreadable").when(odd, "odd field"))
    return flawed.filter(F.col("flaw").isNotNull()).select(*keep, "flaw", F.col("_text").alias(text))


def raw_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON text with its file path as `raw_uri`: each line is one document, as the landing writer puts them."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("raw_uri"))


def read_raw_listings(spark: SparkSession, path: str | list[str], reads: Iterable[str] | None = None) -> DataFrame:
    """Raw gzip envelopes; `captured_at` and `scheduled_at` stay ISO text."""
    return parse_envelopes(raw_lines(spark, path), keep=("raw_uri",), reads=reads)


def read_raw_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(raw_uri, flaw, value) of the documents that `read_raw_listings` leaves out or reads in part."""
    return envelope_rejects(raw_lines(spark, path), keep=("raw_uri",))


def split_uri(uri: str, scheme: str) -> tuple[str, str]:
    """Bucket and object of a storage address of the given scheme."""
    head, found, rest = uri.partition("://")
    bucket, _, name = rest.partition("/")
    if not found or head != scheme or not bucket or not name:
        raise ValueError(f"raw URI must look like {scheme}://bucket/path, got: {uri}")
    return bucket, name


def succeeded_uris(events: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw addresses of succeeded jobs by event time; with a limit, the first ones."""
    rows = events.filter((F.col("event_type") == "succeeded") & F.col("raw_uri").isNotNull())
    rows = rows.select("raw_uri", "event_time")
    return rows.orderBy("event_time", "raw_uri").limit(limit) if limit else rows
