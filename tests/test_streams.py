"""Each stream against its batch job on the same data."""

import gzip
import json
import os
import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_listing import RESTAURANTS, envelope

from catchment.operators import audit, listing
from catchment.sources import readers
from catchment.streaming import streams


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def to_memory(frame, name, mode="append"):
    drain(frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start())
    return frame.sparkSession.table(name)


def test_landing_files_to_snapshots(spark, tmp_path, rows):
    folder = tmp_path / "raw"
    folder.mkdir()

    def land(at):
        (folder / f"{at}.json.gz").write_bytes(gzip.compress(json.dumps(envelope(RESTAURANTS, f"j{at}")).encode()))

    land(0), land(1)
    args = (str(folder), str(tmp_path / "out"), str(tmp_path / "check"))
    drain(streams.stream_snapshots(spark, *args))
    land(2)
    drain(streams.stream_snapshots(spark, *args))
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert rows(stored, "job_id") == rows(listing.open_now(readers.read_raw_listings(spark, str(folder))), "job_id")


@pytest.fixture
def events(spark, tmp_path):
    base = datetime(2026, 6, 17, 12)
    data = [(f"e{at}", f"j{at % 5}", ["started", "failed", "succeeded", "started"][at % 4], base + timedelta(seconds=17 * at), [200, 429, 503, 403][at % 4], at % 3) for at in range(60)]
    df = spark.createDataFrame(data, "event_id string, job_id string, event_type string, event_time timestamp, http_status bigint, k int")
    df = df.withColumns({"start_ms": F.unix_millis("event_time"), "finish_ms": F.unix_millis("event_time") + 900, "diagnostic_id": F.col("event_id"), "limiter_key": F.col("k").cast("string")})
    path = str(tmp_path / "events")
    df.repartitionByRange(3, "event_time").sortWithinPartitions("event_time").write.parquet(path)
    # The file source takes files by age.
    for age, name in enumerate(sorted(Path(path).glob("*.parquet"))):
        os.utime(name, (1_700_000_000 + age, 1_700_000_000 + age))
    return spark.read.parquet(path), spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def land(df, path, number, order):
    """Rows as `number` files that the file source takes in that order."""
    df.repartitionByRange(number, order).sortWithinPartitions(order).write.parquet(path)
    for age, name in enumerate(sorted(Path(path).glob("*.parquet"))):
        os.utime(name, (1_700_000_000 + age, 1_700_000_000 + age))
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_attempts_have_a_cap_and_count_an_event_once(spark, tmp_path, rows):
    kinds = ["started", "failed", "started", "succeeded", "started"]
    data = [(f"e{at % 97}", f"j{at % 97 % 9}", kinds[(at % 97) // 9 % 5], at) for at in range(300)]
    data += [(f"m{at % 40}", "many", "started", at) for at in range(400)] + [("x", None, "started", 7)]
    random.Random(4).shuffle(data)
    df = spark.createDataFrame([(*row, at) for at, row in enumerate(data)], "event_id string, job_id string, event_type string, at int, arrival int")
    df = df.withColumn("event_time", F.timestamp_seconds(F.col("at") * 60))
    stream = land(df, str(tmp_path / "in"), 4, "arrival")
    changes = []

    def keep(batch, number):
        changes.extend((number, row.asDict()) for row in batch.collect())

    for _ in range(2):  # the second run starts from the checkpoint and has nothing new to tell
        query = streams.stream_attempts(stream).writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", str(tmp_path / "check"))
        drain(query.trigger(availableNow=True).start())
    last = {row["job_id"]: row for _, row in changes}
    want = {row["job_id"]: row for row in rows(streams.running_attempts(df.filter("job_id IS NOT NULL")))}
    assert last == want and {row["state"] for row in want.values()} >= {"succeeded", "exhausted"}
    assert len({number for number, _ in changes}) > 1 and len(changes) < len(want) * 4


def test_a_job_is_forgotten_after_a_while(spark, tmp_path):
    data = [("a", "j", "started", 0, 1), ("b", "k", "started", 40, 2), ("c", "k", "started", 80, 3), ("a", "j", "started", 0, 4)]
    df = spark.createDataFrame(data, "event_id string, job_id string, event_type string, day int, arrival int").withColumn("event_time", F.timestamp_seconds(F.col("day") * 86_400))
    told = to_memory(streams.stream_attempts(land(df, str(tmp_path / "in"), 4, "arrival")), "forgotten", "update")
    assert sorted((row.job_id, row.attempts) for row in told.collect()) == [("j", 1), ("j", 1), ("k", 1), ("k", 2)]


def test_outcome_windows(events, rows):
    batch, stream = events
    closed = to_memory(streams.stream_outcomes(stream, delay="0 seconds"), "outcomes")
    found, expected = rows(closed, "window_start", "status_class"), rows(streams.outcome_windows(batch), "window_start", "status_class")
    # The stream keeps back the windows that its watermark has not passed.
    last = max(row["window_start"] for row in expected)
    assert found == [row for row in expected if row["window_start"] < last]


def test_one_result_per_job(spark, events, tmp_path):
    batch, stream = events
    done = "event_type = 'succeeded'"
    kept = to_memory(streams.stream_dedupe(stream.filter(done), time="event_time"), "deduped")
    jobs_of = lambda df: sorted(row.job_id for row in df.collect())
    assert jobs_of(kept) == jobs_of(streams.one_result(batch.filter(done), "event_time", "event_id"))
    # One job over and over: few of its rows reach the second step.
    hot = batch.limit(1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5000)))).withColumn("event_id", F.concat("event_id", F.col("copy").cast("string"))).drop("copy")
    query = streams.stream_dedupe(land(hot, str(tmp_path / "hot"), 2, "event_id"), time="event_time").writeStream.format("memory").queryName("hot")
    query = query.trigger(availableNow=True).start()
    drain(query)
    assert spark.table("hot").count() == 1
    reached = [operator["numRowsUpdated"] for progress in query.recentProgress for operator in progress["stateOperators"]]
    assert sum(reached) <= 1 + 16


def test_late_split(spark, events, tmp_path, rows):
    batch, stream = events
    end = F.when(F.col("k") != 0, F.lit("2026-06-17 12:05:00").cast("timestamp"))
    args = [str(tmp_path / name) for name in ("good", "late", "check")]
    drain(streams.stream_late_split(stream.withColumn("window_end_at", end), *args, arrival="event_time"))
    flagged = streams.late_flag(batch.withColumn("window_end_at", end), "event_time")
    for path, expired in ((args[0], False), (args[1], True)):
        found = spark.read.parquet(path).drop("batch_id")
        assert rows(found, "event_id") == rows(flagged.filter(F.col("is_expired") == expired).drop("is_expired"), "event_id")


def circuit_data(spark, number=400):
    rng = random.Random(11)
    data = []
    for at in range(number):
        start = 1_750_000_000_000 + rng.randrange(0, 40_000_000)
        status = 429 if rng.random() < 0.04 else rng.choice([200, 200, 503, None])
        data.append((f"d{at}", rng.choice(["hot", "hot", "hot", "k1", None]), start, start + rng.randrange(0, 5000), status))
    data += [("null", "hot", None, 1_750_000_000_000, 429), ("again", "k1", 1_750_000_001_000, 1_750_000_001_000, 200), ("again", "k1", 1_750_000_001_000, 1_750_000_001_000, 200)]
    # Rows come up to 25 minutes out of order; the last one lets the watermark pass all others.
    data = [(*row, (row[2] or 1_750_000_000_000) + rng.randrange(0, 1_500_000)) for row in data] + [("last", "other", 1_760_000_000_000, 1_760_000_000_000, 200, 1_760_000_000_000)]
    return spark.createDataFrame(data, "diagnostic_id string, limiter_key string, start_ms long, finish_ms long, http_status long, arrival long")


def test_circuit_out_of_order_and_after_a_restart(spark, tmp_path, rows):
    df = circuit_data(spark)
    first, second = df.filter("arrival < 1750020000000"), df.filter("arrival >= 1750020000000")
    folder, out, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    folder.mkdir()
    for at, part in enumerate((first, second)):
        part.repartitionByRange(3, "arrival").write.parquet(str(tmp_path / f"part{at}"))
        for age, name in enumerate(sorted((tmp_path / f"part{at}").glob("*.parquet"))):
            target = folder / f"{at}-{age}.parquet"
            target.write_bytes(name.read_bytes())
            os.utime(target, (1_700_000_000 + 10 * at + age, 1_700_000_000 + 10 * at + age))
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
        drain(streams.stream_circuit(stream, out, check, delay="30 minutes", salts=3))
    found = spark.read.parquet(out)
    assert {path.name for path in Path(out).glob("is_late=*")} == {"is_late=false"}
    want = rows(audit.ban_audit(df).filter("diagnostic_id <> 'last'"), "diagnostic_id")
    assert rows(found.drop("is_late"), "diagnostic_id") == want
    assert {row["circuit_open"] for row in want} == {True, False}


def test_late_requests_are_told(spark, tmp_path, rows):
    data = [("a", "k", 1000_000, 1000_500, 429, 1), ("b", "k", 9_000_000, 9_000_100, 200, 2), ("c", "k", 1_500_000, 1_500_100, 200, 3), ("d", "k", 20_000_000, 20_000_100, 200, 4)]
    df = spark.createDataFrame(data, "diagnostic_id string, limiter_key string, start_ms long, finish_ms long, http_status long, arrival long")
    drain(streams.stream_circuit(land(df, str(tmp_path / "in"), 4, "arrival"), str(tmp_path / "out"), str(tmp_path / "check"), delay="10 minutes"))
    found = {row["diagnostic_id"]: (row["is_late"], row["circuit_open"]) for row in rows(spark.read.parquet(str(tmp_path / "out")))}
    assert found == {"a": ("false", False), "b": ("false", False), "c": ("true", None)}


def test_unreadable_lines_have_a_side_output(spark, tmp_path, rows):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "0.json").write_text("\n".join([json.dumps(envelope(RESTAURANTS)), "{", "[]", json.dumps(envelope([{"id": 1, "driveDistanceMeters": "far"}]))]))
    drain(streams.stream_rejects(spark, str(folder), str(tmp_path / "out"), str(tmp_path / "check")))
    found = spark.read.parquet(str(tmp_path / "out"))
    assert rows(found, "value") == rows(readers.read_raw_rejects(spark, str(folder)), "value")
    assert sorted(row["flaw"] for row in rows(found)) == ["odd field", "unreadable", "unreadable"]
