"""Streams over the landing folders and logs; each gives what its batch job gives on the same data."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catchment.operators.audit import BAN_SECONDS, status_class
from catchment.operators.listing import OPEN_READS, open_now
from catchment.sources.readers import envelope_rejects, parse_envelopes
from catchment.streaming.state import NONE, AttemptsOfJob, CircuitOfKey

# Fixed value: attempts a job may have.
MAX_ATTEMPTS = 3


def _landed(spark: SparkSession, raw_dir: str) -> DataFrame:
    return spark.readStream.text(raw_dir).select("value", F.col("_metadata.file_path").alias("raw_uri"))


def stream_raw(spark: SparkSession, raw_dir: str, reads: Iterable[str] | None = None) -> DataFrame:
    """New raw envelopes as they land."""
    return parse_envelopes(_landed(spark, raw_dir), keep=("raw_uri",), reads=reads)


def stream_rejects(spark: SparkSession, raw_dir: str, out: str, checkpoint: str, now: bool = True) -> StreamingQuery:
    """Landed texts that couldn't be read, or not in full, as (raw_uri, flaw, value): what `stream_raw` leaves out."""
    return _to_parquet(envelope_rejects(_landed(spark, raw_dir), keep=("raw_uri",)), out, checkpoint, now)


def stream_snapshots(spark: SparkSession, raw_dir: str, out: str, checkpoint: str, now: bool = True) -> StreamingQuery:
    """Raw landing files to open-now snapshots; the file sink and its checkpoint make each file count once."""
    rows = open_now(stream_raw(spark, raw_dir, OPEN_READS))
    return _to_parquet(rows, out, checkpoint, now)


def _to_parquet(rows: DataFrame, out: str, checkpoint: str, now: bool) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if now else writer).start()


def one_result(results: DataFrame, time: str = "captured_at", tie: str = "snapshot_id") -> DataFrame:
    """The first result of each job, by time."""
    first = results.groupBy("job_id").agg(F.min_by(F.struct(*results.columns), F.struct(time, tie)).alias("_first"))
    return first.select("_first.*")


def stream_dedupe(results: DataFrame, delay: str = "1 day", time: str = "captured_at", salts: int = 16) -> DataFrame:
    """One result per job within the delay, the first that comes.

    Repeats go in two steps: within each of `salts` groups of a job's rows, and then among the few that are left, so
    that a job that is repeated over and over isn't the work of one task.
    """
    salted = results.withWatermark(time, delay).withColumn("_salt", F.pmod(F.xxhash64(*results.columns), F.lit(salts)))
    return salted.dropDuplicatesWithinWatermark(["job_id", "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(["job_id"])


def late_flag(tasks: DataFrame, arrival: str = "received_at") -> DataFrame:
    """Mark tasks that arrive at or after their window's end; no end means never late."""
    return tasks.withColumn("is_expired", F.coalesce(F.col(arrival) >= F.col("window_end_at"), F.lit(False)))


def stream_late_split(tasks: DataFrame, on_time_path: str, expired_path: str, checkpoint: str, arrival: str = "received_at", now: bool = True) -> StreamingQuery:
    """Send on-time and expired tasks to two tables; a repeated batch overwrites its own folder."""

    def split(batch: DataFrame, batch_id: int) -> None:
        flagged = late_flag(batch, arrival).persist()
        for path, expired in ((on_time_path, False), (expired_path, True)):
            part = flagged.filter(F.col("is_expired") == expired).drop("is_expired")
            part.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        flagged.unpersist()

    writer = tasks.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if now else writer).start()


def running_attempts(events: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Attempts per job up to the cap, whether it succeeded, and its state; an event that comes again counts once."""
    started = F.when(F.col("event_type") == "started", F.col("event_id"))
    counted = events.groupBy("job_id").agg(
        F.least(F.count_distinct(started), F.lit(max_attempts)).cast("int").alias("attempts"),
        F.bool_or(F.col("event_type") == "succeeded").alias("has_succeeded"),
    )
    spent = F.when(F.col("attempts") >= max_attempts, "exhausted").otherwise("open")
    return counted.withColumn("state", F.when(F.col("has_succeeded"), "succeeded").otherwise(spent))


def stream_attempts(
    events: DataFrame, max_attempts: int = MAX_ATTEMPTS, time: str = "event_time", delay: str = "1 day", remember: timedelta = timedelta(days=14)
) -> DataFrame:
    """`running_attempts` in update mode: a row whenever a job's attempts or state change, in any order of events.

    As many event ids are held per job as the cap allows, and a job is forgotten when the watermark, `delay` behind the
    latest event, is `remember` beyond its newest one.
    """
    rows = events.filter(F.col("job_id").isNotNull()).withWatermark(time, delay).select(
        F.col("job_id").cast("string").alias("job_id"),
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.coalesce(F.unix_millis(time), F.lit(NONE)).alias("at_ms"),
    )
    keeper = AttemptsOfJob(max_attempts, int(remember.total_seconds() * 1000))
    shape = "job_id string, attempts int, has_succeeded boolean, state string"
    return rows.groupBy("job_id").transformWithStateInPandas(keeper, shape, "Update", "EventTime")


def outcome_windows(diagnostics: DataFrame, width: str = "1 minute", time: str = "event_time") -> DataFrame:
    """Requests and 429 answers per tumbling window and status class; batch and stream alike."""
    classed = diagnostics.withColumn("status_class", status_class(F.col("http_status")))
    return (
        classed.groupBy(F.window(time, width).alias("w"), "status_class")
        .agg(F.count(F.lit(1)).alias("requests"), F.count_if(F.col("http_status") == 429).alias("too_many"))
        .select(F.col("w.start").alias("window_start"), "status_class", "requests", "too_many")
    )


def stream_outcomes(diagnostics: DataFrame, width: str = "1 minute", delay: str = "10 minutes", time: str = "event_time") -> DataFrame:
    return outcome_windows(diagnostics.withWatermark(time, delay), width, time)


def stream_circuit(
    diagnostics: DataFrame,
    out: str,
    checkpoint: str,
    key: str = "limiter_key",
    start: str = "start_ms",
    finish: str = "finish_ms",
    tie: str = "diagnostic_id",
    ban_seconds: int = BAN_SECONDS,
    delay: str = "1 hour",
    salts: int = 8,
    now: bool = True,
) -> StreamingQuery:
    """Flag requests that start while their key's ban is open, across micro-batches, as `ban_audit` does.

    A request is decided when the watermark, `delay` behind the latest start, has passed it; rows may come in any order
    until then. Requests that come later go to `out/is_late=true` without a decision, the others to `out/is_late=false`;
    a late 429 still counts for what is undecided. A key's requests are dealt over `salts` states, and its 429s, of
    which there are few, go to each, so that one key isn't one task.
    """
    status, own = F.col("http_status").cast("long"), F.pmod(F.xxhash64(tie), F.lit(salts)).cast("int")
    banned = (status == 429) & F.col(finish).isNotNull()
    timed = diagnostics.withColumn("_start", F.timestamp_millis(start)).withWatermark("_start", delay)
    dealt = timed.select(
        F.col(key).cast("string").alias(key),
        F.explode(F.when(banned, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(own))).alias("salt"),
        own.alias("own"),
        # The engine drops rows behind the watermark where it sees the time; as a number they come through, to be told.
        F.coalesce(F.unix_millis("_start"), F.lit(NONE)).alias("start_ms"),
        F.col(tie).cast("string").alias("tie"),
        F.coalesce(status, F.lit(NONE)).alias("http_status"),
        F.coalesce(F.when(banned, F.col(finish).cast("long")), F.lit(NONE)).alias("ban_ms"),
    )
    rows = dealt.withColumn("is_request", (F.col("salt") == F.col("own")) & (F.col("start_ms") != NONE)).drop("own")
    shape = f"`{key}` string, tie string, start_ms long, http_status long, is_late boolean, circuit_open boolean, ban_until_ms long"
    told = rows.groupBy(key, "salt").transformWithStateInPandas(CircuitOfKey(key, 1000 * ban_seconds), shape, "Append", "EventTime")
    named = told.withColumnsRenamed({"tie": tie, "start_ms": start})
    writer = named.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).partitionBy("is_late").outputMode("append")
    return (writer.trigger(availableNow=True) if now else writer).start()
