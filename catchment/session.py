"""Session settings and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "catchment", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # First rows of a group are limited in each task for samples of any usual size, not only up to 1,000 rows.
        "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
        # The streams' keyed state needs it.
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only on a local master."""
    context = spark.sparkContext
    active = context.getCheckpointDir()
    if active:
        return active
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="catchment-checkpoint-")
    context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise to the checkpoint folder, so that later reads see the same rows after a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
