"""Small helpers the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: Space and the control characters from tab to carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case and nothing else; the plain function does for texts without other letters."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


#: Caches that workers keep from task to task.
_CACHES: list = []


def worker_cache(cached):
    """Mark an `lru_cache` as one that a worker keeps while it does tasks of its operator, and no longer."""
    _CACHES.append(cached)
    return cached


def give_back(*own) -> None:
    """Return freed memory to the system: workers live on after a task and share the executor's limit with its heap.

    What other operators' tasks left in the worker's caches goes first; `own` are the caches that the task's operator uses.
    """
    for cached in _CACHES:
        if cached not in own:
            cached.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def let_go(spark: SparkSession) -> None:
    """Have shuffle files of what isn't needed any more deleted: Spark does so when the driver's collector meets it."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()
