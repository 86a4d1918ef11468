"""Registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catchment.session import ensure_checkpoint_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def time_text(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd HH:mm:ss")


def sql_time(expression: str) -> str:
    return f"strftime({expression}, '%Y-%m-%d %H:%M:%S')"


def sql_uuid5(key: str) -> str:
    """RFC 4122 version 5 in the URL namespace, as DuckDB SQL."""
    digest = f"sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({key}))"
    variant = f"substr('89ab', CAST((strpos('0123456789abcdef', substr({digest}, 17, 1)) - 1) % 4 + 1 AS BIGINT), 1)"
    return (
        f"(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3) || '-' || {variant}"
        f" || substr({digest}, 18, 3) || '-' || substr({digest}, 21, 12))"
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder, under the shared checkpoint folder, for a query that writes."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid4()}"
