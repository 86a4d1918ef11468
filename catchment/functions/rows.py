"""Opening arrays into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_array(df: DataFrame, keep: list, array: str | Column, item: str, position: str | None = None, keep_null: bool = False) -> DataFrame:
    """One row per non-NULL member (per member with `keep_null`), with its 0-based position where named.

    The plain explode makes the optimizer test the array's size first, further down, and so parse or match the same
    text again; the outer form with a later filter works the array out once.
    """
    opened = F.posexplode_outer(array).alias(position, item) if position else F.explode_outer(array).alias(item)
    return df.select(*keep, opened).filter(F.col(position if keep_null and position else item).isNotNull())
