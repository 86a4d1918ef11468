"""Stable identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the RFC 4122 URL namespace.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(key: Column) -> Column:
    """RFC 4122 version 5 identifier of a text key in the URL namespace."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(key, "UTF-8")))
    variant = F.substring(
        F.lit("89ab"), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1, F.lit(1)
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def key_of(*parts: Column) -> Column:
    """Parts joined by a bar; a NULL part reads 'None', so keys of optional fields stay apart."""
    texts = [F.coalesce(part.cast("string"), F.lit("None")) for part in parts]
    return F.concat_ws("|", *texts)


def job_id(run_id: Column, provider: Column, window: Column, postcode: Column) -> Column:
    return uuid5(key_of(run_id, provider, window, postcode))


def menu_task_id(run_id: Column, restaurant_id: Column, slug: Column) -> Column:
    return uuid5(key_of(run_id, restaurant_id, slug))


def default_run_id(day: Column, prefix: str = "run") -> Column:
    return F.concat(F.lit(f"{prefix}-"), F.date_format(day, "yyyy-MM-dd"))


def task_name(identifier: Column, prefix: str = "job") -> Column:
    return F.concat(F.lit(f"{prefix}-"), identifier)
