"""Values of JSON fields whose type the provider doesn't keep to: read as text or Variant, typed here."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: JSON that holds nothing: an empty text, list or object, false, null or a zero.
_NOTHING = r'^(?:""|\[\]|\{\}|false|null|-?0+(?:\.0+)?(?:[eE][-+]?\d+)?)\z'


def json_truth(value: Column) -> Column:
    """Whether a Variant holds anything: not absent, null, false, zero, or an empty text, list or object.

    It is looked at once, as JSON: a filter works each use of a value out anew, and typing a Variant is dear.
    """
    return ~F.coalesce(F.to_json(value).rlike(_NOTHING), F.lit(True))


def json_flag(value: Column) -> Column:
    """The truth of a Variant; NULL where it is absent or null."""
    return F.when(F.try_variant_get(value, "$", "string").isNotNull(), json_truth(value))


def number(text: Column) -> Column:
    """A number that stands as a number or as text."""
    return text.try_cast("double")


def whole(text: Column) -> Column:
    """A whole number; one with decimals loses them."""
    return F.coalesce(text.try_cast("long"), number(text).try_cast("long"))


def is_odd_number(text: Column) -> Column:
    return text.isNotNull() & number(text).isNull()
