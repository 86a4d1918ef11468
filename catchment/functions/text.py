"""Text cleaning, parsing and formatting expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the whitespace class that Python's str.isspace covers.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"

NOT_WHITESPACE = r"(?U)[^\s\x1c-\x1f]"

# Accepted service verticals.
VERTICALS = ("restaurants", "groceries")


def clean_postcode(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, WHITESPACE, ""))


def clean_text(value: Column) -> Column:
    return F.trim(F.regexp_replace(value, WHITESPACE, " "))


def is_blank(value: Column) -> Column:
    """Whether `clean_text` leaves nothing."""
    return ~value.rlike(NOT_WHITESPACE)


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def join_present(items: Column, separator: str = ", ") -> Column:
    """Join the non-blank members in order; NULL when none is left."""
    return blank_to_null(F.array_join(F.array_remove(items, ""), separator))  # joining leaves NULL out


def join_distinct_sorted(items: Column, separator: str = ", ") -> Column:
    kept = F.array_remove(items, "")
    return blank_to_null(F.array_join(F.sort_array(F.array_distinct(kept)), separator))


def format_money(value: Column) -> Column:
    """Price text: free at or below zero, pounds with two decimals, other text as it stands."""
    text = value.cast("string")
    amount = text.try_cast("double")
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(amount.isNull(), clean_text(text))
        .when(amount <= 0, F.lit("Free"))
        .otherwise(F.format_string("£%.2f", amount))
    )


def format_eta(lower: Column, upper: Column, approximate: Column) -> Column:
    return F.when(
        lower.isNotNull() & upper.isNotNull(),
        F.concat(lower.cast("string"), F.lit("-"), upper.cast("string"), F.lit(" mins")),
    ).when(approximate.isNotNull(), F.concat(approximate.cast("string"), F.lit(" mins")))


def menu_page_url(slug: Column, base_url: str) -> Column:
    return F.when(slug != "", F.concat(F.lit(f"{base_url}/restaurants-"), slug, F.lit("/menu")))


def partition_label(value: Column) -> Column:
    """A value as a safe folder name."""
    text = F.coalesce(value.cast("string"), F.lit("null"))
    safe = F.regexp_replace(text, r"[^A-Za-z0-9_.\-]+", "_")
    return F.coalesce(blank_to_null(F.btrim(safe, F.lit("_"))), F.lit("empty"))


def parse_rating(label: Column) -> tuple[Column, Column]:
    """Star rating and review count out of a spoken label."""
    pattern = r"([\d.]+)\s+stars?\s+from\s+([\d,]+)\s+reviews?"
    stars = F.regexp_extract(label, pattern, 1).try_cast("double")
    count = F.regexp_replace(F.regexp_extract(label, pattern, 2), ",", "").try_cast("long")
    return stars, count


def parse_place_count(body: Column) -> Column:
    found = F.regexp_extract(body, r"(?i)(\d[\d,]*)\s+places", 1)
    return F.regexp_replace(found, ",", "").try_cast("long")


def parse_verticals(value: Column, strict: bool = True) -> Column:
    """Requested verticals as an array; unknown names raise when strict, empty input means all."""
    words = F.filter(F.split(F.regexp_replace(F.lower(value), WHITESPACE, ","), ","), lambda word: word != "")
    named = F.transform(words, lambda word: F.when(word == "grocery", F.lit("groceries")).otherwise(word))
    allowed = F.array(*[F.lit(name) for name in VERTICALS])
    if strict:
        unknown = F.array_except(named, allowed)
        named = F.when(
            F.size(unknown) > 0,
            F.raise_error(F.concat(F.lit("Unsupported vertical: "), F.array_join(unknown, ", "))).cast("array<string>"),
        ).otherwise(named)
    return F.when(F.size(named) > 0, named).otherwise(allowed)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def url_query_keys(url: Column) -> Column:
    """Comma-joined names of the query pairs that have a value."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    pairs = F.filter(F.split(query, "&"), lambda pair: pair.rlike(r"^[^=]*=."))
    names = F.transform(pairs, lambda pair: F.substring_index(pair, "=", 1))
    return F.array_join(F.transform(names, lambda name: F.coalesce(F.try_url_decode(name), name)), ",")


def mentions_any(words: list[str] | tuple[str, ...], *parts: Column) -> Column:
    """True when a word occurs, case-insensitively, in the parts joined by spaces."""
    text = F.lower(F.concat_ws(" ", *parts))
    found = F.lit(False)
    for word in words:
        found = found | text.contains(word.lower())
    return found
