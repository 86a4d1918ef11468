"""Retail brand and category rules over outlet names and cuisine lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# A name ends here when no ASCII letter, digit or underscore follows.
NAME_END = r"(?![0-9A-Za-z_])"

# Brand names as patterns on the lower-cased outlet name, first match wins.
BIG_BRANDS = (
    ("coop", r"co[- ]?op"),
    ("morrisons", r"morrisons"),
    ("sainsburys", r"sainsbury[^a-z0-9]?s"),
    ("asda", r"asda"),
    ("iceland", r"iceland"),
    ("waitrose", r"waitrose"),
)
OTHER_GROCERS = (
    r"londis",
    r"one stop",
    r"spar",
    r"premier",
    r"nisa",
    r"budgens",
    r"costcutter",
    r"best[- ]?one",
    r"gopuff",
    r"family shopper",
    r"lifestyle express",
    r"go local",
    r"shop ?n ?drive",
)
CAFE = r"asda\s+cafe"
GROCERY_TAG = r"groceries?"
OTHER_SHOP_TAG = r"(convenience|supermarket)"


@dataclass(frozen=True)
class BrandRules:
    big_brands: tuple[tuple[str, str], ...] = BIG_BRANDS
    other_grocers: tuple[str, ...] = OTHER_GROCERS
    excluded_name: str = CAFE
    excluded_brand: str = "asda"
    wanted_tag: str = GROCERY_TAG
    unwanted_tag: str = OTHER_SHOP_TAG


DEFAULT_RULES = BrandRules()


def starts_with_name(name: Column, pattern: str) -> Column:
    return name.rlike(rf"^\s*({pattern}){NAME_END}")


def lists_tag(cuisines: Column, pattern: str) -> Column:
    return cuisines.rlike(rf"(^|,\s*){pattern}(\s*,|$)")


def big_brand(name: Column, rules: BrandRules = DEFAULT_RULES) -> Column:
    lowered = F.lower(F.coalesce(name, F.lit("")))
    chain = None
    for brand, pattern in rules.big_brands:
        hit = starts_with_name(lowered, pattern)
        if brand == rules.excluded_brand:
            hit = hit & ~starts_with_name(lowered, rules.excluded_name)
        chain = F.when(hit, brand) if chain is None else chain.when(hit, brand)
    return chain


def is_general_grocery(name: Column, rules: BrandRules = DEFAULT_RULES) -> Column:
    lowered = F.lower(F.coalesce(name, F.lit("")))
    patterns = [pattern for _, pattern in rules.big_brands] + list(rules.other_grocers)
    return starts_with_name(lowered, "|".join(patterns)) & ~starts_with_name(lowered, rules.excluded_name)


def has_groceries_tag(cuisines: Column, rules: BrandRules = DEFAULT_RULES) -> Column:
    lowered = F.lower(F.coalesce(cuisines, F.lit("")))
    return lists_tag(lowered, rules.wanted_tag) & ~lists_tag(lowered, rules.unwanted_tag)
