"""Menu jobs: page state, items, modifiers, deals and summaries out of saved documents.

Every job takes one row per saved page with a `page_id`. The item and detail documents travel in the same row, as
columns `items` and `details`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catchment.functions.rows import open_array

STATE_SCRIPT = r"""(?is)<script(?=[^>]*\bid=["']?__NEXT_DATA__["'\s>])[^>]*>(.*?)</script>"""
DEFAULT_CDN = "https://menus.example"

ITEM = (
    "array<struct<Id:string,Name:string,Description:string,Type:string,Labels:array<string>,"
    "Variations:array<struct<Id:string,Name:string,BasePrice:string,ModifierGroupsIds:array<string>,DealGroupsIds:array<string>>>,"
    "EnergyContent:struct<EnergyDisplay:string>,EnergyUnits:string,ImageSources:array<struct<Path:string>>,Restrictions:string>>"
)
ITEMS = f"Items {ITEM}"
DETAILS = (
    "ModifierSets array<struct<Id:string,Modifier:struct<Id:string,Name:string,AdditionPrice:string,RemovePrice:string,"
    "DefaultChoices:string,MinChoices:string,MaxChoices:string,NutritionalInfo:string>>>,"
    "ModifierGroups array<struct<Id:string,Name:string,MinChoices:string,MaxChoices:string,Modifiers:array<string>>>,"
    "DealGroups array<struct<Id:string,Name:string,NumberOfChoices:string,DealItemVariations:array<struct<"
    "DealItemVariationId:string,MinChoices:string,MaxChoices:string,AdditionPrice:string,"
    "NumberOfServings:struct<ServingsDisplay:string>>>>>"
)
_RESTAURANT = (
    "struct<restaurantId:string,restaurantInfo:struct<id:string,name:string>,itemsUrl:string,itemDetailsUrl:string,"
    "truncatedUrl:string,menus:array<struct<menuGroupId:string,description:string,"
    "categories:array<struct<id:string,name:string,itemIds:array<string>>>>>>"
)
STATE = (
    "props struct<appProps:struct<clientConfig:struct<jeRestaurantCdnUrls:struct<uk:string>>,"
    f"preloadedState:struct<menu:struct<restaurant:struct<cdn:struct<restaurant:{_RESTAURANT},items:{ITEM}>>>>>>"
)


def text_or_blank(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def usable(value: Column) -> Column:
    """A text that is neither missing nor blank nor zero."""
    return F.when(~value.isin("", "0"), value)


def page_state(pages: DataFrame, html: str = "html", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Menu state of saved pages; `error` is set where a page holds none or it cannot be read."""
    found = pages.select(*keep, F.regexp_extract(html, STATE_SCRIPT, 1).alias("state_text"))
    parsed = found.select(*keep, "state_text", F.from_json("state_text", STATE).alias("state"))
    cdn = F.col("state.props.appProps.preloadedState.menu.restaurant.cdn")
    base = F.coalesce(F.nullif(F.col("state.props.appProps.clientConfig.jeRestaurantCdnUrls.uk"), F.lit("")), F.lit(DEFAULT_CDN))
    restaurant = cdn["restaurant"]
    error = F.when(F.col("state_text") == "", "no menu state in page").when(
        F.try_parse_json("state_text").isNull(), "menu state is not JSON"
    )
    return parsed.select(
        *keep,
        F.regexp_replace(base, "/+$", "").alias("cdn_base"),
        F.coalesce(usable(restaurant["restaurantId"]), usable(restaurant["restaurantInfo"]["id"]), F.lit("")).alias("restaurant_id"),
        text_or_blank(restaurant["restaurantInfo"]["name"]).alias("restaurant_name"),
        text_or_blank(restaurant["itemsUrl"]).alias("items_url"),
        text_or_blank(restaurant["itemDetailsUrl"]).alias("item_details_url"),
        text_or_blank(restaurant["truncatedUrl"]).alias("truncated_url"),
        restaurant["menus"].alias("menus"),
        cdn["items"].alias("inline_items"),
        error.alias("error"),
    )


def attach_documents(state: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the item and detail documents saved per page as JSON text (page_id, items_json, details_json)."""
    parsed = documents.select(
        "page_id", F.from_json("items_json", ITEMS).alias("items"), F.from_json("details_json", DETAILS).alias("details")
    )
    return state.join(parsed, "page_id", "left")


def item_list(df: DataFrame) -> Column:
    """The item document's items, or the page's own where that has none."""
    inline = F.col("inline_items")
    if "items" not in df.columns:
        return inline
    listed = F.col("items.Items")
    return F.when(F.size(listed) > 0, listed).otherwise(inline)


def json_cell(value: Column) -> Column:
    """JSON text of a field read as text; missing and empty values are blank."""
    return F.when(value.isin("[]", "{}"), "").otherwise(text_or_blank(value))


def joined_ids(variations: Column, field: str) -> Column:
    """Distinct ids of all variations, sorted, joined by bars."""
    ids = F.flatten(F.filter(variations[field], lambda part: part.isNotNull()))
    return text_or_blank(F.array_join(F.array_sort(F.array_distinct(ids)), "|"))


def _present(values: Column) -> Column:
    return F.filter(values, lambda value: value.isNotNull())


def indexed(df: DataFrame, entries: Column, key_of: Callable[[Column], Column]) -> DataFrame:
    """Add `_entries`, the last entry first, and their `_keys`: worked out once for each page, before anything is opened."""
    last_first = df.withColumn("_entries", F.reverse(_present(entries)))
    return last_first.withColumn("_keys", F.transform("_entries", key_of))


def looked_up(key: Column) -> Column:
    """The last entry of a key, within the page's row; NULL for an unknown or missing key."""
    at = F.array_position(F.col("_keys"), key)
    return F.when(at > 0, F.element_at("_entries", at.cast("int")))


def menu_positions(state: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per (menu, category, item position), positions from zero."""
    menus = open_array(state, ["page_id", "restaurant_id", "restaurant_name", *keep], "menus", "menu", "menu_index")
    categories = open_array(menus, ["*"], "menu.categories", "category", "category_index")
    positions = open_array(categories, ["*"], "category.itemIds", "item_key", "position_in_category", keep_null=True)
    return positions.select(
        "page_id",
        "restaurant_id",
        "restaurant_name",
        F.col("menu_index").cast("long").alias("menu_index"),
        text_or_blank(F.col("menu.menuGroupId")).alias("menu_id"),
        text_or_blank(F.col("menu.description")).alias("menu_name"),
        F.col("category_index").cast("long").alias("category_index"),
        text_or_blank(F.col("category.id")).alias("category_id"),
        text_or_blank(F.col("category.name")).alias("category_name"),
        F.col("position_in_category").cast("long").alias("position_in_category"),
        "item_key",
        *keep,
    )


def item_columns(item: Column) -> list[Column]:
    variations = item["Variations"]
    prices = F.filter(F.transform(variations["BasePrice"], lambda price: price.try_cast("double")), lambda price: price.isNotNull())
    return [
        text_or_blank(item["Id"]).alias("item_id"),
        text_or_blank(item["Name"]).alias("item_name"),
        text_or_blank(item["Description"]).alias("item_description"),
        text_or_blank(item["Type"]).alias("item_type"),
        text_or_blank(F.array_join(item["Labels"], "|")).alias("labels"),
        F.array_min(prices).alias("min_price"),
        F.array_max(prices).alias("max_price"),
        text_or_blank(F.array_join(F.transform(variations["Id"], text_or_blank), "|")).alias("variation_ids"),
        F.greatest(F.coalesce(F.size(variations), F.lit(0)), F.lit(0)).cast("long").alias("variation_count"),
        joined_ids(variations, "ModifierGroupsIds").alias("modifier_group_ids"),
        joined_ids(variations, "DealGroupsIds").alias("deal_group_ids"),
        text_or_blank(item["EnergyContent"]["EnergyDisplay"]).alias("energy_display"),
        text_or_blank(item["EnergyUnits"]).alias("energy_units"),
        text_or_blank(F.get(item["ImageSources"], 0)["Path"]).alias("image_0"),
        json_cell(item["Restrictions"]).alias("restrictions_json"),
    ]


def _item_id(item: Column) -> Column:
    return item["Id"]


def menu_items(state: DataFrame) -> DataFrame:
    """One row per menu position whose item is known; of repeated ids the last one counts."""
    positions = menu_positions(indexed(state, item_list(state), _item_id), ("_entries", "_keys"))
    # A list of one or none, so that the item is looked up once and unknown ones leave.
    found = open_array(positions, [name for name in positions.columns if not name.startswith("_")], F.array(looked_up(F.col("item_key"))), "item")
    return found.select(*[name for name in found.columns if name not in ("item_key", "item")], *item_columns(F.col("item")))


def menu_modifiers(state: DataFrame) -> DataFrame:
    """One row per modifier of each group; an unknown modifier keeps its row with blank columns."""
    known = indexed(state, F.col("details.ModifierSets"), lambda held: F.coalesce(held["Id"], F.lit("None")))
    groups = open_array(known, ["page_id", "restaurant_id", "restaurant_name", "_entries", "_keys"], "details.ModifierGroups", "group")
    entries = open_array(groups, ["*"], "group.Modifiers", "modifier_set_id", "position_in_group", keep_null=True)
    # The outer form keeps the row of an unknown modifier.
    found = entries.select("*", F.explode_outer(F.array(looked_up(F.col("modifier_set_id"))["Modifier"])).alias("modifier"))
    modifier = F.col("modifier")
    return found.select(
        "page_id",
        "restaurant_id",
        "restaurant_name",
        text_or_blank(F.col("group.Id")).alias("modifier_group_id"),
        text_or_blank(F.col("group.Name")).alias("modifier_group_name"),
        text_or_blank(F.col("group.MinChoices")).alias("group_min_choices"),
        text_or_blank(F.col("group.MaxChoices")).alias("group_max_choices"),
        F.col("position_in_group").cast("long").alias("position_in_group"),
        "modifier_set_id",
        text_or_blank(modifier["Id"]).alias("modifier_id"),
        text_or_blank(modifier["Name"]).alias("modifier_name"),
        text_or_blank(modifier["AdditionPrice"]).alias("addition_price"),
        text_or_blank(modifier["RemovePrice"]).alias("remove_price"),
        text_or_blank(modifier["DefaultChoices"]).alias("default_choices"),
        text_or_blank(modifier["MinChoices"]).alias("modifier_min_choices"),
        text_or_blank(modifier["MaxChoices"]).alias("modifier_max_choices"),
        json_cell(modifier["NutritionalInfo"]).alias("nutrition_json"),
    )


def menu_deals(state: DataFrame) -> DataFrame:
    """One row per deal variation; modifier ids stay in document order."""

    def of_item(item: Column) -> Column:
        some = F.coalesce(_present(item["Variations"]), F.array())
        return F.transform(some, lambda variation: F.struct(item["Id"].alias("Id"), item["Name"].alias("Name"), variation.alias("variation")))

    variations = F.flatten(F.transform(_present(item_list(state)), of_item))
    index = indexed(state, variations, lambda held: F.coalesce(held["variation"]["Id"], F.lit("None")))
    groups = open_array(index, ["page_id", "restaurant_id", "restaurant_name", "_entries", "_keys"], "details.DealGroups", "group")
    entries = open_array(groups, ["*"], "group.DealItemVariations", "entry", "position_in_group").withColumn(
        "deal_item_variation_id", text_or_blank(F.col("entry.DealItemVariationId"))
    )
    found = entries.select("*", F.explode_outer(F.array(looked_up(F.col("deal_item_variation_id")))).alias("known"))
    known = F.col("known")
    return found.select(
        "page_id",
        "restaurant_id",
        "restaurant_name",
        text_or_blank(F.col("group.Id")).alias("deal_group_id"),
        text_or_blank(F.col("group.Name")).alias("deal_group_name"),
        text_or_blank(F.col("group.NumberOfChoices")).alias("number_of_choices"),
        F.col("position_in_group").cast("long").alias("position_in_group"),
        "deal_item_variation_id",
        text_or_blank(known["Id"]).alias("item_id"),
        text_or_blank(known["Name"]).alias("item_name"),
        text_or_blank(known["variation"]["Name"]).alias("variation_name"),
        text_or_blank(known["variation"]["BasePrice"]).alias("base_price"),
        text_or_blank(F.array_join(known["variation"]["ModifierGroupsIds"], "|")).alias("modifier_group_ids"),
        text_or_blank(F.col("entry.MinChoices")).alias("min_choices"),
        text_or_blank(F.col("entry.MaxChoices")).alias("max_choices"),
        text_or_blank(F.col("entry.AdditionPrice")).alias("addition_price"),
        text_or_blank(F.col("entry.NumberOfServings.ServingsDisplay")).alias("servings_display"),
    )


def menu_summary(state: DataFrame) -> DataFrame:
    """Sizes per saved page, counted in the page's row."""

    def length(value: Column) -> Column:
        return F.greatest(F.coalesce(F.size(value), F.lit(0)), F.lit(0)).cast("long")

    def entries(groups: Column, field: str) -> Column:
        sizes = F.transform(groups[field], length)
        return F.coalesce(F.aggregate(sizes, F.lit(0).cast("long"), lambda total, one: total + one), F.lit(0).cast("long"))

    def list_or_none(value: Column) -> Column:
        return F.coalesce(value, F.array())

    # Positions whose item is unknown, over all menus and categories.
    positions = F.flatten(F.transform("menus", lambda menu: list_or_none(F.flatten(F.transform(menu["categories"], lambda category: list_or_none(category["itemIds"]))))))
    staged = indexed(state, item_list(state), _item_id).withColumn("_positions", positions)
    missing = F.filter("_positions", lambda key: ~F.coalesce(F.array_contains("_keys", key), F.lit(False)))
    missing = F.when(F.col("_keys").isNull(), F.size("_positions")).otherwise(F.size(missing))
    listed = F.col("items.Items")
    return staged.select(
        "page_id",
        "restaurant_id",
        "restaurant_name",
        "cdn_base",
        "items_url",
        "item_details_url",
        "truncated_url",
        length(F.col("menus")).alias("menus"),
        # Without an item document the page's own items are the items document.
        F.when(F.col("items_url") == "", length(F.col("inline_items"))).otherwise(length(listed)).alias("items"),
        F.greatest(F.coalesce(missing, F.lit(0)), F.lit(0)).cast("long").alias("missing_item_details"),
        length(F.col("details.ModifierGroups")).alias("modifier_groups"),
        entries(F.col("details.ModifierGroups"), "Modifiers").alias("modifier_options"),
        length(F.col("details.DealGroups")).alias("deal_groups"),
        entries(F.col("details.DealGroups"), "DealItemVariations").alias("deal_options"),
    )
