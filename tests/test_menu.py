import json

import pytest
from pyspark.sql import functions as F

from catchment.operators import menu

STATE = {
    "props": {
        "appProps": {
            "clientConfig": {"jeRestaurantCdnUrls": {"uk": "https://cdn.example//"}},
            "preloadedState": {
                "menu": {
                    "restaurant": {
                        "cdn": {
                            "restaurant": {
                                "restaurantId": "", "restaurantInfo": {"id": 42, "name": "Place"}, "itemsUrl": "i.json", "itemDetailsUrl": "d.json",
                                "menus": [{"menuGroupId": "m", "categories": [{"id": "c", "name": "Cat", "itemIds": ["1", "2", "9", "1"]}, {"itemIds": None}]}],
                            },
                            "items": [{"Id": "1", "Name": "Inline"}],
                        }
                    }
                }
            },
        }
    }
}
ITEMS = {
    "Items": [
        {"Id": "1", "Name": "First"},
        {"Id": "1", "Name": "Last", "Labels": ["a", "b"], "Variations": [{"Id": "v1", "BasePrice": 5, "ModifierGroupsIds": [2, 1]}, {"Id": None, "BasePrice": "n/a", "ModifierGroupsIds": [1]}, {"Id": "v3", "BasePrice": 2.5, "DealGroupsIds": ["d"]}],
         "ImageSources": [{"Path": "p.png"}], "Restrictions": [{"z": 1, "a": "é"}], "EnergyContent": {"EnergyDisplay": "9 kcal"}},
        {"Id": "2", "Name": "Two", "Restrictions": []},
    ]
}
DETAILS = {
    "ModifierSets": [{"Id": 1, "Modifier": {"Id": "m1", "Name": "Old"}}, {"Id": "1", "Modifier": {"Id": "m1", "Name": "New", "AdditionPrice": 0.5, "NutritionalInfo": {"b": 1, "a": 2}}}],
    "ModifierGroups": [{"Id": "g", "Name": "Group", "MinChoices": 0, "Modifiers": [1, "7"]}, {"Id": "empty"}],
    "DealGroups": [{"Id": "d", "NumberOfChoices": 2, "DealItemVariations": [{"DealItemVariationId": "v1", "MinChoices": 0, "NumberOfServings": {"ServingsDisplay": "2"}}, {"DealItemVariationId": "x"}]}],
}


def inputs(spark, items=ITEMS, details=DETAILS):
    html = f'<html><script>var a;</script><SCRIPT type="application/json" id="__NEXT_DATA__">{json.dumps(STATE)}</SCRIPT></html>'
    pages = spark.createDataFrame([(1, html), (2, "<html></html>"), (3, '<script id="__NEXT_DATA__">{oops</script>')], "page_id int, html string")
    documents = spark.createDataFrame([(1, json.dumps(items), json.dumps(details))], "page_id int, items_json string, details_json string")
    return menu.page_state(pages), documents


def test_page_state(spark, rows):
    state, _ = inputs(spark)
    found = {row["page_id"]: row for row in rows(state)}
    assert (found[1]["restaurant_id"], found[1]["restaurant_name"], found[1]["cdn_base"], found[1]["error"]) == ("42", "Place", "https://cdn.example", None)
    assert found[2]["error"] == "no menu state in page" and found[3]["error"] == "menu state is not JSON"
    assert found[2]["menus"] is None and found[2]["restaurant_id"] == ""


def test_items(spark, rows):
    state, documents = inputs(spark)
    whole = menu.attach_documents(state, documents)
    found = rows(menu.menu_items(whole), "position_in_category")
    assert [(row["position_in_category"], row["item_name"]) for row in found] == [(0, "Last"), (1, "Two"), (3, "Last")]
    first = found[0]
    assert (first["min_price"], first["max_price"], first["variation_ids"], first["variation_count"]) == (2.5, 5.0, "v1||v3", 3)
    assert (first["modifier_group_ids"], first["deal_group_ids"], first["labels"], first["image_0"]) == ("1|2", "d", "a|b", "p.png")
    assert (first["restrictions_json"], found[1]["restrictions_json"], found[1]["min_price"], first["menu_name"]) == ('[{"z":1,"a":"é"}]', "", None, "")
    assert len(found[0]) == 25  # 24 columns and the page


def test_inline_items_stand_in_for_an_empty_document(spark, rows):
    state, documents = inputs(spark, {"Items": []})
    found = rows(menu.menu_items(menu.attach_documents(state, documents)))
    assert {row["item_name"] for row in found} == {"Inline"} and len(found) == 2


def test_modifiers_and_deals(spark, rows):
    state, documents = inputs(spark)
    whole = menu.attach_documents(state, documents)
    modifiers = rows(menu.menu_modifiers(whole), "position_in_group")
    assert [(row["modifier_set_id"], row["modifier_name"], row["addition_price"]) for row in modifiers] == [("1", "New", "0.5"), ("7", "", "")]
    assert modifiers[0]["nutrition_json"] == '{"b":1,"a":2}' and modifiers[0]["group_min_choices"] == "0"
    deals = rows(menu.menu_deals(whole), "position_in_group")
    assert [(row["item_name"], row["base_price"], row["modifier_group_ids"], row["servings_display"]) for row in deals] == [("Last", "5", "2|1", "2"), ("", "", "", "")]


def test_summary(spark, rows):
    state, documents = inputs(spark)
    found = {row["page_id"]: row for row in rows(menu.menu_summary(menu.attach_documents(state, documents)))}
    row = found[1]
    assert (row["menus"], row["items"], row["missing_item_details"], row["modifier_groups"], row["modifier_options"], row["deal_groups"], row["deal_options"]) == (1, 3, 1, 2, 2, 1, 2)
    assert found[2]["menus"] == 0


@pytest.mark.parametrize("job", ["menu_items", "menu_modifiers", "menu_deals", "menu_summary"])
def test_pages_are_read_once_and_nothing_moves_but_to_attach(spark, job):
    state, documents = inputs(spark)
    plan = getattr(menu, job)(menu.attach_documents(state, documents))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 2 and "Aggregate" not in plan
    assert plan.count("Scan ") + plan.count("LocalTableScan") <= 4 and plan.count("Join") == 1


def test_odd_ids_within_a_page(spark, rows):
    """NULL ids, repeated ids and NULL members: the last entry counts, unknown ones are told."""
    items = {"Items": [{"Id": "1", "Name": "Old"}, None, {"Id": None, "Name": "Nameless"}, {"Id": "1", "Name": "New", "Variations": [None, {"Id": "v"}, {"Id": "v", "Name": "Later"}, {"Name": "None"}]}]}
    details = {"ModifierSets": [None, {"Modifier": {"Id": "m0"}}, {"Id": "5"}], "ModifierGroups": [None, {"Id": "g", "Modifiers": [None, "5", "None"]}],
               "DealGroups": [{"Id": "d", "DealItemVariations": [None, {"DealItemVariationId": "v"}, {"DealItemVariationId": None}, {"DealItemVariationId": "None"}]}]}
    state, documents = inputs(spark, items, details)
    whole = menu.attach_documents(state, documents)
    assert [(row["position_in_category"], row["item_name"]) for row in rows(menu.menu_items(whole), "position_in_category")] == [(0, "New"), (3, "New")]
    modifiers = rows(menu.menu_modifiers(whole), "position_in_group")
    assert [(row["modifier_set_id"], row["modifier_id"]) for row in modifiers] == [(None, ""), ("5", ""), ("None", "m0")]
    deals = rows(menu.menu_deals(whole), "position_in_group")
    assert [(row["position_in_group"], row["variation_name"]) for row in deals] == [(1, "Later"), (2, ""), (3, "None")]
    summary = {row["page_id"]: row["missing_item_details"] for row in rows(menu.menu_summary(whole))}
    assert summary == {1: 2, 2: 0, 3: 0}
    empty = menu.attach_documents(state, documents).withColumn("inline_items", F.lit(None).cast(menu.ITEM)).withColumn("items", F.lit(None).cast(f"struct<Items:{menu.ITEM}>"))
    assert {row["page_id"]: row["missing_item_details"] for row in rows(menu.menu_summary(empty))}[1] == 4
