"""What the plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"

LAZY = [
    "user_order_features",
    "label_segments",
    "latest_month_items",
    "user_consumption_profile",
    "view_growth",
    "trending_products",
    "top_trending",
    "product_similarity",
    "baskets",
    "copurchase_rules",
    "product_complementary",
    "consumption_base",
    "sliding_user_interest",
    "upsert_realtime_view",
    "serve_trending",
    "serve_realtime_recommendations",
    "trend_history",
    "product_counts",
]


@pytest.fixture(scope="module")
def plan(spark):
    made = {}

    def of(name):
        if name not in made:
            made[name] = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        return made[name]

    return of


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_python(plan, name):
    text = plan(name)
    for word in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "MapElements"):
        assert word not in text


def scans(text, table):
    """Columns read per scan of a table."""
    found = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table + r"\.parquet", text)
    return [{c.split("#")[0] for c in columns.split(",") if c} for columns in found]


def test_only_needed_columns_are_read(plan):
    assert scans(plan("trending_products"), "lineitem") == [{"l_orderkey", "l_partkey", "l_quantity"}]
    assert scans(plan("product_counts"), "lineitem") == [{"l_partkey"}]
    assert scans(plan("trending_products"), "orders") == [{"o_orderkey", "o_orderdate"}]


def test_filters_reach_the_scans(plan):
    text = plan("trending_products")
    assert "EqualTo(event_type,view)" in text
    assert "GreaterThanOrEqual(o_orderdate,2001-07-18" in text
    assert "EqualTo(o_orderstatus,F)" in plan("latest_month_items")


def test_rankings_are_cut_before_the_shuffle(plan):
    for name in ("product_similarity", "serve_realtime_recommendations"):
        assert "WindowGroupLimit" in plan(name)


def test_top_lists_are_not_sorted_whole(plan):
    for name in ("top_trending", "serve_trending"):
        assert "TakeOrderedAndProject" in plan(name)
