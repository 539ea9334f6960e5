from datetime import date, datetime, timedelta

import pytest

from shoptide.operators.trending import order_growth, trending_products, view_growth

TODAY = datetime(2025, 11, 14, 23, 18)

EVENTS = "product_id string, event_type string, event_timestamp timestamp"
ORDERS = "order_id string, order_status string, order_date timestamp"
ITEMS = "order_id string, product_id string, quantity int"


def ago(days):
    return datetime(2025, 11, 14, 12) - timedelta(days=days)


def views(spark, rows):
    return spark.createDataFrame([(p, kind, ago(d)) for p, kind, d in rows], EVENTS)


def orders(spark, rows):
    return spark.createDataFrame([(o, status, ago(d)) for o, status, d in rows], ORDERS)


def by_product(frame):
    return {r["product_id"]: r for r in frame.collect()}


def test_buckets_include_both_ends_and_skip_the_future(spark):
    events = views(spark, [("A", "view", d) for d in (-1, 0, 7, 8, 14, 15)] + [("A", "cart", 0)])
    row = by_product(view_growth(events, TODAY))["A"]
    assert (row["current_views"], row["previous_views"], row["view_growth"]) == (2, 2, 0.0)


def test_order_growth_counts_every_status(spark):
    found = order_growth(
        orders(spark, [("1", "completed", 0), ("2", "cancelled", 3)]),
        spark.createDataFrame([("1", "A", 2), ("2", "A", 3)], ITEMS),
        TODAY,
    )
    row = by_product(found)["A"]
    assert (row["current_orders"], row["previous_orders"], row["order_growth"]) == (5, 0, 5.0)


def test_scores_match_published_rows(spark):
    """(views, orders) of the current days -> score, from rows with known growth."""
    events = views(spark, [("B", "view", 1)])
    sold = orders(spark, [("1", "shipped", 0)])
    items = spark.createDataFrame([("1", "A", 6), ("1", "B", 5), ("1", "C", 5)], ITEMS)
    found = by_product(trending_products(events, sold, items, TODAY))
    assert found["A"]["trend_score"] == pytest.approx(94.8)
    assert found["B"]["trend_score"] == pytest.approx(84.2)
    assert found["C"]["trend_score"] == pytest.approx(79.0)
    assert found["A"]["trend_window"] == "7d"
    assert found["A"]["trend_date"] == 1763162280000


def test_products_from_either_side_and_only_positive_scores(spark):
    events = views(spark, [("seen", "view", 0), ("old", "view", 10), ("ancient", "view", 40)])
    sold = orders(spark, [("1", "completed", 1), ("2", "completed", 100)])
    items = spark.createDataFrame([("1", "sold", 1), ("2", "long ago", 1)], ITEMS)
    assert set(by_product(trending_products(events, sold, items, TODAY))) == {"seen", "sold"}


def test_no_events_at_all(spark):
    sold = orders(spark, [("1", "completed", 1)])
    items = spark.createDataFrame([("1", "A", 1)], ITEMS)
    found = by_product(trending_products(views(spark, []), sold, items, TODAY))
    assert found["A"]["view_growth"] == 0.0


def test_date_filter_reaches_the_scan(spark, tmp_path):
    orders(spark, [("1", "completed", 1)]).write.parquet(str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    items = spark.createDataFrame([("1", "A", 1)], ITEMS)
    plan = trending_products(views(spark, []), stored, items, date(2025, 11, 14))._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(order_date" in plan
