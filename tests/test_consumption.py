from datetime import datetime

import pytest

from shoptide.functions import spread
from shoptide.operators import consumption
from shoptide.operators.consumption import (
    avg_order_value,
    latest_month_items,
    latest_month_spending,
    monthly_spending,
    user_consumption_profile,
)

ORDERS = "order_id string, user_id string, order_date timestamp, order_status string, total_amount double"
ITEMS = "order_id string, user_id string, product_id string, quantity int"
PRODUCTS = "product_id string, product_name string, category string, price double"


@pytest.fixture(scope="module")
def shop(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "u1", datetime(2025, 8, 3), "completed", 10.0),
            ("o2", "u1", datetime(2025, 9, 9), "completed", 20.1),
            ("o3", "u1", datetime(2025, 9, 30, 23, 59), "completed", 30.2),
            ("o4", "u1", datetime(2025, 10, 1), "cancelled", 500.0),
            ("o5", "u2", datetime(2025, 10, 1), "returned", 500.0),
        ],
        ORDERS,
    )
    items = spark.createDataFrame(
        [
            ("o1", "u1", "P9", 1),
            ("o2", "u1", "P2", 1),
            ("o2", "u1", "P1", 1),
            ("o3", "u1", "P1", 2),
            ("o3", "u1", "PX", 1),
            ("o3", "someone else", "P3", 1),
            ("o4", "u1", "P3", 1),
            ("o5", "u2", "P3", 1),
        ],
        ITEMS,
    )
    products = spark.createDataFrame(
        [("P1", "one", "Toys", 1.5), ("P2", "two", "Books", 2.5), ("P3", "three", "Toys", 3.5), ("P9", "nine", None, 9.0)],
        PRODUCTS,
    )
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "user_id string")
    return users, orders, items, products


def test_spending(shop):
    _, orders, _, _ = shop
    assert avg_order_value(orders).collect() == [("u1", 60.3 / 3)]
    assert sorted(monthly_spending(orders).collect()) == [("u1", "2025-08", 10.0), ("u1", "2025-09", 50.3)]
    assert latest_month_spending(orders).collect() == [("u1", "2025-09", 50.3)]


def test_items_of_latest_completed_month(shop):
    _, orders, items, products = shop
    found = sorted((r["order_id"], r["product_id"], r["category"]) for r in latest_month_items(orders, items, products).collect())
    assert found == [("o2", "P1", "Toys"), ("o2", "P2", "Books"), ("o3", "P1", "Toys"), ("o3", "PX", "unknown")]
    # lines without a user go by the order alone
    assert latest_month_items(orders, items.drop("user_id"), products).count() == 5


def test_profile(shop):
    found = {r["user_id"]: r for r in user_consumption_profile(*shop).collect()}
    assert set(found) == {"u1", "u2", "u3"}
    one = found["u1"]
    assert one["product_ids_in_latest_month"] == ["P1", "P1", "P2", "PX"]
    assert one["products_in_latest_month"] == ["one", "one", "two", "unknown"]
    assert one["categories_in_latest_month"] == ["Toys", "Toys", "Books", "unknown"]
    assert one["product_prices_in_latest_month"] == [1.5, 1.5, 2.5, 0.0]
    assert one["monthly_spending"] == 50.3
    for user in ("u2", "u3"):
        assert found[user]["avg_order_value"] == 0.0 and found[user]["monthly_spending"] == 0.0
        assert found[user]["product_ids_in_latest_month"] is None


def test_one_user_with_most_of_the_rows(spark, monkeypatch):
    """The hot user's month is cut into slots; they still have one row, and nothing is lost."""
    monkeypatch.setattr(consumption, "hot_keys", lambda c, k: spread.hot_keys(c, k, min_rows=20))
    day = datetime(2025, 9, 9)
    orders = spark.createDataFrame(
        [(f"h{i}", "hot", day, "completed", 1.0) for i in range(300)]
        + [(f"c{i}", f"u{i % 50}", day, "completed", 1.0) for i in range(200)],
        ORDERS,
    )
    lines = [(f"h{i}", "hot", f"P{i % 7}", 1) for i in range(300)] + [(f"c{i}", f"u{i % 50}", "P1", 1) for i in range(200)]
    items = spark.createDataFrame(lines, ITEMS).repartition(4)
    users = spark.createDataFrame([("hot",)] + [(f"u{i}",) for i in range(50)], "user_id string")
    products = spark.createDataFrame([(f"P{i}", "p", "c", 1.0) for i in range(7)], PRODUCTS)
    rows = user_consumption_profile(users, orders, items, products).collect()
    (hot,) = [r for r in rows if r["user_id"] == "hot"]
    assert hot["product_ids_in_latest_month"] == sorted(f"P{i % 7}" for i in range(300))
    assert hot["monthly_spending"] == 300.0
    others = [r for r in rows if r["user_id"] != "hot"]
    assert len(others) == 50 and all(len(r["product_ids_in_latest_month"]) == 4 for r in others)


def test_orders_without_an_amount(spark):
    orders = spark.createDataFrame([("o1", "u1", datetime(2025, 8, 3), "completed", None)], ORDERS)
    items = spark.createDataFrame([("o1", "u1", "P1", 1)], ITEMS)
    products = spark.createDataFrame([], PRODUCTS)
    users = spark.createDataFrame([("u1",)], "user_id string")
    row = user_consumption_profile(users, orders, items, products).first()
    assert (row["avg_order_value"], row["monthly_spending"]) == (0.0, 0.0)
    assert row["product_ids_in_latest_month"] == ["P1"]
