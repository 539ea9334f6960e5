import random
from datetime import date, datetime, timedelta

import pytest

from shoptide.operators.consumption import user_consumption_profile
from shoptide.operators.trending import trending_products
from shoptide.plans import daily
from shoptide.plans.daily import daily_profile, daily_trending, run_daily, update_partials
from shoptide.sources.commits import Commits
from shoptide.sources.partials import UNDATED, kept_periods, read_partials, refresh, within_periods

ORDERS = "order_id string, user_id string, order_date timestamp, order_status string, total_amount double"
ITEMS = "order_id string, user_id string, product_id string, quantity int"
PRODUCTS = "product_id string, product_name string, category string, price double"
EVENTS = "product_id string, event_type string, event_timestamp timestamp"
AS_OF = date(2025, 10, 20)


class Shop:
    """Tables as lists of rows, to which rows are added day by day."""

    def __init__(self, spark):
        self.spark = spark
        self.orders, self.items, self.events = [], [], []
        self.users = spark.createDataFrame([(f"u{k}",) for k in range(6)], "user_id string")
        rows = [(f"P{k}", f"name {k}", "Toys" if k % 2 else None, 1.5 * k) for k in range(5)]
        self.products = spark.createDataFrame(rows, PRODUCTS)

    def frames(self, orders=None, items=None, events=None):
        make = self.spark.createDataFrame
        return {
            "users": self.users,
            "products": self.products,
            "orders": make(self.orders if orders is None else orders, ORDERS),
            "order_items": make(self.items if items is None else items, ITEMS),
            "events": make(self.events if events is None else events, EVENTS),
        }


def listed(frame):
    return sorted((tuple(map(str, row)) for row in frame.collect()))


def assert_equals_full_run(shop, store):
    t = shop.frames()
    full = user_consumption_profile(t["users"], t["orders"], t["order_items"], t["products"])
    assert listed(daily_profile(t["users"], t["products"], store)) == listed(full)
    trends = trending_products(t["events"], t["orders"], t["order_items"], AS_OF)
    assert listed(daily_trending(shop.spark, store, AS_OF)) == listed(trends)


def manifest(spark, store, name):
    return Commits(spark, f"{store}/{name}").latest()[1]["periods"]


def test_late_changed_and_undated_rows(spark, tmp_path):
    shop, store = Shop(spark), str(tmp_path)
    shop.orders = [
        ("o1", "u1", datetime(2025, 8, 3), "completed", 10.0),
        ("o2", "u1", datetime(2025, 10, 9), "completed", 20.1),
        ("o3", "u2", datetime(2025, 9, 30, 23, 59), "cancelled", 30.2),
        ("o4", "u3", None, "completed", 4.0),
        ("o5", None, datetime(2025, 9, 2), "completed", 5.0),
    ]
    shop.items = [("o1", "u1", "P1", 1), ("o2", "u1", "P2", 2), ("o2", "someone", "P3", 1), ("o3", "u2", "P3", 5), ("o4", "u3", "P4", 1), ("o5", None, "P4", 1)]
    shop.events = [("P1", "view", datetime(2025, 10, 19)), ("P1", "cart", datetime(2025, 10, 19)), ("P2", "view", datetime(2025, 10, 8)), ("P2", "view", None)]
    run_daily(shop.frames(), store, AS_OF)
    assert_equals_full_run(shop, store)
    assert kept_periods(spark, f"{store}/month_totals") == ["2025-08", "2025-09", "2025-10", UNDATED]
    before = {name: manifest(spark, store, name) for name in daily.STORES}

    # a late order of August, a September order whose status changes, a late line, an undated order, late and new views
    late = [("o6", "u4", datetime(2025, 8, 30), "completed", 7.5), ("o3", "u2", datetime(2025, 9, 30, 23, 59), "completed", 30.2), ("o7", "u5", None, "completed", 1.0)]
    late_items = [("o6", "u4", "P1", 3), ("o5", None, "P2", 9)]
    late_events = [("P3", "view", datetime(2025, 10, 19, 5)), ("P4", "view", datetime(2025, 10, 20))]
    shop.orders = [o for o in shop.orders if o[0] != "o3"] + late
    shop.items += late_items
    shop.events += late_events
    run_daily(shop.frames(), store, AS_OF, shop.frames(late, late_items, late_events))
    assert_equals_full_run(shop, store)
    after = {name: manifest(spark, store, name) for name in daily.STORES}
    # what did not change is the same folder as before
    changed = {n: {p for p in after[n] if after[n][p] != before[n].get(p)} for n in daily.STORES}
    assert changed["month_totals"] == {"2025-08", "2025-09", UNDATED}
    assert changed["month_lines"] == {"2025-08", "2025-09", UNDATED}
    assert changed["day_sales"] == {"2025-08-30", "2025-09-02", "2025-09-30", UNDATED}
    assert changed["day_views"] == {"2025-10-19", "2025-10-20"}


def test_many_days_equal_one_run(spark, tmp_path):
    rng, shop, store = random.Random(5), Shop(spark), str(tmp_path)
    for day in range(4):
        orders, items, events = [], [], []
        for k in range(12):
            order, user = f"o{day}-{k}", f"u{rng.randrange(5)}"
            moment = datetime(2025, 10, 14 + day, rng.randrange(24)) - timedelta(days=rng.choice([0, 0, 0, 9, 40]))
            orders.append((order, user, moment, rng.choice(["completed", "completed", "cancelled"]), rng.randrange(999) / 100))
            items += [(order, user, f"P{rng.randrange(6)}", rng.randrange(1, 4)) for _ in range(rng.randrange(3))]
            events.append((f"P{rng.randrange(5)}", rng.choice(["view", "cart"]), moment))
        shop.orders, shop.items, shop.events = shop.orders + orders, shop.items + items, shop.events + events
        update_partials(shop.frames(), store, day + 1, shop.frames(orders, items, events))
    assert_equals_full_run(shop, store)


def test_a_period_that_empties_and_empty_tables(spark, tmp_path):
    shop, store = Shop(spark), str(tmp_path)
    update_partials(shop.frames(), store, 1)
    assert_equals_full_run(shop, store)
    order = ("o1", "u1", datetime(2025, 10, 3), "completed", 10.0)
    shop.orders, shop.items = [order], [("o1", "u1", "P1", 1)]
    update_partials(shop.frames(), store, 2, shop.frames(events=[]))
    assert_equals_full_run(shop, store)
    shop.orders, shop.items = [], []
    update_partials(shop.frames(), store, 3, shop.frames([order], [], []))
    assert_equals_full_run(shop, store)
    assert kept_periods(spark, f"{store}/month_totals") == []


def test_a_failed_run_leaves_the_last_state_and_can_be_repeated(spark, tmp_path):
    store = f"{tmp_path}/s"

    def rows(*found):
        return lambda: spark.createDataFrame(list(found), "period string, user_id string, n long")

    refresh(spark, store, 1, None, rows(("2025-01", "a", 1), ("2025-02", "a", 2)), "period", "user_id")

    def lost():
        return rows(("2025-02", "a", 9))().selectExpr("period", "user_id", "if(n = 9, raise_error('lost'), n) as n")

    with pytest.raises(Exception, match="lost"):
        refresh(spark, store, 2, ["2025-02"], lost, "period", "user_id")
    assert sorted(read_partials(spark, store).collect()) == [("2025-01", "a", 1), ("2025-02", "a", 2)]
    for _ in range(2):
        # rows of a month that is not named are not taken
        refresh(spark, store, 2, ["2025-02"], rows(("2025-02", "a", 7), ("2025-01", "a", 7)), "period", "user_id")
    assert sorted(read_partials(spark, store).collect()) == [("2025-01", "a", 1), ("2025-02", "a", 7)]
    assert read_partials(spark, store, "2025-02", "2025-02").count() == 1
    assert read_partials(spark, store, "2026-01").count() == 0
    assert len([p for p in tmp_path.glob("s/p*") if p.is_dir()]) <= 3
    with pytest.raises(ValueError):
        read_partials(spark, f"{tmp_path}/nothing")


def test_only_changed_periods_are_scanned(spark, tmp_path):
    from pyspark.sql import functions as F

    spark.createDataFrame([("o1", datetime(2025, 10, 3))], "order_id string, order_date timestamp").write.parquet(f"{tmp_path}/orders")
    orders = spark.read.parquet(f"{tmp_path}/orders")
    names = ["2025-10-02", "2025-10-03", "2024-12-31", "2025-01-01", "2025-12"]
    chosen = orders.filter(within_periods(F.col("order_date"), names))
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = chosen._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(order_date,2024-12-31" in pushed
    # neighbours are one range
    assert pushed.count("GreaterThanOrEqual") == 3
    assert chosen.count() == 1
    assert orders.filter(within_periods(F.col("order_date"), [UNDATED])).count() == 0


def test_many_scattered_periods_make_few_ranges(spark):
    from pyspark.sql import functions as F

    first = date(2001, 1, 1)
    names = [(first + timedelta(days=k * k)).isoformat() for k in range(100)]
    days = spark.range(99 * 99 + 1).select(F.timestamp_add("DAY", F.col("id").cast("int"), F.lit(datetime(2001, 1, 1))).alias("moment"))
    chosen = days.filter(within_periods(F.col("moment"), names))
    found = {row[0] for row in chosen.select(F.date_format("moment", "yyyy-MM-dd")).collect()}
    assert set(names) <= found
    # the 37 early days, which stand closest, share a range
    assert len(found) == 63 + 36 * 36 + 1
    assert days.filter(within_periods(F.col("moment"), [])).count() == 0
    assert days.filter(within_periods(F.col("moment"), ["2001-12"])).count() == 31
