"""Products that move: views and orders of the current days against the days before."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions.clock import days_ago, epoch_ms, within_days
from shoptide.functions.scoring import TREND_WEIGHTS, growth, trend_score

# Days ago, both ends included.
CURRENT = (0, 7)
PREVIOUS = (8, 14)


def _sum_within(age: Column, bucket: tuple[int, int], amount: Column) -> Column:
    return F.sum(F.when(age.between(*bucket), amount).otherwise(F.lit(0)))


def view_growth(
    events: DataFrame,
    as_of: date | datetime,
    current: tuple[int, int] = CURRENT,
    previous: tuple[int, int] = PREVIOUS,
) -> DataFrame:
    """Views per product in the two buckets, and their growth."""
    age = days_ago(as_of, F.col("event_timestamp"))
    return (
        events.filter(F.col("event_type") == "view")
        .groupBy("product_id")
        .agg(
            _sum_within(age, current, F.lit(1)).alias("current_views"),
            _sum_within(age, previous, F.lit(1)).alias("previous_views"),
        )
        .withColumn("view_growth", growth(F.col("current_views"), F.col("previous_views")))
    )


def order_growth(
    orders: DataFrame,
    order_items: DataFrame,
    as_of: date | datetime,
    current: tuple[int, int] = CURRENT,
    previous: tuple[int, int] = PREVIOUS,
) -> DataFrame:
    """Quantity ordered per product in the two buckets, whatever became of the order, and its growth."""
    # lines of one order share its age, so only that goes through the join
    ages = orders.select("order_id", days_ago(as_of, F.col("order_date")).alias("_age"))
    age, quantity = F.col("_age"), F.col("quantity")
    return (
        order_items.select("order_id", "product_id", "quantity")
        .join(ages, "order_id")
        .groupBy("product_id")
        .agg(
            _sum_within(age, current, quantity).alias("current_orders"),
            _sum_within(age, previous, quantity).alias("previous_orders"),
        )
        .withColumn("order_growth", growth(F.col("current_orders"), F.col("previous_orders")))
    )


def trending_products(
    events: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    as_of: date | datetime,
    weights: tuple[float, float, float, float] = TREND_WEIGHTS,
    window_label: str = "7d",
    current: tuple[int, int] = CURRENT,
    previous: tuple[int, int] = PREVIOUS,
    orders_as_of: date | datetime | None = None,
) -> DataFrame:
    """Products with a positive trend score. ``orders_as_of`` is for orders kept on another clock.

    A product with nothing in either bucket scores 0 and is left out, just as if it had no rows;
    so only the days of the buckets are read, and the joins see a few days of orders, not all.
    """
    oldest = max(*current, *previous)
    orders_as_of = orders_as_of or as_of
    recent_events = events.filter(within_days(as_of, F.col("event_timestamp"), oldest))
    recent_orders = orders.filter(within_days(orders_as_of, F.col("order_date"), oldest))
    views = view_growth(recent_events, as_of, current, previous)
    sold = order_growth(recent_orders, order_items, orders_as_of, current, previous)
    return scored(views, sold, as_of, weights, window_label)


def day_views(events: DataFrame) -> DataFrame:
    """(day, product_id, amount): views of a day."""
    seen = events.filter(F.col("event_type") == "view")
    return seen.groupBy(F.to_date("event_timestamp").alias("day"), "product_id").agg(F.count("*").alias("amount"))


def day_sales(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """(day, product_id, amount): quantity ordered on a day, whatever became of the order."""
    days = orders.select("order_id", F.to_date("order_date").alias("day"))
    lines = order_items.select("order_id", "product_id", "quantity").join(days, "order_id")
    return lines.groupBy("day", "product_id").agg(F.sum("quantity").alias("amount"))


def trending_of_days(
    views: DataFrame,
    sales: DataFrame,
    as_of: date | datetime,
    weights: tuple[float, float, float, float] = TREND_WEIGHTS,
    window_label: str = "7d",
    current: tuple[int, int] = CURRENT,
    previous: tuple[int, int] = PREVIOUS,
    orders_as_of: date | datetime | None = None,
) -> DataFrame:
    """The trending products from ``day_views`` and ``day_sales`` of the days of both buckets."""

    def grown(days: DataFrame, today: date | datetime, what: str) -> DataFrame:
        age, now, before = days_ago(today, F.col("day")), f"current_{what}s", f"previous_{what}s"
        amounts = days.groupBy("product_id").agg(
            _sum_within(age, current, F.col("amount")).alias(now), _sum_within(age, previous, F.col("amount")).alias(before)
        )
        return amounts.withColumn(f"{what}_growth", growth(F.col(now), F.col(before)))

    return scored(grown(views, as_of, "view"), grown(sales, orders_as_of or as_of, "order"), as_of, weights, window_label)


def scored(
    views: DataFrame, sold: DataFrame, as_of: date | datetime, weights: tuple[float, float, float, float], window_label: str
) -> DataFrame:
    """Products with a positive score, from the growth of their views and of their orders."""

    def filled(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    score = trend_score(
        filled("current_views"), filled("current_orders"), filled("view_growth"), filled("order_growth"), weights
    )
    return (
        views.join(sold, "product_id", "full_outer")
        .select(
            "product_id",
            score.alias("trend_score"),
            filled("view_growth").cast("double").alias("view_growth"),
            filled("order_growth").cast("double").alias("order_growth"),
            F.lit(window_label).alias("trend_window"),
            F.lit(epoch_ms(as_of)).cast("long").alias("trend_date"),
        )
        .filter(F.col("trend_score") > 0)
    )
