"""What each user spends, and what they bought in their latest month."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions.spread import hot_keys, spread_join
from shoptide.operators.segments import COMPLETED

# Money is summed as a decimal: a sum of doubles depends on the order of the rows.
MONEY = "decimal(18,2)"


def _completed(orders: DataFrame, completed: Collection[str]) -> DataFrame:
    return orders.filter(F.col("order_status").isin(*completed)).select(
        "user_id",
        "order_id",
        F.date_format(F.col("order_date").try_cast("timestamp"), "yyyy-MM").alias("year_month"),
        F.col("total_amount").cast(MONEY).alias("_amount"),
    )


def _by_month(orders: DataFrame, completed: Collection[str]) -> DataFrame:
    return (
        _completed(orders, completed)
        .groupBy("user_id", "year_month")
        .agg(F.sum("_amount").alias("_spent"), F.count("_amount").alias("_paid"), F.count("*").alias("n"))
    )


def _latest() -> Column:
    # a maximum instead of a ranking: it is combined before the shuffle
    return F.max(F.struct("year_month", "_spent")).alias("_latest")


def avg_order_value(orders: DataFrame, completed: Collection[str] = COMPLETED) -> DataFrame:
    amount = F.col("_amount")
    return (
        _completed(orders, completed)
        .groupBy("user_id")
        .agg(F.try_divide(F.sum(amount).cast("double"), F.count(amount)).alias("avg_order_value"))
    )


def monthly_spending(orders: DataFrame, completed: Collection[str] = COMPLETED) -> DataFrame:
    spent = F.col("_spent").cast("double").alias("monthly_spending")
    return _by_month(orders, completed).select("user_id", "year_month", spent)


def latest_month_spending(orders: DataFrame, completed: Collection[str] = COMPLETED) -> DataFrame:
    """Per user, the last month with a completed order and what was spent in it."""
    months = _by_month(orders, completed)
    return (
        months.groupBy("user_id")
        .agg(_latest())
        .select(
            "user_id",
            F.col("_latest.year_month").alias("year_month"),
            F.col("_latest._spent").cast("double").alias("monthly_spending"),
        )
    )


def _described(lines: DataFrame, products: DataFrame) -> DataFrame:
    attributes = products.select("product_id", "product_name", "category", "price")
    return lines.join(attributes, "product_id", "left").select(
        "user_id",
        "order_id",
        "product_id",
        F.coalesce("product_name", F.lit("unknown")).alias("product_name"),
        F.coalesce("category", F.lit("unknown")).alias("category"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
    )


def in_latest_month(rows: DataFrame, months: DataFrame) -> DataFrame:
    """Those of ``rows`` (user_id, year_month, ...) that are of their user's latest month in ``months``."""
    latest = months.groupBy("user_id").agg(F.max("year_month").alias("year_month"))
    # the monthly counts already tell which (user, month) is hot
    month = ["user_id", "year_month"]
    return spread_join(rows, latest, month, hot_keys(months, month), "left_semi")


def latest_month_items(
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    completed: Collection[str] = COMPLETED,
    months: DataFrame | None = None,
) -> DataFrame:
    """Line items of the completed orders of each user's latest month, with product attributes.

    A line counts only if its user is the order's user (where lines carry a user at all).
    ``months`` may hand in the monthly totals if they have been computed before.
    """
    months = _by_month(orders, completed) if months is None else months
    recent = in_latest_month(_completed(orders, completed).select("user_id", "order_id", "year_month"), months)
    line_key = _line_key(order_items)
    lines = order_items.select(*line_key, "product_id").join(recent.select("user_id", "order_id"), line_key)
    return _described(lines, products)


def _line_key(order_items: DataFrame) -> list[str]:
    return ["order_id", "user_id"] if "user_id" in order_items.columns else ["order_id"]


def month_totals(orders: DataFrame, completed: Collection[str] = COMPLETED) -> DataFrame:
    """(user_id, year_month, _spent, _paid, n): what a user's month adds to the profile. Months are independent of each other."""
    return _by_month(orders, completed)


def month_lines(orders: DataFrame, order_items: DataFrame, completed: Collection[str] = COMPLETED) -> DataFrame:
    """(user_id, order_id, year_month, product_id) of the lines of completed orders."""
    line_key = _line_key(order_items)
    bought = _completed(orders, completed).select("user_id", "order_id", "year_month")
    return order_items.select(*line_key, "product_id").join(bought, line_key).select("user_id", "order_id", "year_month", "product_id")


def profile_of_months(users: DataFrame, months: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """The profile from ``month_totals`` and ``month_lines`` of all months."""
    return _profile(users, months, _described(in_latest_month(lines, months), products))


def user_consumption_profile(
    users: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    products: DataFrame,
    completed: Collection[str] = COMPLETED,
    settle=lambda months: months,
) -> DataFrame:
    """One row per user: averages, latest month's spending and four aligned lists of its products.

    The lists are as long as the user's month: the view itself asks for them on one row.
    ``settle`` may materialise the monthly totals, which are far fewer than the orders and read often.
    """
    months = settle(_by_month(orders, completed))
    return _profile(users, months, latest_month_items(orders, order_items, products, completed, months))


def _profile(users: DataFrame, months: DataFrame, lines: DataFrame) -> DataFrame:
    spending = (
        months.groupBy("user_id")
        .agg(F.try_divide(F.sum("_spent").cast("double"), F.sum("_paid")).alias("avg_order_value"), _latest())
        .select(
            "user_id",
            "avg_order_value",
            F.col("_latest._spent").cast("double").alias("monthly_spending"),
        )
    )
    line = F.struct("product_id", "product_name", "category", "price")
    lists = lines.groupBy("user_id").agg(F.sort_array(F.collect_list(line)).alias("_lines"))
    return (
        users.select("user_id")
        .join(spending, "user_id", "left")
        .join(lists, "user_id", "left")
        .select(
            "user_id",
            F.coalesce("avg_order_value", F.lit(0.0)).alias("avg_order_value"),
            F.coalesce("monthly_spending", F.lit(0.0)).alias("monthly_spending"),
            F.col("_lines.product_id").alias("product_ids_in_latest_month"),
            F.col("_lines.product_name").alias("products_in_latest_month"),
            F.col("_lines.category").alias("categories_in_latest_month"),
            F.col("_lines.price").alias("product_prices_in_latest_month"),
        )
    )
