"""The daily run of the profile and the trends from partials by day and month.

Four stores are kept: a user's totals of a month, the lines of a month's completed orders, views and quantities per product of a day. A run recomputes
the periods that the arrived rows lie in - late orders open their month and their day again, and nothing else - and combines all periods
of the stores. Recomputing a period whole, instead of adding to it, makes changed and repeated rows come out right as well.

What a run reads: of orders and events the changed periods, by a range on their date that reaches the scan; of the order lines those
periods too where lines carry ``order_date``, else all of their three columns; of the stores every month for the profile
(a user's latest month may be long ago) and fifteen days for the trends. Orders and lines are joined for changed periods only.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.functions.clock import day_of, epoch_ms
from shoptide.operators.consumption import month_lines, month_totals, profile_of_months
from shoptide.operators.segments import COMPLETED
from shoptide.operators.trending import CURRENT, PREVIOUS, day_sales, day_views, trending_of_days
from shoptide.plans.settle import side_by_side
from shoptide.sources.partials import DAY, MONTH, UNDATED, kept_periods, periods_in, read_partials, refresh, within_periods

STORES = ("month_totals", "month_lines", "day_sales", "day_views")


def changed_orders(arrivals: Mapping[str, DataFrame], orders: DataFrame) -> DataFrame | None:
    """(order_date) of the orders that arrived and of the orders whose lines arrived; None if everything counts as changed."""
    dates = []
    if "orders" in arrivals:
        dates.append(arrivals["orders"].select("order_date"))
    if "order_items" in arrivals:
        late = arrivals["order_items"].select("order_id").distinct()
        dates.append(orders.join(late, "order_id", "left_semi").select("order_date"))
    if not dates:
        return orders.select("order_date").filter(F.lit(False))
    return dates[0] if len(dates) == 1 else dates[0].unionByName(dates[1])


def update_partials(
    inputs: Mapping[str, DataFrame],
    store: str,
    version: int,
    arrivals: Mapping[str, DataFrame] | None = None,
    completed: Collection[str] = COMPLETED,
) -> None:
    """Bring the four stores up to date with ``inputs``.

    ``arrivals`` holds the rows of orders, order_items and events that are new or changed since the last run; ``inputs`` holds them too. An order that moves
    to another date must be among them with both dates. None, or a store that has no commit yet, recomputes everything.
    """
    orders, items, events = inputs["orders"], inputs["order_items"], inputs["events"]
    spark = orders.sparkSession
    whole = arrivals is None or any(kept_periods(spark, f"{store}/{name}") is None for name in STORES)
    months = days = seen = None
    if not whole:
        moments = changed_orders(arrivals, orders)
        days = periods_in(moments, DAY)
        # a month's days tell the month
        months = sorted({day if day == UNDATED else day[: len("yyyy-mm")] for day in days})
        seen = periods_in(arrivals["events"].select("event_timestamp"), DAY) if "events" in arrivals else []

    def of_periods(table: DataFrame, column: str, names: list[str] | None) -> DataFrame:
        return table.filter(within_periods(F.col(column), names)) if column in table.columns else table

    def named(rows: DataFrame, column: str) -> DataFrame:
        return rows.withColumn("period", F.coalesce(F.col(column).cast("string"), F.lit(UNDATED)))

    def totals() -> None:
        compute = lambda: named(month_totals(of_periods(orders, "order_date", months), completed), "year_month")
        refresh(spark, f"{store}/month_totals", version, months, compute, "period", "user_id")

    def lines() -> None:
        bought = lambda: month_lines(of_periods(orders, "order_date", months), of_periods(items, "order_date", months), completed)
        refresh(spark, f"{store}/month_lines", version, months, lambda: named(bought(), "year_month"), "period", "user_id")

    def sales() -> None:
        sold = lambda: day_sales(of_periods(orders, "order_date", days), of_periods(items, "order_date", days))
        refresh(spark, f"{store}/day_sales", version, days, lambda: named(sold(), "day"), "period", "product_id")

    def views() -> None:
        viewed = lambda: day_views(of_periods(events, "event_timestamp", seen))
        refresh(spark, f"{store}/day_views", version, seen, lambda: named(viewed(), "day"), "period", "product_id")

    side_by_side(totals, lines, sales, views)


def daily_profile(users: DataFrame, products: DataFrame, store: str) -> DataFrame:
    """``user_consumption_profile`` from the kept months."""
    spark = users.sparkSession
    months = read_partials(spark, f"{store}/month_totals").drop("period")
    return profile_of_months(users, months, read_partials(spark, f"{store}/month_lines").drop("period"), products)


def daily_trending(
    spark,
    store: str,
    as_of: date | datetime,
    current: tuple[int, int] = CURRENT,
    previous: tuple[int, int] = PREVIOUS,
    orders_as_of: date | datetime | None = None,
    **options,
) -> DataFrame:
    """``trending_products`` from the kept days of both buckets."""
    oldest = max(*current, *previous)

    def days(name: str, today: date | datetime) -> DataFrame:
        last = day_of(today)
        return read_partials(spark, f"{store}/{name}", (last - timedelta(days=oldest)).isoformat(), last.isoformat()).drop("period")

    sales = days("day_sales", orders_as_of or as_of)
    return trending_of_days(days("day_views", as_of), sales, as_of, current=current, previous=previous, orders_as_of=orders_as_of, **options)


def run_daily(
    inputs: Mapping[str, DataFrame],
    store: str,
    as_of: date | datetime,
    arrivals: Mapping[str, DataFrame] | None = None,
    completed: Collection[str] = COMPLETED,
    **trending,
) -> tuple[DataFrame, DataFrame]:
    """Update the stores for ``as_of`` and return the profile and the trending products that follow from them."""
    update_partials(inputs, store, epoch_ms(as_of), arrivals, completed)
    profile = daily_profile(inputs["users"], inputs["products"], store)
    return profile, daily_trending(inputs["orders"].sparkSession, store, as_of, **trending)
