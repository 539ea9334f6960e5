"""Score formulas as column expressions. The weights are fixed values of the views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

TREND_WEIGHTS = (0.2, 0.8, 5.0, 15.0)
REALTIME_WEIGHTS = (0.2, 0.5, 1.0)
BLEND_WEIGHTS = (0.5, 0.5)
TYPE_PRIORITY = {"consumption": 1.0, "similar": 0.8, "complementary": 0.7}
OTHER_PRIORITY = 0.3
TREND_SCALE = 100


def growth(current: Column, previous: Column) -> Column:
    return (current - previous) / (previous + 1)


def trend_score(views: Column, orders: Column, view_growth: Column, order_growth: Column, weights) -> Column:
    by_views, by_orders, by_view_growth, by_order_growth = (F.lit(float(w)) for w in weights)
    level = views * by_views + orders * by_orders
    return level + (view_growth * by_view_growth + order_growth * by_order_growth)


def price_similarity(price: Column, other: Column, price_range: Column) -> Column:
    """Half for the shared category, half for nearness of price."""
    return F.lit(0.5) + F.lit(0.5) * (F.lit(1.0) - F.abs(price - other) / price_range)


def complementary_score(confidence: Column, lift: Column) -> Column:
    return F.round(confidence * 0.7 + (lift / 10) * 0.3, 2)


def realtime_score(views: Column, carts: Column, purchases: Column, weights=REALTIME_WEIGHTS) -> Column:
    by_view, by_cart, by_purchase = (F.lit(float(w)) for w in weights)
    return views * by_view + carts * by_cart + purchases * by_purchase


def priority_of(kind: Column, priority: Mapping[str, float] = TYPE_PRIORITY, other: float = OTHER_PRIORITY) -> Column:
    chosen = None
    for name, value in priority.items():
        hit, value = kind == name, F.lit(float(value))
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return F.lit(float(other)) if chosen is None else chosen.otherwise(F.lit(float(other)))


def final_score(priority: Column, score: Column, trend: Column, weights=BLEND_WEIGHTS) -> Column:
    """Blend of the link's score and the product's trend; a product without a trend counts as 0."""
    by_link, by_trend = (F.lit(float(w)) for w in weights)
    return by_link * priority * score + by_trend * (F.coalesce(trend, F.lit(0.0)) / TREND_SCALE)
