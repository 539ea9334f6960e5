"""Interest of users in products over a sliding window. The same code runs on batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions.scoring import REALTIME_WEIGHTS, realtime_score

WINDOW = "5 minutes"
SLIDE = "1 minute"
WATERMARK = "10 minutes"

# Window length minus slide: how far the windows of one event reach apart.
TRAIL_SECONDS = 240


def sliding_user_interest(
    events: DataFrame, window: str = WINDOW, slide: str = SLIDE, watermark: str = WATERMARK
) -> DataFrame:
    """Views, carts and purchases per window, user and product.

    Events of other types make a row with zero counts; events without a time are in no window.
    """
    kind = F.col("event_type")

    def counted(name: str):
        return F.count_if(kind == name).alias(f"{name}_count")

    return (
        events.withWatermark("event_timestamp", watermark)
        .groupBy(
            F.window("event_timestamp", window, slide), "user_id", "product_id", "product_name", "category"
        )
        .agg(counted("view"), counted("cart"), counted("purchase"))
    )


def realtime_trend_score(
    interest: DataFrame, weights: tuple[float, float, float] = REALTIME_WEIGHTS
) -> DataFrame:
    """Weighted score per window row; ``computed_time`` is the window's end in epoch seconds."""
    score = realtime_score(F.col("view_count"), F.col("cart_count"), F.col("purchase_count"), weights)
    return interest.select(
        "user_id",
        "product_id",
        "product_name",
        "category",
        "view_count",
        "cart_count",
        "purchase_count",
        score.alias("trend_score"),
        F.col("window.end").cast("long").alias("computed_time"),
    )


def trailing_window(scored: DataFrame, trail_seconds: int = TRAIL_SECONDS) -> DataFrame:
    """One row per user and product: the window that ends right after the newest event.

    An event is in all windows that end up to ``trail_seconds`` after the first one it is in. The
    first of those reaches back the full window; the last would hold only the newest minute.
    """
    order = Window.partitionBy("user_id", "product_id").orderBy("computed_time", "product_name", "category")
    # all on one sort: the first row that is not more than the trail older than the newest
    newest = F.max("computed_time").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    older = F.lag("computed_time").over(order)
    return (
        scored.withColumns({"_oldest": newest - trail_seconds, "_older": older})
        .filter((F.col("computed_time") >= F.col("_oldest")) & (F.col("_older").isNull() | (F.col("_older") < F.col("_oldest"))))
        .drop("_oldest", "_older")
    )
