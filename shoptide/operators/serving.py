"""The reads of the serving side, as queries that answer for one user or for all."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 50

# Scores are summed as decimals: a sum of doubles, and any ranking by it, depends on the order of the rows.
_EXACT = "decimal(20,6)"
MAX_LIST_ROWS = 100_000


def _only(rows: DataFrame, column: str, wanted: Collection | None) -> DataFrame:
    return rows if wanted is None else rows.filter(F.col(column).isin(*wanted))


def _total(score: str) -> Column:
    return F.sum(F.col(score).cast(_EXACT)).cast("double").alias(score)


def serve_trending(realtime_view: DataFrame, n: int = PAGE) -> DataFrame:
    """The ``n`` products with the largest score over all users, best first."""
    return (
        realtime_view.groupBy("product_id")
        .agg(
            F.min_by("product_name", "user_id").alias("product_name"),
            F.min_by("category", "user_id").alias("category"),
            _total("trend_score"),
            F.sum("view_count").alias("view_count"),
            F.sum("cart_count").alias("cart_count"),
            F.sum("purchase_count").alias("purchase_count"),
        )
        .orderBy(F.desc("trend_score"), "product_id")
        .limit(n)
    )


def serve_realtime_recommendations(
    realtime_view: DataFrame, n: int = PAGE, user_ids: Collection | None = None
) -> DataFrame:
    """Each user's ``n`` best products of the realtime view."""
    best_first = Window.partitionBy("user_id").orderBy(F.desc("trend_score"), "product_id")
    return (
        _only(realtime_view, "user_id", user_ids)
        .withColumn("_place", F.row_number().over(best_first))
        .filter(F.col("_place") <= n)
        .select(
            "user_id",
            "product_id",
            "product_name",
            "category",
            F.coalesce("trend_score", F.lit(0.0)).alias("score"),
            F.lit("Aggregated").alias("event_type"),
        )
    )


def serve_batch_recommendations(
    recommendations: DataFrame, user_ids: Collection | None = None, max_list_rows: int = MAX_LIST_ROWS
) -> DataFrame:
    """Each user's segment and list of recommendations, best first.

    Lists are pages of ``max_list_rows`` places of the ranking, numbered by ``part``: a page's entries all rank
    before those of the next, and which page a recommendation is on follows from its place alone.
    """
    wanted = _only(recommendations, "user_id", user_ids)
    best_first = Window.partitionBy("user_id").orderBy(F.desc_nulls_last("recommendation_score"), "product_id")
    entry = F.struct(
        "place",
        "product_id",
        "product_name",
        "category",
        F.col("recommendation_score").alias("score"),
        "recommendation_type",
        "segment_name",
    )
    # the ranking and the pages stand on one shuffle, by user
    lists = (
        wanted.withColumn("place", F.row_number().over(best_first))
        .groupBy("user_id", F.floor((F.col("place") - 1) / max_list_rows).cast("int").alias("part"))
        .agg(F.sort_array(F.collect_list(entry)).alias("_list"))
    )
    shape = ("product_id", "product_name", "category", "score", "recommendation_type")
    entries = F.transform("_list", lambda r: F.struct(*[r[name].alias(name) for name in shape]))
    return lists.select(
        "user_id",
        F.coalesce(F.col("_list")[0]["segment_name"], F.lit("Unknown")).alias("segment_name"),
        entries.alias("recommendations"),
        "part",
    )


def potential_customers(
    recommendations: DataFrame, product_ids: Collection | None = None, n: int | None = None
) -> DataFrame:
    """Users by their recommendation score for a product, best first; at most ``n`` per product."""
    order = [F.desc_nulls_last("recommendation_score"), F.asc("user_id")]
    wanted = _only(recommendations, "product_id", product_ids)
    if n is not None:
        place = F.row_number().over(Window.partitionBy("product_id").orderBy(*order))
        wanted = wanted.withColumn("_place", place).filter(F.col("_place") <= n)
    # the user is part of the order, so even one product's customers are sorted in many tasks
    return wanted.orderBy("product_id", *order).select(
        "product_id",
        "user_id",
        F.col("recommendation_score").alias("interest_score"),
        F.col("recommendation_type").alias("type"),
    )


def trend_history(
    scored: DataFrame, product_ids: Collection | None = None, minutes: int | None = 10, as_of: int | None = None
) -> DataFrame:
    """Trend score per product and window end, over the last ``minutes`` up to ``as_of``.

    ``scored`` holds window rows with trend_score and computed_time (epoch seconds). Without
    ``as_of`` the newest window of ``scored`` counts as now; without ``minutes`` all windows stay.
    """
    wanted = _only(scored, "product_id", product_ids)
    if minutes is not None:
        now = F.lit(as_of) if as_of is not None else scored.agg(F.max("computed_time")).scalar()
        wanted = wanted.filter((F.col("computed_time") > now - minutes * 60) & (F.col("computed_time") <= now))
    return wanted.groupBy("product_id", F.col("computed_time").alias("window_end")).agg(_total("trend_score"))


def product_counts(order_items: DataFrame) -> DataFrame:
    """Line items per product, most first."""
    counted = order_items.groupBy("product_id").agg(F.count("*").alias("count"))
    return counted.orderBy(F.desc("count"), "product_id")
