"""Recommendations per user: what they bought, what is similar to it, and what goes with it.

A candidate's score depends on the product it comes from, not on the user. The view therefore
scores links between products once, on tables the size of the catalogue, and only then joins the
users to them; the one big shuffle left is the one that keeps a user's best row per product.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions.clock import instant
from shoptide.functions.scoring import BLEND_WEIGHTS, OTHER_PRIORITY, TYPE_PRIORITY, final_score, priority_of
from shoptide.functions.spread import FAN_OUT_ROWS, count_keys, hot_keys, spread_join

_MANY = "_many_products"


def top_trending(trending: DataFrame, n: int = 10) -> DataFrame:
    """The ids of the ``n`` best trending products, best first."""
    return trending.orderBy(F.desc("trend_score"), "product_id").limit(n).select("product_id")


def consumption_base(profile: DataFrame, top: DataFrame, *extra: str) -> DataFrame:
    """Each user's distinct products of the latest month; without any, the ``top`` ids.

    ``extra`` names further columns of the profile to carry along.
    """
    bought = F.col("product_ids_in_latest_month")
    fallback = top.agg(F.array_sort(F.collect_list("product_id"))).scalar()
    chosen = F.when(bought.isNull() | (F.size(bought) == 0), fallback).otherwise(F.array_distinct(bought))
    return profile.select("user_id", *extra, F.explode(chosen).alias("product_id"))


def product_links(similarity: DataFrame, complementary: DataFrame) -> DataFrame:
    """Product -> other product, with type and score; complementary scores as a share of the largest."""
    best = complementary.agg(F.max("complementary_score")).scalar()
    scale = F.when(best.isNull() | (best == 0), F.lit(1.0)).otherwise(best)
    similar = similarity.select(
        F.col("product_id_1").alias("source_id"),
        F.col("product_id_2").alias("product_id"),
        F.col("similarity_score").alias("score"),
        F.lit("similar").alias("type"),
    )
    together = complementary.select(
        F.col("product_id_1").alias("source_id"),
        F.col("product_id_2").alias("product_id"),
        (F.coalesce("complementary_score", F.lit(0.0)) / scale).alias("score"),
        F.lit("complementary").alias("type"),
    )
    return similar.unionByName(together)


def _own(products: DataFrame) -> DataFrame:
    return products.withColumns({"score": F.lit(1.0), "type": F.lit("consumption")})


def _hot(rows: DataFrame, key: str) -> DataFrame:
    return hot_keys(count_keys(rows, [key]), [key])


def _hot_sources(counts: DataFrame) -> DataFrame:
    return hot_keys(counts, ["source_id"], min_rows=FAN_OUT_ROWS)


def rec_candidates(base: DataFrame, similarity: DataFrame, complementary: DataFrame) -> DataFrame:
    """All candidates of every user with their type and unweighted score."""
    bought = base.withColumnRenamed("product_id", "source_id")
    links = product_links(similarity, complementary)
    hot = _hot_sources(count_keys(bought, ["source_id"]))
    from_links = spread_join(bought, links, ["source_id"], hot, fans_out=True)
    columns = ["user_id", "product_id", "score", "type"]
    return _own(base).select(*columns).unionByName(from_links.select(*columns))


def _scored(rows: DataFrame, facts: DataFrame, weights, priority, other) -> DataFrame:
    """``rows`` with the ``facts`` of their product (trend_score among them) and the blended score."""
    rank = priority_of(F.col("type"), priority, other)
    return spread_join(rows, facts, ["product_id"], _hot(rows, "product_id"), "left").withColumns(
        {"_priority": rank, "final_score": final_score(rank, F.col("score"), F.col("trend_score"), weights)}
    )


def _place() -> Column:
    """Smaller is better: score, then priority of the type, then its name; null loses to any score."""
    score = F.col("final_score")
    return F.struct(score.isNull(), (-score).alias("worse"), -F.col("_priority"), "type")


def score_candidates(
    candidates: DataFrame,
    trending: DataFrame,
    weights: tuple[float, float] = BLEND_WEIGHTS,
    priority: Mapping[str, float] = TYPE_PRIORITY,
    other: float = OTHER_PRIORITY,
) -> DataFrame:
    """The best row per user and product, by blended score."""
    return (
        _scored(candidates, trending.select("product_id", "trend_score"), weights, priority, other)
        .groupBy("user_id", "product_id")
        .agg(F.min(_place()).alias("_best"))
        .select(
            "user_id",
            "product_id",
            F.col("_best.type").alias("type"),
            (-F.col("_best.worse")).alias("final_score"),
        )
    )


def _gathered(base: DataFrame, offers: DataFrame, hot: DataFrame, key: list[str]) -> DataFrame:
    """The offers to each user (``key``, type, final_score), a user's in one partition. Users of so many products that their offers are too
    many for a task are brought down to a row per product and type before, in many tasks; a maximum of maxima is the same."""

    def offered(of: DataFrame) -> DataFrame:
        return spread_join(of, offers, ["source_id"], hot, fans_out=True).select(*key, "type", "final_score")

    reduced = offered(base.filter(_MANY)).groupBy(*key, "type").agg(F.max("final_score").alias("final_score"))
    return offered(base.filter(~F.col(_MANY))).unionByName(reduced).repartition("user_id")


def user_recommendations(
    profile: DataFrame,
    trending: DataFrame,
    similarity: DataFrame,
    complementary: DataFrame,
    segments: DataFrame,
    products: DataFrame,
    as_of: date | datetime | None = None,
    n_fallback: int = 10,
    weights: tuple[float, float] = BLEND_WEIGHTS,
    priority: Mapping[str, float] = TYPE_PRIORITY,
    other: float = OTHER_PRIORITY,
    by_user: bool = False,
) -> DataFrame:
    """The recommendation view, one row per user and recommended product, no limit per user.

    ``by_user`` keeps a user's rows in one partition, for who ranks or groups them by user next: the big shuffle is then the only one.
    """
    # segment on the user's row, before it fans out
    known = profile.join(segments.select("user_id", "segment_name"), "user_id", "left")
    extra = ["segment_name"]
    if by_user:
        known = known.withColumn(_MANY, F.coalesce(F.size("product_ids_in_latest_month") > FAN_OUT_ROWS, F.lit(False)))
        extra.append(_MANY)
    base = consumption_base(known, top_trending(trending, n_fallback), *extra).withColumnRenamed("product_id", "source_id")
    per_source = count_keys(base, ["source_id"])

    # what is known of a product, on one row
    facts = products.select("product_id", "product_name", "category").join(
        trending.select("product_id", "trend_score"), "product_id", "full_outer"
    )
    own = _own(per_source.select("source_id", F.col("source_id").alias("product_id")))
    links = own.unionByName(product_links(similarity, complementary))
    offers = _scored(links, facts, weights, priority, other).drop("score", "trend_score", "_priority")

    # The best row per product over all of a user's sources. A maximum per type keeps to plain
    # numbers, which a hash aggregate can update in place; a maximum of structs would have to sort.
    kinds = sorted({*TYPE_PRIORITY, *priority}, key=lambda kind: (-priority.get(kind, other), kind))
    best_of = {kind: F.max(F.when(F.col("type") == kind, F.col("final_score"))).alias(f"_{kind}") for kind in kinds}
    place_of_unscored = F.min(
        F.when(F.col("final_score").isNull(), F.array_position(F.lit(kinds), F.col("type")))
    ).alias("_unscored")
    best = F.greatest(*[F.col(f"_{kind}") for kind in kinds])
    best_kind = F.coalesce(
        *[F.when(F.col(f"_{kind}") == best, kind) for kind in kinds],
        F.get(F.lit(kinds), (F.col("_unscored") - 1).cast("int")),
    )
    columns = [
        "user_id",
        "segment_name",
        "product_id",
        "product_name",
        "category",
        best.alias("recommendation_score"),
        best_kind.alias("recommendation_type"),
    ]
    if as_of is not None:
        columns.append(instant(as_of).alias("computed_date"))
    hot = _hot_sources(per_source)
    key = ["user_id", "segment_name", "product_id", "product_name", "category"]
    if by_user:
        rows = _gathered(base, offers, hot, key)
    else:
        rows = spread_join(base, offers, ["source_id"], hot, fans_out=True)
    return rows.groupBy(*key).agg(*best_of.values(), place_of_unscored).select(*columns)
