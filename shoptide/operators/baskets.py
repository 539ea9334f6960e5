"""Products bought together: baskets, one-to-one rules, and the complementary view.

Only one-to-one rules are ever used, and those need nothing but the counts of single products
and of pairs, so pairs are counted directly instead of mining item sets of every size.

Pairs are written out for ordinary baskets only. A basket beyond ``max_basket`` lines would
square into more pairs than the rest of the data; such baskets are met from the other end. If
there are L of them, a pair that reaches ``min_count`` must occur ``min_count - L`` times in the
ordinary ones, so the pairs found there are the only candidates, and for each of those the
large baskets holding both products are counted. That is exact as long as L < min_count; if there
are more, only the largest are treated so. The others are cut into blocks by the hash of the product, and
paired block by block, so that none is one row or one task's work.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions.clock import epoch_ms
from shoptide.functions.scoring import complementary_score
from shoptide.functions.spread import count_keys, hot_keys, keep_partitions, spread_join

MIN_SUPPORT = 1e-4
MIN_CONFIDENCE = 5e-3
MAX_BASKET = 500

# Large baskets are few: their ids are broadcast, and listed per product.
MAX_LARGE = 10_000

# Sizes up to which other lists of ids are broadcast.
BROADCAST_IDS = 100_000


def _lines(order_items: DataFrame) -> DataFrame:
    return order_items.select("order_id", "product_id").filter(F.col("product_id").isNotNull())


def _orders(lines: DataFrame) -> DataFrame:
    """Per order its line count, and whether it holds two different products."""
    return lines.groupBy("order_id").agg(
        F.count("*").alias("n"), (F.min("product_id") < F.max("product_id")).alias("_mixed")
    )


def baskets(order_items: DataFrame) -> DataFrame:
    """The distinct products of every order that has at least two of them, one row each."""
    lines = _lines(order_items)
    per_order = _orders(lines)
    mixed = per_order.filter("_mixed").select("order_id")
    return spread_join(lines.distinct(), mixed, ["order_id"], hot_keys(per_order, ["order_id"]), "left_semi")


@dataclass(frozen=True)
class BasketCensus:
    """What is known about the baskets before any pair is counted."""

    baskets: int  # orders with two products or more
    lines: int
    repeats: int  # orders of more than max_repeats lines that are all one product
    large: int  # baskets of more than max_basket lines
    blocked: int  # baskets of more than max_repeats lines, up to max_basket
    min_count: int
    max_basket: int
    max_repeats: int


def basket_census(
    order_items: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_count: int | None = None,
    max_basket: int = MAX_BASKET,
) -> BasketCensus:
    """One small job, at most three: how many baskets there are, the count a pair must reach, the size bound."""
    orders = _orders(_lines(order_items))

    def census(bound: int) -> dict:
        above = F.col("n") > bound
        counts = orders.agg(
            F.count_if("_mixed").alias("baskets"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("lines"),
            F.count_if(~F.col("_mixed") & (F.col("n") > max_basket)).alias("repeats"),
            F.count_if(F.col("_mixed") & above).alias("large"),
            F.count_if(F.col("_mixed") & (F.col("n") > max_basket) & ~above).alias("blocked"),
        )
        return counts.first().asDict()

    found, bound = census(max_basket), max_basket
    needed = min_count if min_count is not None else ceil(min_support * found["baskets"])
    needed = max(needed, 1)
    most = min(needed - 1, MAX_LARGE)
    if found["large"] > most:
        largest = orders.filter("_mixed").orderBy(F.desc("n")).limit(most + 1)
        bound = largest.agg(F.min("n")).first()[0]
        found = census(bound)
    return BasketCensus(**found, min_count=needed, max_basket=bound, max_repeats=max_basket)


@dataclass(frozen=True)
class _Mined:
    census: BasketCensus
    pairs: DataFrame  # a < b, n_ab
    singles: DataFrame  # product_id, n


def _mine(order_items: DataFrame, min_support: float, min_count: int | None, max_basket: int, settle) -> _Mined:
    """Counts of the frequent products and of their frequent pairs."""
    known = basket_census(order_items, min_support, min_count, max_basket)
    lines = _lines(order_items)
    big = blocked = None
    if known.repeats or known.large or known.blocked:
        apart = _orders(lines).filter(F.col("n") > max_basket)
        few = known.repeats + known.large + known.blocked <= BROADCAST_IDS
        hint = F.broadcast if few else lambda ids: ids
        if known.large:
            big = lines.join(hint(apart.filter(F.col("_mixed") & (F.col("n") > known.max_basket))), "order_id", "left_semi").distinct()
        if known.blocked:
            cut = apart.filter(F.col("_mixed") & (F.col("n") <= known.max_basket))
            cut = cut.select("order_id", F.ceil(F.col("n") / max_basket).cast("int").alias("_blocks"))
            blocked = lines.join(hint(cut), "order_id").distinct()
        lines = lines.join(hint(apart), "order_id", "left_anti")
    # one shuffle by order, at most max_basket lines each
    sets = (
        lines.repartition("order_id")
        .groupBy("order_id")
        .agg(F.sort_array(F.collect_set("product_id")).alias("items"))
        .filter(F.size("items") > 1)
    )
    members = sets.select("order_id", F.explode("items").alias("product_id"))
    counted = members
    for others in (big, blocked):
        if others is not None:
            counted = counted.unionByName(others.select("order_id", "product_id"))
    singles = counted.groupBy("product_id").agg(F.count("*").alias("n")).filter(F.col("n") >= known.min_count)
    if known.min_count > 1 and known.lines // known.min_count <= BROADCAST_IDS:
        # so few products can be frequent that the others are dropped before pairing, in place
        frequent = F.broadcast(singles.select("product_id"))
        members = members.join(frequent, "product_id", "left_semi")
        sets = members.groupBy("order_id").agg(F.sort_array(F.collect_list("product_id")).alias("items"))

    after = F.slice("items", F.col("i") + 2, F.size("items"))
    paired = sets.select("items", F.posexplode("items").alias("i", "a")).select("a", F.explode(after).alias("b"))
    if blocked is not None:
        if known.min_count > 1:
            hot = hot_keys(count_keys(blocked, ["product_id"]), ["product_id"])
            blocked = spread_join(blocked, singles.select("product_id"), ["product_id"], hot, "left_semi")
        paired = paired.unionByName(_pairs_by_block(blocked))
    pairs = (
        paired.groupBy("a", "b")
        .agg(F.count("*").alias("n_ab"))
        .filter(F.col("n_ab") >= max(1, known.min_count - known.large))
    )
    if big is not None:
        # per product the large baskets it is in: at most `large` < min_count ids
        member = big.groupBy("product_id").agg(F.collect_set("order_id").alias("_in"))
        pairs = _for_both(settle(pairs), member, "left")
        both = F.size(F.array_intersect("_in_a", "_in_b"))
        both = F.when(F.col("_in_a").isNull() | F.col("_in_b").isNull(), 0).otherwise(both)
        pairs = pairs.withColumn("n_ab", F.col("n_ab") + both).filter(F.col("n_ab") >= known.min_count)
    return _Mined(known, settle(pairs.select("a", "b", "n_ab")), singles)


def _pairs_by_block(lines: DataFrame) -> DataFrame:
    """Pairs a < b of the distinct lines (order_id, product_id, _blocks) of each order: every two blocks of an order meet in
    a group of their own, which holds two blocks' products and no more."""
    block = F.pmod(F.xxhash64("product_id"), F.col("_blocks")).cast("int")
    met = lines.withColumn("_block", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    low, high = F.least("_block", "_other").alias("_low"), F.greatest("_block", "_other").alias("_high")

    def products_of(end: str) -> Column:
        return F.collect_list(F.when(F.col("_block") == F.col(end), F.col("product_id")))

    met = met.select("order_id", low, high, "_block", "product_id")
    groups = keep_partitions(met, ["order_id", "_low", "_high"]).groupBy("order_id", "_low", "_high")
    sides = groups.agg(products_of("_low").alias("_left"), products_of("_high").alias("_right"))
    pairs = sides.select("_low", "_high", "_right", F.explode("_left").alias("_one"))
    # inside one block, each pair once
    pairs = pairs.select("_low", "_high", "_one", F.explode("_right").alias("_two")).filter(
        (F.col("_low") < F.col("_high")) | (F.col("_one") < F.col("_two"))
    )
    return pairs.select(F.least("_one", "_two").alias("a"), F.greatest("_one", "_two").alias("b"))


def _for_both(pairs: DataFrame, facts: DataFrame, how: str) -> DataFrame:
    """``facts`` of both products of a pair, its columns suffixed _a and _b."""
    joined = pairs
    for side in ("a", "b"):
        named = facts.select(F.col("product_id").alias(side), *[
            F.col(c).alias(f"{c}_{side}") for c in facts.columns if c != "product_id"
        ])
        joined = spread_join(joined, named, [side], hot_keys(count_keys(pairs, [side]), [side]), how)
    return joined


def _rules(mined: _Mined, facts: DataFrame, min_confidence: float) -> DataFrame:
    """Both directions of every pair, with the ``facts`` (product_id, n, ...) of either side."""
    pairs = _for_both(mined.pairs, facts, "inner")
    extra = [c for c in facts.columns if c != "product_id"]

    def directed(a: str, b: str):
        return F.struct(
            F.col(a).alias("product_id_1"),
            F.col(b).alias("product_id_2"),
            *[F.col(f"{c}_{a}").alias(f"{c}_1") for c in extra],
            *[F.col(f"{c}_{b}").alias(f"{c}_2") for c in extra],
        )

    both_ways = pairs.select("n_ab", F.explode(F.array(directed("a", "b"), directed("b", "a"))).alias("r"))
    total = F.lit(mined.census.baskets).cast("double")
    n_ab = F.col("n_ab").cast("double")
    confidence = n_ab / F.col("n_1")
    return (
        both_ways.select("n_ab", "r.*")
        .withColumns(
            {
                "co_purchase_count": F.col("n_ab").cast("int"),
                "support": n_ab / total,
                "confidence": confidence,
                "lift": confidence / (F.col("n_2").cast("double") / total),
            }
        )
        .filter(F.col("confidence") >= min_confidence)
    )


def copurchase_rules(
    order_items: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_count: int | None = None,
    max_basket: int = MAX_BASKET,
    settle=lambda pairs: pairs,
) -> DataFrame:
    """Directed rules a -> b with count, support, confidence and lift.

    A rule needs ``min_count`` common baskets (by default ``min_support`` of all baskets with two
    products or more) and ``min_confidence``. Like a model fit this runs a job, to take the census.
    ``settle`` may materialise the pair counts, which are read several times.
    """
    mined = _mine(order_items, min_support, min_count, max_basket, settle)
    return _rules(mined, mined.singles, min_confidence).select(
        "product_id_1", "product_id_2", "co_purchase_count", "support", "confidence", "lift"
    )


def product_complementary(
    order_items: DataFrame,
    products: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_count: int | None = None,
    max_basket: int = MAX_BASKET,
    as_of: date | datetime | None = None,
    settle=lambda pairs: pairs,
) -> DataFrame:
    """The rules with both categories compared and the complementary score.

    ``category_cross_sell`` is null where a category is unknown.
    """
    mined = _mine(order_items, min_support, min_count, max_basket, settle)
    facts = mined.singles.join(products.select("product_id", "category"), "product_id", "left")
    columns = [
        "product_id_1",
        "product_id_2",
        F.lit("co_purchase").alias("relationship_type"),
        "co_purchase_count",
        "confidence",
        (F.col("category_1") != F.col("category_2")).alias("category_cross_sell"),
        complementary_score(F.col("confidence"), F.col("lift")).alias("complementary_score"),
    ]
    if as_of is not None:
        columns.append(F.lit(epoch_ms(as_of)).cast("long").alias("computed_date"))
    return _rules(mined, facts, min_confidence).select(*columns)
