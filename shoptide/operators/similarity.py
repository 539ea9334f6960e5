"""Similar products: same category, nearest price, the best k per product.

The score falls with the price distance inside a category, so a product's best partners stand
among the nearest distinct price points. Work goes per price point, not per pair of products:
each point keeps its first k + 1 products, looks at the k points on either side, and its ranked
partners serve every product at that price.

The price axis of a big category is cut into cells, so that it is not one task. A cell also gets
the k points just outside either end, found among the outermost k points of all cells.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions.clock import instant
from shoptide.functions.scoring import price_similarity
from shoptide.functions.spread import FAN_OUT_ROWS, count_keys, hot_keys, keep_partitions, spread_join

CELL_POINTS = 5_000
QUANTILES = 1_000  # of a category's price points, found in one pass; cells end at some of them
_POINT = ["category", "price"]


def _first_ids(rows: DataFrame, keys: list[str], count: int) -> DataFrame:
    """The ``count`` smallest product ids per key, as a sorted list."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("product_id"))
    return (
        rows.withColumn("_place", place)
        .filter(F.col("_place") <= count)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list("product_id")).alias("_ids"))
    )


def cell_ends(priced: DataFrame, cell_points: int) -> DataFrame:
    """(category, _ends) of the categories with more than ``cell_points`` price points: the prices, rising, that end all
    but the last of their cells. Cells hold about as many points each, however the prices are spread."""
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    big = (
        priced.select(*_POINT)
        .distinct()
        .groupBy("category")
        .agg(F.count("*").alias("_n"), F.percentile_approx("price", shares, 10 * QUANTILES).alias("_at"))
        .filter(F.col("_n") > cell_points)
        .withColumn("_cells", F.least(F.ceil(F.col("_n") / cell_points), F.lit(QUANTILES)).cast("int"))
    )
    number = F.sequence(F.lit(1), F.col("_cells") - 1)
    ends = F.transform(number, lambda i: F.element_at("_at", F.floor(i * QUANTILES / F.col("_cells")).cast("int")))
    return big.select("category", ends.alias("_ends"))


def _in_cells(points: DataFrame, priced: DataFrame, cell_points: int) -> DataFrame:
    """``points`` with their cell; the one cell of a small category is 0."""
    below = F.size(F.filter("_ends", lambda end: end < F.col("price")))
    cell = F.when(F.col("_ends").isNull(), 0).otherwise(below)
    # at most one end for cell_points price points
    ends = F.broadcast(cell_ends(priced, cell_points))
    return points.join(ends, "category", "left").withColumn("_cell", cell).drop("_ends")


def _with_borders(points: DataFrame, k: int) -> DataFrame:
    """``points`` plus, per cell, the nearest k points of the category below and above it (``_guest``)."""
    cell = ["category", "_cell"]
    up = Window.partitionBy(*cell).orderBy("price")
    down = Window.partitionBy(*cell).orderBy(F.desc("price"))
    # at most 2k rows per cell, whatever the number of points
    ends = points.withColumns({"_low": F.row_number().over(up), "_high": F.row_number().over(down)}).filter(
        (F.col("_low") <= k) | (F.col("_high") <= k)
    )
    axis = Window.partitionBy("category").orderBy("price")
    point = F.struct("price", "_ids")
    below = F.when(F.col("_low") == 1, F.collect_list(point).over(axis.rowsBetween(-k, -1)))
    above = F.when(F.col("_high") == 1, F.collect_list(point).over(axis.rowsBetween(1, k)))
    guests = (
        ends.withColumns({"_below": below, "_above": above})
        .select(*cell, F.explode(F.array("_below", "_above")).alias("_points"))
        .filter(F.size("_points") > 0)
        .select(*cell, F.explode("_points").alias("_point"))
        .select(*cell, F.col("_point.price").alias("price"), F.col("_point._ids").alias("_ids"))
    )
    return points.withColumn("_guest", F.lit(False)).unionByName(
        guests.withColumn("_guest", F.lit(True)), allowMissingColumns=True
    )


def _ranked(price: Column, neighbours: Column, price_range: Column, count: int) -> Column:
    """The ``count`` best (score, id) among the neighbouring points, best first, ties by id."""

    def of_point(point: Column) -> Column:
        worse = -price_similarity(price, point["price"], price_range)
        return F.transform(point["_ids"], lambda i: F.struct(worse.alias("worse"), i.alias("id")))

    best = F.slice(F.sort_array(F.flatten(F.transform(neighbours, of_point))), 1, count)
    return F.transform(best, lambda p: F.struct(p["id"].alias("id"), (-p["worse"]).alias("score")))


def product_similarity(
    products: DataFrame, k: int = 20, as_of: date | datetime | None = None, cell_points: int = CELL_POINTS
) -> DataFrame:
    """Up to ``k`` partners per product, both directions, ranked by score and then id.

    A partner without a price has a null score and ranks behind all priced ones; a product without a
    price has only null scores. With ``as_of`` the view carries it as ``computed_date``.
    """
    wanted = products.filter(F.col("category").isNotNull()).select("product_id", "category", "price")
    priced = wanted.filter(F.col("price").isNotNull())
    unpriced = wanted.filter(F.col("price").isNull())

    # bounds of the whole catalogue, read as scalars
    low, high = (products.agg(f("price")).scalar() for f in (F.min, F.max))
    price_range = F.when(high > low, high - low).otherwise(F.lit(1.0))
    # one product more than asked for, as a product is not its own partner
    keep = k + 1
    points = _in_cells(_first_ids(priced, _POINT, keep), priced, cell_points)
    points = points.withColumn("_range", price_range)
    axis = Window.partitionBy("category", "_cell").orderBy("price").rowsBetween(-k, k)
    near = F.collect_list(F.struct("price", "_ids")).over(axis)
    partners = (
        keep_partitions(_with_borders(points, k), ["category", "_cell"])
        .withColumn("_near", near)
        .filter(~F.col("_guest"))
        .select(*_POINT, _ranked(F.col("price"), F.col("_near"), F.col("_range"), keep).alias("_partners"))
    )

    def unscored(ids: Column) -> Column:
        return F.transform(ids, lambda i: F.struct(i.alias("id"), F.lit(None).cast("double").alias("score")))

    # only categories with at most k priced products have room for partners without a price
    short = F.size("_partners") < keep
    tails = _first_ids(unpriced, ["category"], keep).select("category", unscored(F.col("_ids")).alias("_tail"))
    topped_up = (
        partners.filter(short)
        .join(tails, "category", "left")
        .withColumn("_partners", F.coalesce(F.concat("_partners", "_tail"), "_partners"))
        .drop("_tail")
    )
    for_unpriced = _first_ids(wanted, ["category"], keep).select(
        "category", F.lit(None).cast("double").alias("price"), unscored(F.col("_ids")).alias("_partners")
    )
    lists = partners.filter(~short).unionByName(topped_up).unionByName(for_unpriced)

    # a missing price is a key of its own
    spot = {"_has_price": F.col("price").isNotNull(), "_at": F.coalesce("price", F.lit(0.0))}
    key = ["category", *spot]
    sources = wanted.withColumns(spot).drop("price")
    hot = hot_keys(count_keys(sources, key), key, min_rows=FAN_OUT_ROWS)
    matched = spread_join(sources, lists.withColumns(spot).drop("price"), key, hot, fans_out=True)
    others = F.filter("_partners", lambda p: p["id"] != F.col("product_id"))
    pairs = matched.select("product_id", F.explode(F.slice(others, 1, k)).alias("_partner"))
    columns = [
        F.col("product_id").alias("product_id_1"),
        F.col("_partner.id").alias("product_id_2"),
        F.col("_partner.score").alias("similarity_score"),
        F.lit("content_based").alias("similarity_type"),
        F.lit(True).alias("category_match"),
    ]
    if as_of is not None:
        columns.append(instant(as_of).alias("computed_date"))
    return pairs.select(*columns)
