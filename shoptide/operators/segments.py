"""Customer segments: order behaviour per user, clusters, and a name for each cluster."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions.clock import days_ago

COMPLETED = ("completed",)
BAD = ("cancelled", "returned")

FEATURES = ["days_since_signup", "total_orders", "completion_rate", "cancellation_rate"]

VIEW_COLUMNS = [
    "user_id",
    "days_since_signup",
    "total_orders",
    "total_completed_orders",
    "total_bad_orders",
    "completion_rate",
    "cancellation_rate",
    "cluster",
    "segment_name",
]


def user_order_features(
    users: DataFrame,
    orders: DataFrame,
    as_of: date | datetime,
    completed: Collection[str] = COMPLETED,
    bad: Collection[str] = BAD,
) -> DataFrame:
    """Order counts and rates per user; users without orders or signup date get zeros."""
    status = F.col("order_status")
    per_user = orders.groupBy("user_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(status.isin(*completed)).alias("total_completed_orders"),
        F.count_if(status.isin(*bad)).alias("total_bad_orders"),
    )
    rates = {
        "completion_rate": F.try_divide("total_completed_orders", "total_orders"),
        "cancellation_rate": F.try_divide("total_bad_orders", "total_orders"),
    }
    age = days_ago(as_of, F.col("signup_date").try_cast("date")).alias("days_since_signup")
    return users.select("user_id", age).join(per_user.withColumns(rates), "user_id", "left").fillna(0)


def segment_clusters(features: DataFrame, k: int = 4, seed: int = 50, partitions: int = 200) -> DataFrame:
    """KMeans on the standardised features; ``cluster`` is the rank of the cluster's mean order count.

    KMeans depends on how its input is laid out, so the layout is fixed first: the same
    ``partitions`` gives the same clusters however ``features`` arrives. This fits, so it runs jobs.
    """
    laid_out = features.repartition(partitions, "user_id").sortWithinPartitions("user_id")
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURES, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            KMeans(featuresCol="_scaled", predictionCol="_cluster", k=k, seed=seed),
        ]
    ).fit(laid_out)
    assigned = model.transform(features).drop("_raw", "_scaled")
    by_orders = Window.orderBy("_orders", "_cluster")
    ranks = (
        assigned.groupBy("_cluster")
        .agg(F.avg("total_orders").alias("_orders"))
        .select("_cluster", (F.row_number().over(by_orders) - 1).alias("cluster"))
    )
    # one row per cluster
    return assigned.join(F.broadcast(ranks), "_cluster").drop("_cluster")


def label_segments(clustered: DataFrame) -> DataFrame:
    """Name the clusters by their unscaled means.

    The half of the clusters with fewer orders is low, the other high; inside each half the
    cluster with the largest completion minus cancellation is the good one.
    """
    profile = clustered.groupBy("cluster").agg(
        F.avg("total_orders").alias("_orders"),
        (F.avg("completion_rate") - F.avg("cancellation_rate")).alias("_goodness"),
    )
    # one row per cluster, so the windows below stay at k rows
    place = F.row_number().over(Window.orderBy("_orders", "cluster"))
    halves = profile.withColumn("_high", place * 2 > F.count("*").over(Window.partitionBy()))
    best_first = Window.partitionBy("_high").orderBy(F.desc("_goodness"), "cluster")
    good = F.row_number().over(best_first) == 1
    names = halves.select(
        "cluster",
        F.when(F.col("_high") & good, "Frequent Shoppers")
        .when(F.col("_high"), "Risky Frequent Buyers")
        .when(good, "Low Frequency")
        .otherwise("Bad Customer")
        .alias("segment_name"),
    )
    return clustered.join(F.broadcast(names), "cluster", "left")


def user_segments(
    users: DataFrame,
    orders: DataFrame,
    as_of: date | datetime,
    completed: Collection[str] = COMPLETED,
    bad: Collection[str] = BAD,
    k: int = 4,
    seed: int = 50,
    partitions: int = 200,
    settle=lambda features: features,
) -> DataFrame:
    """The segment view. ``settle`` may materialise the features, which the fit reads many times."""
    features = settle(user_order_features(users, orders, as_of, completed, bad))
    return label_segments(segment_clusters(features, k, seed, partitions)).select(*VIEW_COLUMNS)
