from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from shoptide.operators.segments import VIEW_COLUMNS, label_segments, segment_clusters, user_order_features, user_segments

USERS = "user_id string, signup_date date"
ORDERS = "order_id string, user_id string, order_status string"
TODAY = date(2025, 11, 14)


def test_features(spark):
    users = spark.createDataFrame(
        [("none", date(2025, 11, 4)), ("undated", None), ("mixed", date(2025, 11, 13))], USERS
    )
    statuses = ["completed", "completed", "returned", "processing"]
    orders = spark.createDataFrame([(str(i), "mixed", s) for i, s in enumerate(statuses)], ORDERS)
    found = {r["user_id"]: r for r in user_order_features(users, orders, TODAY).collect()}
    assert found["none"]["days_since_signup"] == 10
    assert found["none"]["total_orders"] == 0 and found["none"]["completion_rate"] == 0.0
    assert found["undated"]["days_since_signup"] == 0
    mixed = found["mixed"]
    assert (mixed["total_orders"], mixed["total_completed_orders"], mixed["total_bad_orders"]) == (4, 2, 1)
    assert (mixed["completion_rate"], mixed["cancellation_rate"]) == (0.5, 0.25)


CLUSTERED = "user_id int, cluster int, total_orders long, completion_rate double, cancellation_rate double"


def labels_of(frame):
    return {r["cluster"]: r["segment_name"] for r in label_segments(frame).collect()}


def test_labels(spark):
    rows = [(1, 7, 1, 0.1, 0.2), (2, 5, 2, 0.6, 0.1), (3, 6, 8, 0.7, 0.1), (4, 4, 9, 0.1, 0.3)]
    assert labels_of(spark.createDataFrame(rows, CLUSTERED)) == {
        7: "Bad Customer",
        5: "Low Frequency",
        6: "Frequent Shoppers",
        4: "Risky Frequent Buyers",
    }


def test_labels_with_fewer_clusters(spark):
    rows = [(1, 0, 1, 0.5, 0.1), (2, 1, 5, 0.5, 0.1)]
    assert labels_of(spark.createDataFrame(rows, CLUSTERED)) == {0: "Low Frequency", 1: "Frequent Shoppers"}
    assert labels_of(spark.createDataFrame(rows[:1], CLUSTERED)) == {0: "Frequent Shoppers"}


@pytest.fixture(scope="module")
def shoppers(spark):
    users = spark.range(400).select(
        F.col("id").alias("user_id"), F.date_sub(F.lit(TODAY), (F.col("id") % 90).cast("int")).alias("signup_date")
    )
    orders = spark.range(4000).select(
        F.col("id").alias("order_id"),
        (F.pmod(F.xxhash64("id"), F.lit(20)) * F.pmod(F.xxhash64("id", F.lit(1)), F.lit(20))).alias("user_id"),
        F.when(F.col("id") % 3 == 0, "completed").when(F.col("id") % 5 == 0, "returned").otherwise("shipped").alias("order_status"),
    )
    return users, orders


def test_clusters_do_not_depend_on_the_layout(spark, shoppers):
    features = user_order_features(*shoppers, TODAY)
    one = segment_clusters(features.repartition(3), partitions=8).select("user_id", "cluster")
    two = segment_clusters(features.coalesce(1), partitions=8).select("user_id", "cluster")
    assert sorted(one.collect()) == sorted(two.collect())


def test_view(spark, shoppers):
    view = user_segments(*shoppers, datetime(2025, 11, 14), partitions=8)
    assert view.columns == VIEW_COLUMNS
    assert view.count() == 400
    means = {r["cluster"]: r["m"] for r in view.groupBy("cluster").agg(F.avg("total_orders").alias("m")).collect()}
    assert sorted(means) == [0, 1, 2, 3]
    assert [means[c] for c in sorted(means)] == sorted(means.values())
    assert view.select("segment_name").distinct().count() == 4
