"""The registered queries: every operator over whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.operators import baskets as B
from shoptide.operators import consumption as C
from shoptide.operators import recommend as R
from shoptide.operators import segments as S
from shoptide.operators import serving as V
from shoptide.operators import similarity as M
from shoptide.operators import trending as T
from shoptide.plans.batch import run_batch
from shoptide.plans.daily import daily_profile, daily_trending, update_partials
from shoptide.plans.settle import checkpoint_root, settle, side_by_side
from shoptide.schemas import ACTIVITY_MESSAGE
from shoptide.session import stream_session
from shoptide.sources.star import BAD, COMPLETED, EVENTS_TODAY, ORDERS_TODAY, StarTables
from shoptide.sources.tables import read_message_files
from shoptide.sources.views import read_snapshot, upsert_snapshot
from shoptide.streaming import interest as I
from shoptide.streaming.events import parse_activity_events
from shoptide.streaming.speed import start_raw_append, start_speed_layer
from shoptide.streaming.view import TTL_SECONDS, expire_realtime_view, read_realtime_view, read_windows

# Baskets of the test tables share few products, so a pair counts from its second basket on.
MIN_COUNT = 2

BATCHES = 6
LATE_DAYS = 10
WEEK = 7 * 86_400
SNAPSHOT_DAY = "1997-01-01"

# "Now" of the realtime reads, in epoch seconds: 2024-01-30 12:00 UTC.
REALTIME_NOW = 1706616000

Query = Callable[[SparkSession, str], DataFrame]


def _joined(column: str):
    return F.array_join(F.transform(column, lambda v: v.cast("string")), "|").alias(column)


def order_features(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return S.user_order_features(t.users, t.orders, ORDERS_TODAY, COMPLETED, BAD)


def segment_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return S.segment_clusters(settle(order_features(spark, folder)), partitions=8)


def user_segments(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return S.user_segments(t.users, t.orders, ORDERS_TODAY, COMPLETED, BAD, partitions=8, settle=settle)


def label_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Labels for four made-up clusters, the user id modulo 4, which SQL can make too."""
    clustered = order_features(spark, folder).withColumn("cluster", (F.col("user_id") % 4).cast("int"))
    return S.label_segments(clustered).select("user_id", "cluster", "segment_name")


def avg_order_value(spark: SparkSession, folder: str) -> DataFrame:
    return C.avg_order_value(StarTables(spark, folder).orders, COMPLETED)


def monthly_spending(spark: SparkSession, folder: str) -> DataFrame:
    return C.monthly_spending(StarTables(spark, folder).orders, COMPLETED)


def latest_month_spending(spark: SparkSession, folder: str) -> DataFrame:
    return C.latest_month_spending(StarTables(spark, folder).orders, COMPLETED)


def latest_month_items(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return C.latest_month_items(t.orders, t.order_items, t.products, COMPLETED)


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return C.user_consumption_profile(t.customers, t.orders, t.order_items, t.products, COMPLETED, settle=settle)


def _with_lists_joined(profile: DataFrame) -> DataFrame:
    lists = (
        "product_ids_in_latest_month",
        "products_in_latest_month",
        "categories_in_latest_month",
        "product_prices_in_latest_month",
    )
    return profile.select("user_id", "avg_order_value", "monthly_spending", *[_joined(c) for c in lists])


def user_consumption_profile(spark: SparkSession, folder: str) -> DataFrame:
    return _with_lists_joined(_profile(spark, folder))


def view_growth(spark: SparkSession, folder: str) -> DataFrame:
    return T.view_growth(StarTables(spark, folder).views_only, EVENTS_TODAY)


def order_growth(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return T.order_growth(t.orders, t.order_items, ORDERS_TODAY)


def trending_products(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return T.trending_products(t.views_only, t.orders, t.order_items, EVENTS_TODAY, orders_as_of=ORDERS_TODAY)


def top_trending(spark: SparkSession, folder: str) -> DataFrame:
    return R.top_trending(trending_products(spark, folder))


def product_similarity(spark: SparkSession, folder: str) -> DataFrame:
    return M.product_similarity(StarTables(spark, folder).products)


def baskets(spark: SparkSession, folder: str) -> DataFrame:
    return B.baskets(StarTables(spark, folder).order_items)


def copurchase_rules(spark: SparkSession, folder: str) -> DataFrame:
    return B.copurchase_rules(StarTables(spark, folder).order_items, min_count=MIN_COUNT, settle=settle)


def product_complementary(spark: SparkSession, folder: str) -> DataFrame:
    t = StarTables(spark, folder)
    return B.product_complementary(t.order_items, t.products, min_count=MIN_COUNT, settle=settle)


def consumption_base(spark: SparkSession, folder: str) -> DataFrame:
    return R.consumption_base(_profile(spark, folder), top_trending(spark, folder))


def _settled(spark: SparkSession, folder: str, *queries: Query) -> list[DataFrame]:
    """The queries' results, each computed once, side by side."""
    checkpoint_root(spark)
    return side_by_side(*[lambda query=query: settle(query(spark, folder)) for query in queries])


def rec_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return R.rec_candidates(
        *_settled(spark, folder, consumption_base, product_similarity, product_complementary)
    )


def score_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return R.score_candidates(*_settled(spark, folder, rec_candidates, trending_products))


def user_recommendations(spark: SparkSession, folder: str, by_user: bool = False) -> DataFrame:
    """The recommendation view over the other views, each computed once."""
    views = _settled(
        spark, folder, _profile, trending_products, product_similarity, product_complementary, label_segments
    )
    return R.user_recommendations(*views, StarTables(spark, folder).products, by_user=by_user)


def batch_chain(spark: SparkSession, folder: str) -> DataFrame:
    """All six views written to a folder of their own; the last of them, without the segments, which KMeans makes."""
    t = StarTables(spark, folder)
    inputs = {
        "users": t.users,
        "orders": t.orders,
        "order_items": t.order_items,
        "products": t.products,
        "events": t.views_only,
    }
    options = {
        "user_segments": {"completed": COMPLETED, "bad": BAD, "partitions": 8},
        "user_consumption_profile": {"completed": COMPLETED},
        "trending_products": {"orders_as_of": ORDERS_TODAY},
        "product_complementary": {"min_count": MIN_COUNT},
    }
    views = run_batch(inputs, _scratch(spark, "batch-views"), EVENTS_TODAY, options)
    return views["user_recommendations_batch"].drop("computed_date", "segment_name")


def _after_two_runs(spark: SparkSession, folder: str, name: str) -> tuple[StarTables, str]:
    """The stores of the daily run after a run on what there was some days ago and one on all, told what has arrived since."""
    t = StarTables(spark, folder)
    store = _scratch(spark, name)

    def since(day, days: int):
        return datetime(day.year, day.month, day.day, tzinfo=timezone.utc) - timedelta(days=days)

    # test orders end years before their "today", so what arrives is the last of their dates
    first = t.orders.agg(F.max("order_date").alias("newest")).first()["newest"]
    new_orders = F.col("order_date") >= F.lit(since(first or ORDERS_TODAY, LATE_DAYS))
    new_events = F.col("event_timestamp") >= F.lit(since(EVENTS_TODAY, LATE_DAYS))
    whole = {"orders": t.orders, "order_items": t.order_items, "events": t.views_only}
    earlier = {**whole, "orders": t.orders.filter(~new_orders), "events": t.views_only.filter(~new_events)}
    update_partials(earlier, store, 1, completed=COMPLETED)
    arrivals = {"orders": t.orders.filter(new_orders), "events": t.views_only.filter(new_events)}
    update_partials(whole, store, 2, arrivals, COMPLETED)
    return t, store


def daily_consumption_profile(spark: SparkSession, folder: str) -> DataFrame:
    t, store = _after_two_runs(spark, folder, "daily-profile")
    return _with_lists_joined(daily_profile(t.customers, t.products, store))


def daily_trending_products(spark: SparkSession, folder: str) -> DataFrame:
    _, store = _after_two_runs(spark, folder, "daily-trends")
    return daily_trending(spark, store, EVENTS_TODAY, orders_as_of=ORDERS_TODAY)


def activity_events(spark: SparkSession, folder: str) -> DataFrame:
    moment = F.unix_micros("event_timestamp").alias("event_micros")
    return parse_activity_events(StarTables(spark, folder).messages).select(
        "user_id", "product_id", "product_name", "category", "event_type", moment
    )


def sliding_user_interest(spark: SparkSession, folder: str) -> DataFrame:
    rows = I.sliding_user_interest(StarTables(spark, folder).activity)
    end = F.col("window.end").cast("long").alias("window_end")
    return rows.select(end, *[c for c in rows.columns if c != "window"])


def realtime_trend_score(spark: SparkSession, folder: str) -> DataFrame:
    return I.realtime_trend_score(I.sliding_user_interest(StarTables(spark, folder).activity))


def realtime_view(spark: SparkSession, folder: str) -> DataFrame:
    """The whole table as one micro-batch."""
    return I.trailing_window(realtime_trend_score(spark, folder))


def expired_view(spark: SparkSession, folder: str) -> DataFrame:
    return expire_realtime_view(realtime_view(spark, folder), REALTIME_NOW, 86_400)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"


def _message_stream(spark: SparkSession, name: str, messages: DataFrame) -> DataFrame:
    inbox = _scratch(spark, f"{name}-in")
    messages.write.text(inbox)
    return spark.readStream.format("text").load(inbox)


def speed_layer(spark: SparkSession, folder: str) -> DataFrame:
    """The streaming query over the event table's messages, run until they are used up."""
    target = _scratch(spark, "realtime-view")
    source = _message_stream(spark, "speed", StarTables(spark, folder).messages)
    start_speed_layer(source, target, _scratch(spark, "speed-state"), {"availableNow": True}).awaitTermination()
    return read_realtime_view(spark, target)


def _shuffled_stream(spark: SparkSession, folder: str, name: str, **store) -> str:
    """A view's folder after the streaming query over the event table's messages, dealt by hash to BATCHES micro-batches, so that
    each holds events of all times. The watermark is wider than the table."""
    inbox, target = _scratch(spark, f"{name}-in"), _scratch(spark, name)
    StarTables(spark, folder).messages.repartition(BATCHES, "value").write.text(inbox)
    source = read_message_files(stream_session(spark), inbox, max_files_per_trigger=1)
    query = start_speed_layer(
        source, target, _scratch(spark, f"{name}-state"), {"availableNow": True}, watermark="1000 days", fan_in=2, **store
    )
    query.awaitTermination()
    return target


def speed_layer_batches(spark: SparkSession, folder: str) -> DataFrame:
    """The view after several micro-batches that come out of order, its folders merged on the way."""
    return read_realtime_view(spark, _shuffled_stream(spark, folder, "batches-view", slice_seconds=WEEK))


def live_view(spark: SparkSession, folder: str) -> DataFrame:
    """The view that a stream with the usual time to live has left on disk, at REALTIME_NOW."""
    target = _shuffled_stream(spark, folder, "live-view", ttl_seconds=TTL_SECONDS, now=lambda: REALTIME_NOW)
    return read_realtime_view(spark, target, REALTIME_NOW)


def stored_trending(spark: SparkSession, folder: str) -> DataFrame:
    return V.serve_trending(speed_layer_batches(spark, folder))


def stored_trend_history(spark: SparkSession, folder: str) -> DataFrame:
    target = _shuffled_stream(spark, folder, "history-view", slice_seconds=WEEK)
    return V.trend_history(read_windows(spark, target), minutes=None)


def upserted_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per user as of one day, then the users with later orders put in by another snapshot."""
    orders = StarTables(spark, folder).orders
    target = _scratch(spark, "snapshot")

    def counted(rows: DataFrame) -> DataFrame:
        return rows.groupBy("user_id").agg(F.count("*").alias("n_orders"), F.max("order_date").cast("date").cast("string").alias("newest"))

    early = F.col("order_date") < F.lit(SNAPSHOT_DAY).cast("timestamp")
    upsert_snapshot(counted(orders.filter(early)), target, ["user_id"], 1)
    upsert_snapshot(counted(orders.filter(~early)), target, ["user_id"], 2)
    return read_snapshot(spark, target)


def raw_event_append(spark: SparkSession, folder: str) -> DataFrame:
    """The plain append stream over the event table's messages, run until they are used up."""
    target = _scratch(spark, "raw-events")
    source = _message_stream(spark, "raw", StarTables(spark, folder).messages)
    start_raw_append(
        source, target, _scratch(spark, "raw-state"), ACTIVITY_MESSAGE, {"availableNow": True}
    ).awaitTermination()
    return spark.read.schema(ACTIVITY_MESSAGE).parquet(target)


def serve_trending(spark: SparkSession, folder: str) -> DataFrame:
    return V.serve_trending(realtime_view(spark, folder))


def serve_realtime_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return V.serve_realtime_recommendations(realtime_view(spark, folder))


def serve_batch_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    served = V.serve_batch_recommendations(user_recommendations(spark, folder, by_user=True))

    def told(entry):
        return F.concat_ws(
            ":", entry["product_id"].cast("string"), entry["category"], entry["recommendation_type"]
        )

    return served.select(
        "user_id",
        "segment_name",
        F.size("recommendations").cast("long").alias("n"),
        F.array_join(F.transform("recommendations", told), "|").alias("recommendations"),
        "part",
    )


def potential_customers(spark: SparkSession, folder: str) -> DataFrame:
    return V.potential_customers(user_recommendations(spark, folder))


def potential_customers_top(spark: SparkSession, folder: str) -> DataFrame:
    return V.potential_customers(user_recommendations(spark, folder), n=10)


def trend_history(spark: SparkSession, folder: str) -> DataFrame:
    return V.trend_history(realtime_trend_score(spark, folder), minutes=None)


def trend_history_recent(spark: SparkSession, folder: str) -> DataFrame:
    return V.trend_history(realtime_trend_score(spark, folder))


def product_counts(spark: SparkSession, folder: str) -> DataFrame:
    return V.product_counts(StarTables(spark, folder).order_items)


QUERIES: dict[str, Query] = {
    "user_order_features": order_features,
    "segment_clusters": segment_clusters,
    "label_segments": label_segments,
    "user_segments": user_segments,
    "avg_order_value": avg_order_value,
    "monthly_spending": monthly_spending,
    "latest_month_spending": latest_month_spending,
    "latest_month_items": latest_month_items,
    "user_consumption_profile": user_consumption_profile,
    "view_growth": view_growth,
    "order_growth": order_growth,
    "trending_products": trending_products,
    "top_trending": top_trending,
    "product_similarity": product_similarity,
    "baskets": baskets,
    "copurchase_rules": copurchase_rules,
    "product_complementary": product_complementary,
    "consumption_base": consumption_base,
    "rec_candidates": rec_candidates,
    "score_candidates": score_candidates,
    "user_recommendations": user_recommendations,
    "run_batch": batch_chain,
    "daily_consumption_profile": daily_consumption_profile,
    "daily_trending_products": daily_trending_products,
    "parse_activity_events": activity_events,
    "sliding_user_interest": sliding_user_interest,
    "realtime_trend_score": realtime_trend_score,
    "upsert_realtime_view": realtime_view,
    "expire_realtime_view": expired_view,
    "run_speed_layer": speed_layer,
    "run_speed_layer_batches": speed_layer_batches,
    "live_realtime_view": live_view,
    "stored_serve_trending": stored_trending,
    "stored_trend_history": stored_trend_history,
    "upsert_snapshot": upserted_snapshot,
    "raw_event_append": raw_event_append,
    "serve_trending": serve_trending,
    "serve_realtime_recommendations": serve_realtime_recommendations,
    "serve_batch_recommendations": serve_batch_recommendations,
    "potential_customers": potential_customers,
    "potential_customers_top": potential_customers_top,
    "trend_history": trend_history,
    "trend_history_recent": trend_history_recent,
    "product_counts": product_counts,
}
