"""The star-schema test tables in the shape of the retail tables.

Order status F stands for completed and P for a bad order. The click stream's product is
``props.k``; a click there is a cart event here. Customers sign up with their first order.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPLETED = ("F",)
BAD = ("P",)

# Orders and events end more than twenty years apart, so each has its own "today".
ORDERS_TODAY = date(2001, 8, 1)
EVENTS_TODAY = date(2024, 1, 30)

_COLUMNS = {
    "customer": "c_custkey long",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double",
    "part": "p_partkey long, p_name string, p_brand string, p_retailprice double",
    "events": "event_id long, ts timestamp, user_id long, event_type string, props string",
}


class StarTables:
    """Lazy frames over the Parquet files of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_COLUMNS[name]).parquet(f"{self.folder}/{name}.parquet")

    @property
    def orders(self) -> DataFrame:
        return self._read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").alias("order_date"),
            F.col("o_orderstatus").alias("order_status"),
            F.col("o_totalprice").alias("total_amount"),
        )

    @property
    def users(self) -> DataFrame:
        customers = self._read("customer").select(F.col("c_custkey").alias("user_id"))
        first = self.orders.groupBy("user_id").agg(F.to_date(F.min("order_date")).alias("signup_date"))
        return customers.join(first, "user_id", "left")

    @property
    def customers(self) -> DataFrame:
        """Users without a signup date, for operators that do not read it."""
        return self._read("customer").select(F.col("c_custkey").alias("user_id"))

    @property
    def order_items(self) -> DataFrame:
        return self._read("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").alias("quantity"),
        )

    @property
    def products(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_brand").alias("category"),
            F.col("p_retailprice").alias("price"),
        )

    @property
    def events(self) -> DataFrame:
        kind = F.col("event_type")
        return self._read("events").select(
            "event_id",
            "user_id",
            F.get_json_object("props", "$.k").cast("long").alias("product_id"),
            F.when(kind == "click", "cart").otherwise(kind).alias("event_type"),
            F.col("ts").alias("event_timestamp"),
        )

    @property
    def views_only(self) -> DataFrame:
        """View events alone, filtered on the stored column so that the scan sees it."""
        views = self._read("events").filter(F.col("event_type") == "view")
        return views.select(
            F.get_json_object("props", "$.k").cast("long").alias("product_id"),
            "event_type",
            F.col("ts").alias("event_timestamp"),
        )

    @property
    def activity(self) -> DataFrame:
        """The events with the name and category of their product."""
        named = self.products.select("product_id", "product_name", "category")
        return self.events.join(named, "product_id", "left").select(
            "user_id", "product_id", "product_name", "category", "event_type", "event_timestamp"
        )

    @property
    def messages(self) -> DataFrame:
        """The events as JSON messages of the activity topic."""
        message = F.struct(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("product_id").cast("string").alias("product_id"),
            "product_name",
            "category",
            "event_type",
            F.unix_millis("event_timestamp").cast("double").alias("event_timestamp"),
        )
        return self.activity.select(F.to_json(message).alias("value"))
