"""Messages of the activity topic to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoptide.schemas import ACTIVITY_MESSAGE


def parse_messages(raw: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """JSON messages as columns; a malformed message becomes a row of nulls."""
    return raw.select(F.from_json(F.col(value_col).cast("string"), schema).alias("data")).select("data.*")


def parse_activity_events(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Activity messages with ``event_timestamp`` (epoch milliseconds) made a timestamp."""
    moment = (F.col("event_timestamp") / 1000).try_cast("timestamp")
    return parse_messages(raw, ACTIVITY_MESSAGE, value_col).withColumn("event_timestamp", moment)
