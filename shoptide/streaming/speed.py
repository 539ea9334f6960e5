"""The speed layer's streaming queries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from shoptide.schemas import RAW_MESSAGE
from shoptide.streaming.events import parse_activity_events, parse_messages
from shoptide.streaming.interest import TRAIL_SECONDS, WATERMARK, realtime_trend_score, sliding_user_interest
from shoptide.streaming.view import TTL_SECONDS, upsert_realtime_view

TRIGGER = {"processingTime": "30 seconds"}


def start_speed_layer(
    source: DataFrame,
    target: str,
    checkpoint: str,
    trigger: dict | None = None,
    value_col: str = "value",
    watermark: str = WATERMARK,
    ttl_seconds: int | None = None,
    now: Callable[[], float] = time.time,
    **store: int,
) -> StreamingQuery:
    """Messages -> sliding interest -> score -> realtime view, in update mode.

    With ``ttl_seconds``, what has expired by ``now()``, that long after its window, leaves the view's files as batches come in; without,
    all is kept. ``store`` goes to ``upsert_realtime_view``.

    The number of shuffle partitions is fixed by the first run against a checkpoint; set it for the
    cluster before that. ``speed_input`` in the query's progress counts messages and unusable ones.
    """
    events = parse_activity_events(source, value_col).observe(
        "speed_input",
        F.count(F.lit(1)).alias("messages"),
        F.count_if(F.col("event_timestamp").isNull()).alias("unusable"),
    )
    scored = realtime_trend_score(sliding_user_interest(events, watermark=watermark))

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # what a key's window is chosen over reaches a trail further back
        expired = None if ttl_seconds is None else int(now()) - ttl_seconds - TRAIL_SECONDS
        upsert_realtime_view(batch, batch_id, target, expired, **store)

    return (
        scored.writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .start()
    )


def start_raw_append(
    source: DataFrame,
    target: str,
    checkpoint: str,
    schema: StructType = RAW_MESSAGE,
    trigger: dict | None = None,
    value_col: str = "value",
) -> StreamingQuery:
    """Parsed messages appended to Parquet as they come."""
    writer = (
        parse_messages(source, schema, value_col)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_console(source: DataFrame, value_col: str = "value", trigger: dict | None = None) -> StreamingQuery:
    """Parsed events on the console, for debugging."""
    return (
        parse_activity_events(source, value_col)
        .writeStream.outputMode("append")
        .format("console")
        .option("truncate", "false")
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def run_speed_layer(
    source: DataFrame, target: str, checkpoint: str, debug: bool = False, ttl_seconds: int | None = TTL_SECONDS, **options
) -> None:
    """Run the speed layer until any of its queries ends. Rows leave the view ``ttl_seconds`` after their window."""
    source.sparkSession.streams.resetTerminated()  # those that ended before are not waited for
    start_speed_layer(source, target, checkpoint, ttl_seconds=ttl_seconds, **options)
    if debug:
        start_console(source)
    source.sparkSession.streams.awaitAnyTermination()
