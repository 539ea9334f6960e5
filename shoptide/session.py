"""A session with the settings the operators are written for.

The operators never read or change settings. Everything here can be set by the
submitting side just as well; the master is always left to it.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# streaming state off the heap; counting its rows as they come would look every key up a second time
STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}

SETTINGS = {
    # dates and windows are cut in UTC
    "spark.sql.session.timeZone": "UTC",
    # runtime re-planning: join strategy by measured size, splitting of skewed join partitions
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # prune the fact side of a selective join before it is shuffled
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    **STATE,
}


def build_session(app_name: str = "shoptide", **settings: str) -> SparkSession:
    """Session with SETTINGS, then ``settings`` (dots written as double underscores)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def stream_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` with its settings and STATE, so that a stream's state does not depend on how ``spark`` was set up."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key):
            own.conf.set(key, value)
    for key, value in STATE.items():
        own.conf.set(key, value)
    return own
