"""Readers: CSV tables with declared schemas, views in any format, the activity topic."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoptide.schemas import HEADER_ALIASES, TABLES


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_csv_table(spark: SparkSession, path: str, schema: StructType, aliases: dict = HEADER_ALIASES) -> DataFrame:
    """CSV with a header line, matched to ``schema`` by column name.

    Extra columns are not parsed, missing ones are null, and a value that does not fit its type is null.
    """
    raw = spark.read.csv(path, header=True)
    present = {aliases.get(name, name): name for name in reversed(raw.columns)}
    columns = [
        F.col(f"`{present[f.name]}`").try_cast(f.dataType).alias(f.name)
        if f.name in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return raw.select(*columns)


def read_or_none(read) -> DataFrame | None:
    """Result of ``read()``, or None if its path does not exist. Any other failure is raised."""
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_inputs(spark: SparkSession, root: str, fmt: str = "csv", optional: Collection[str] = ("events",)) -> dict[str, DataFrame]:
    """The tables the batch chain reads. Those in ``optional`` may be absent: then the table is empty.

    Products can be named there for runs that only need what stands without them, such as trends; a missing
    catalogue is an error otherwise, so that no view is replaced by an empty one unasked.
    """
    inputs = {}
    for name in ("users", "orders", "order_items", "products", "events"):
        schema = TABLES[name]

        def read(name=name, schema=schema):
            if fmt == "csv":
                return read_csv_table(spark, f"{root}/{name}.csv", schema)
            return spark.read.schema(schema).format(fmt).load(f"{root}/{name}")

        table = read_or_none(read) if name in optional else read()
        inputs[name] = empty_table(spark, schema) if table is None else table
    return inputs


def read_view(spark: SparkSession, location: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """A view from any batch source on the classpath; ``options`` go to the source as they are."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(location) if location is not None else reader.load()


def read_activity_topic(
    spark: SparkSession,
    servers: str,
    topic: str = "user-activity-events",
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """The activity topic as a stream with a binary ``value``; needs the Kafka source on the classpath."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text files, one JSON message per line, as a stream with a string ``value``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
