"""Frames settled in the shared folder: Parquet that later steps read, also after executors are lost."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def narrow_batches(spark: SparkSession, size: str = "4m") -> None:
    """From now on the session's Arrow batches hold at most ``size``, instead of ten thousand texts whatever their length. A batch
    stands in the JVM and in the Python worker at once, for each task. Results do not depend on it."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the cluster's checkpoint folder. Only a local session may lack one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` computed once, written, and read back with its schema."""
    path = shared_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the files of a settled frame that nothing reads any more."""
    spark = frame.sparkSession
    for file in frame.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
