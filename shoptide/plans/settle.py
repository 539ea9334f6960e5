"""Materialising a frame that later steps read several times, where a lost executor cannot take it."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder. Only a local session without one gets a folder of its own."""
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="shoptide-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def settle(frame: DataFrame) -> DataFrame:
    """``frame`` computed once and written to the checkpoint folder."""
    checkpoint_root(frame.sparkSession)
    return frame.checkpoint()


def side_by_side(*steps: Callable[[], object]) -> list:
    """Results of steps that do not depend on each other, run at the same time so that one step's
    last tasks do not leave the cluster idle. The first failure is raised."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [step.result() for step in [pool.submit(step) for step in steps]]
