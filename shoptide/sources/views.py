"""Writers: overwrite, committed versions, keyed upsert, CSV."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shoptide.sources.commits import Commits

KEEP = 2


def write_view(
    view: DataFrame, location: str, fmt: str = "parquet", sort_by: Sequence[str] = (), **options: str
) -> None:
    """Replace the view at ``location``.

    ``sort_by`` names the columns that readers look rows up by: sorted inside each file, without another
    shuffle, its blocks hold narrow ranges of them and a lookup skips nearly all blocks.
    """
    if sort_by:
        view = view.sortWithinPartitions(*sort_by)
    view.write.mode("overwrite").format(fmt).options(**options).save(location)


def write_csv(view: DataFrame, location: str) -> None:
    view.write.mode("overwrite").csv(location, header=True)


def merge_by_key(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``updates`` put in place of those with the same keys."""
    kept = existing.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*updates.columns).unionByName(updates)


def commit_view(
    view: DataFrame, location: str, version: int, sort_by: Sequence[str] = (), keep: int = KEEP
) -> None:
    """Write the view beside the versions that are there, then make it the newest one.

    Who reads an older version goes on with it; a write that fails leaves that one current. ``sort_by`` as in ``write_view``.
    """
    commits = Commits(view.sparkSession, location)
    name = f"v{version}-{uuid.uuid4().hex}"
    if sort_by:
        view = view.sortWithinPartitions(*sort_by)
    view.write.parquet(f"{commits.location}/{name}")
    commits.commit(version, {"path": name, "schema": view.schema.json()})
    commits.prune(keep, lambda content: [content["path"]])


def committed_version(spark: SparkSession, location: str) -> int | None:
    found = Commits(spark, location).latest()
    return found and found[0]


def read_committed(spark: SparkSession, location: str, below: int | None = None) -> DataFrame | None:
    """The newest committed version, or the newest before the version ``below``; None if there is none. The commit names
    its folder, so no other version is listed or read."""
    commits = Commits(spark, location)
    found = commits.latest(below)
    if found is None:
        return None
    schema = StructType.fromJson(json.loads(found[1]["schema"]))
    return spark.read.schema(schema).parquet(f"{commits.location}/{found[1]['path']}")


def read_snapshot(spark: SparkSession, location: str) -> DataFrame | None:
    """The newest snapshot written by ``upsert_snapshot``, or None."""
    return read_committed(spark, location)


def upsert_snapshot(updates: DataFrame, location: str, keys: Sequence[str], version: int) -> None:
    """Merge ``updates`` into the newest snapshot before ``version`` and commit that as ``version``.

    The old snapshot stays as it is, so a failed write loses nothing and a repeated one
    starts from the same state.
    """
    older = read_committed(updates.sparkSession, location, below=version)
    commit_view(updates if older is None else merge_by_key(older, updates, keys), location, version)
