"""The realtime view: one row per user and product, kept as a log of committed folders that are merged as they become many.

A micro-batch writes the windows that it changed to a new folder, by slices of time, and commits: the state is the list of slice folders that
count (``sources/commits.py``). Readers open those folders alone, and of them only the slices that may hold what they ask for; they take each window's newest row and
choose a key's window over all of them, so events may come in any order.

FAN_IN folders of one slice and level are merged into one of the next level, in the commit of the batch that made them as many. A row is so
rewritten a logarithmic number of times, and a slice has less than FAN_IN folders a level. With a time to live, rows that have
expired are not written, a merge leaves them out, and a slice that has expired whole leaves the state and then the disk.

A batch repeated after a failure adds the same rows once more, which changes nothing. A failure at any point leaves the last state.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shoptide.functions.clock import epoch_ms
from shoptide.schemas import REALTIME_VIEW
from shoptide.sources.commits import Commits
from shoptide.sources.tables import empty_table
from shoptide.streaming.interest import TRAIL_SECONDS, trailing_window

_BATCH, _SLICE, _TASK = "batch_id", "slice", "_task"
TTL_SECONDS = 600
SLICE_SECONDS = 3_600
FAN_IN = 8
KEEP = 10
# what a task of the write holds: whichever of the two is reached first
TASK_ROWS, TASK_SLICES = 200_000, 16
_KEY = ("user_id", "product_id", "computed_time", "product_name", "category")
STORED = StructType([*REALTIME_VIEW.fields, StructField(_BATCH, LongType())])


def upsert_realtime_view(
    batch: DataFrame,
    batch_id: int,
    target: str,
    expired: int | None = None,
    slice_seconds: int = SLICE_SECONDS,
    fan_in: int = FAN_IN,
    keep: int = KEEP,
) -> None:
    """Store all window rows that the batch updated. A failed write fails the batch, which is then repeated.

    Rows with a ``computed_time`` (epoch seconds) up to ``expired`` need not be kept. ``slice_seconds`` belongs to the target.
    ``keep`` commits can still be read after this one.
    """
    commits = Commits(batch.sparkSession, target)
    version, state = commits.latest() or (0, {"slice_seconds": slice_seconds, "folders": []})
    width = state["slice_seconds"]
    if width != slice_seconds:
        raise ValueError(f"{target} has slices of {width} seconds")
    alive = [f for f in state["folders"] if expired is None or (f["slice"] + 1) * width > expired]
    rows = batch.select(*REALTIME_VIEW.names, F.lit(batch_id).cast("long").alias(_BATCH))
    # the batch is computed once, for this copy, which a failure leaves to ``prune``; what it holds tells what is merged
    copy = f"flat-batch-{batch_id}-{uuid.uuid4().hex}"
    _unexpired(rows, expired).write.parquet(f"{commits.location}/{copy}")
    new = [{"path": copy, "slice": s, "level": 0} for s in _sizes(_read(commits, [copy]), width)]
    folders = _merged(alive + new, fan_in)
    kept, made = [f for f in folders if f["path"] not in (None, copy)], [f for f in folders if f["path"] in (None, copy)]
    for level in sorted({f["level"] for f in made}):
        name = f"{'merged' if level else 'batch'}-{batch_id}"
        kept += _write_slices(commits, [f for f in made if f["level"] == level], name, width, level, expired)
    commits.remove(copy)
    if kept != state["folders"]:
        commits.commit(version + 1, {"slice_seconds": width, "folders": kept})
        commits.prune(keep, lambda content: [f["path"] for f in content["folders"]])


def _merged(folders: list[dict], fan_in: int) -> list[dict]:
    """The folders after all merges. One that a merge has yet to make has no path but those of all that go into it, so that a row that
    passes several levels is written once."""
    level = 0
    while True:
        slices = defaultdict(list)
        for f in folders:
            if f["level"] == level:
                slices[f["slice"]].append(f)
        many = {s: group for s, group in slices.items() if len(group) >= fan_in}
        folders = [f for f in folders if f["level"] != level or f["slice"] not in many]
        for s, group in many.items():
            parts = [path for f in group for path in f.get("of", [f["path"]])]
            folders.append({"path": None, "slice": s, "level": level + 1, "of": parts})
        if not any(f["level"] > level for f in folders):
            return folders
        level += 1


def _unexpired(rows: DataFrame, expired: int | None) -> DataFrame:
    return rows if expired is None else rows.filter(F.col("computed_time") > expired)


def _slice(width: int) -> Column:
    """The slice of a row: it holds the windows that end after its begin and up to its end."""
    return F.floor((F.col("computed_time") - 1) / width)


def _sizes(rows: DataFrame, width: int) -> dict[int, int]:
    """Rows of each slice, by one column."""
    counted = rows.groupBy(_slice(width).alias(_SLICE)).agg(F.count("*").alias("rows"))
    return {int(r[_SLICE]): r["rows"] for r in counted.collect()}


def _tasks(sizes: dict[int, int]) -> tuple[list[tuple[int, int, int]], int]:
    """(slice, its first task, how many it has), and the number of all tasks. A large slice has several of its own, small ones share one."""
    placed, task, rows, slices = [], -1, TASK_ROWS, 0
    for s in sorted(sizes):
        if rows + sizes[s] > TASK_ROWS or slices == TASK_SLICES:
            task, rows, slices = task + 1, 0, 0
        many = max(1, -(-sizes[s] // TASK_ROWS))
        placed.append((s, task, many))
        task, rows, slices = task + many - 1, rows + sizes[s], slices + 1
    return placed, task + 1


def _write_slices(commits: Commits, made: list[dict], name: str, width: int, level: int, expired: int | None) -> list[dict]:
    """The folders written for those to be made, of one level: a new batch's rows as they are, and merged folders.

    Every task of a batch holds rows of every slice, so written as they come they would make a file for each task and slice. All rows of a
    window go to one task of its slice instead, where they are merged: about a file for each slice, and for each task of a large one.
    """
    paths = sorted({path for f in made for path in f.get("of", [f["path"]])})
    rows = _unexpired(_read(commits, paths), expired)
    wanted = {f["slice"] for f in made}
    placed, tasks = _tasks({s: n for s, n in _sizes(rows, width).items() if s in wanted})
    if not placed:
        return []
    name = f"{name}-{uuid.uuid4().hex}"
    places = rows.sparkSession.createDataFrame(placed, f"{_SLICE} long, _first int, _many int")
    place = F.col("_first") + F.pmod(F.xxhash64("user_id", "product_id", "computed_time"), F.col("_many")).cast("int")
    sliced = (
        rows.withColumn(_SLICE, _slice(width))
        .join(F.broadcast(places), _SLICE)
        .withColumn(_TASK, place)
        .drop("_first", "_many")
        .repartitionById(tasks, _TASK)
    )
    if level:
        # by time first, a number that parts most rows at once
        sliced = latest_windows(sliced, keep_batch=True, key=("computed_time", *(c for c in _KEY if c != "computed_time"), _SLICE, _TASK))
    sliced.drop(_TASK).write.partitionBy(_SLICE).parquet(f"{commits.location}/{name}")
    parts = commits.folders(name)
    return [{"path": f"{name}/{part}", "slice": int(part.split("=")[1]), "level": level} for part in parts]


def _read(commits: Commits, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return empty_table(commits.spark, STORED)
    return commits.spark.read.schema(STORED).parquet(*(f"{commits.location}/{path}" for path in paths))


def latest_windows(deltas: DataFrame, keep_batch: bool = False, key: Sequence[str] = _KEY) -> DataFrame:
    """Each window's newest row. A late event changes windows of the past; a window's counts only ever grow, so
    the row with most events is the newest, whichever batch brought it, and of equals that of the later batch.

    ``key`` is the order in which rows are sorted for it, and may end on columns that follow from the window."""
    values = [c for c in deltas.columns if c not in key and (keep_batch or c != _BATCH)]
    age = F.struct(F.col("view_count") + F.col("cart_count") + F.col("purchase_count"), _BATCH)
    return (
        deltas.groupBy(*key)
        .agg(F.max_by(F.struct(*values), age).alias("_row"))
        .select(*key, "_row.*")
        .select(*[c for c in deltas.columns if c in (*key, *values)])
    )


def read_windows(spark: SparkSession, target: str, after: int | None = None) -> DataFrame:
    """All windows stored at ``target``, one row each; with ``after`` only those that end later, from the slices that hold such."""
    return latest_windows(_stored(spark, target, after))


def _stored(spark: SparkSession, target: str, after: int | None) -> DataFrame:
    commits = Commits(spark, target)
    found = commits.latest()
    folders = found[1]["folders"] if found else []
    if after is not None and found:
        folders = [f for f in folders if (f["slice"] + 1) * found[1]["slice_seconds"] > after]
    return _unexpired(_read(commits, [f["path"] for f in folders]), after)


def read_realtime_view(
    spark: SparkSession,
    target: str,
    as_of: date | datetime | int | None = None,
    ttl_seconds: int = TTL_SECONDS,
    trail_seconds: int = TRAIL_SECONDS,
) -> DataFrame:
    """The view at ``target``: per user and product the window right after the newest event, chosen over all
    stored windows; with ``as_of`` without the rows that have expired by then."""
    # a row that is alive has nothing older than its trail to be chosen over
    after = None if as_of is None else _seconds(as_of) - ttl_seconds - trail_seconds
    # a window's rows and a key's windows are chosen on one shuffle and one sort
    windows = latest_windows(_stored(spark, target, after).repartition("user_id", "product_id"))
    view = trailing_window(windows, trail_seconds)
    return view if as_of is None else expire_realtime_view(view, as_of, ttl_seconds)


def _seconds(moment: date | datetime | int) -> int:
    return moment if isinstance(moment, int) else epoch_ms(moment) // 1000


def expire_realtime_view(
    view: DataFrame, as_of: date | datetime | int, ttl_seconds: int = TTL_SECONDS
) -> DataFrame:
    """Rows not older than the time to live at ``as_of`` (a moment, or epoch seconds)."""
    return view.filter(F.col("computed_time") > _seconds(as_of) - ttl_seconds)
