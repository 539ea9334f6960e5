"""Partial results kept by period (a day, a month), so that a run recomputes the periods that changed and reads the others as they are.

A store is a view of ``Commits``: a commit names one folder for each period. Recomputed periods are written aside in one job and replace their
old folders in the next commit, so a run that fails leaves the last state whole and one that is repeated ends in the same state.
Rows without a period are kept under ``UNDATED``. A commit lists one line a period: some thousand for ten years of days.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shoptide.sources.commits import Commits

UNDATED = "none"
DAY, MONTH = "yyyy-MM-dd", "yyyy-MM"
RANGES = 64  # of a condition on dates
_SLICE = "slice"


def period_of(moment: Column, period: str) -> Column:
    """The name of the period that a moment lies in, in the session's time zone."""
    return F.coalesce(F.date_format(moment.try_cast("timestamp"), period), F.lit(UNDATED))


def within_periods(moment: Column, names: Collection[str] | None) -> Column:
    """True for moments in the named periods, and for all of them for None. Neighbouring periods make one range on the
    plain column, so that the condition reaches the scan. It limits what is read: of many scattered periods, those with the
    smallest gaps between them share a range, gaps included, so that there are at most ``RANGES``."""
    if names is None:
        return F.lit(True)
    ranges: list[list[date]] = []
    for name in sorted(set(names) - {UNDATED}):
        start, end = _days(name)
        if ranges and ranges[-1][1] >= start:
            ranges[-1][1] = max(ranges[-1][1], end)
        else:
            ranges.append([start, end])
    gaps = sorted(range(1, len(ranges)), key=lambda k: ranges[k][0] - ranges[k - 1][1], reverse=True)
    cuts = [0, *sorted(gaps[: RANGES - 1]), len(ranges)]
    found = moment.isNull() if UNDATED in names else F.lit(False)
    for k, upto in zip(cuts, cuts[1:]):
        if k < upto:
            start, end = (F.lit(str(day)).cast("timestamp") for day in (ranges[k][0], ranges[upto - 1][1]))
            found = found | ((moment >= start) & (moment < end))
    return found


def _days(name: str) -> tuple[date, date]:
    """The first day of a period and the first one after it."""
    if len(name) > len("yyyy-mm"):
        first = date.fromisoformat(name)
        return first, first + timedelta(days=1)
    year, month = (int(x) for x in name.split("-"))
    return date(year, month, 1), date(year + month // 12, month % 12 + 1, 1)


def periods_in(moments: DataFrame, period: str) -> list[str]:
    """The periods of a frame's only column. As many as there are, whatever the number of rows."""
    names = moments.select(period_of(F.col(moments.columns[0]), period).alias("name")).distinct()
    return sorted(row["name"] for row in names.collect())


def refresh(
    spark: SparkSession,
    location: str,
    version: int,
    names: Collection[str] | None,
    compute: Callable[[], DataFrame],
    period: str,
    key: str,
    keep: int = 2,
) -> None:
    """Put the rows of ``compute()``, whose column ``period`` names their period, in place of what is kept of ``names`` (of all for None).

    A named period without rows is kept no longer. Rows of other periods than those named are not taken. ``key`` is the column by which
    a file's rows are sorted. Nothing is read or written if no period is named.
    """
    commits = Commits(spark, location)
    latest = commits.latest()
    held = {} if latest is None or names is None else dict(latest[1]["periods"])
    if names is not None and not names and latest is not None:
        return
    rows = compute()
    schema = rows.schema
    if names is not None:
        rows = rows.filter(F.col(period).isin(*names) if names else F.lit(False))
    folder = f"p{version}-{uuid.uuid4().hex}"
    # one file for a small period; adaptive execution cuts a large one by size, so that it is not written by one task
    dealt = rows.withColumn(_SLICE, F.col(period)).hint("rebalance", _SLICE)
    dealt.sortWithinPartitions(_SLICE, key).write.partitionBy(_SLICE).parquet(f"{commits.location}/{folder}")
    written = {part.split("=", 1)[1]: f"{folder}/{part}" for part in commits.folders(folder)}
    held = {name: path for name, path in held.items() if name not in names} if names is not None else {}
    content = {"periods": {**held, **written}, "schema": schema.json()}
    commits.commit(version, content)
    commits.prune(keep, lambda state: state["periods"].values())


def kept_periods(spark: SparkSession, location: str) -> list[str] | None:
    """Names of the periods that are kept; None if nothing has been committed."""
    latest = Commits(spark, location).latest()
    return None if latest is None else sorted(latest[1]["periods"])


def read_partials(spark: SparkSession, location: str, low: str | None = None, high: str | None = None) -> DataFrame:
    """The rows kept, or those of the periods from ``low`` to ``high``, both included. Other folders are neither listed nor read."""
    commits = Commits(spark, location)
    latest = commits.latest()
    if latest is None:
        raise ValueError(f"nothing has been committed at {location}")
    state = latest[1]
    chosen = [path for name, path in sorted(state["periods"].items()) if (low is None or name >= low) and (high is None or name <= high)]
    schema = StructType.fromJson(json.loads(state["schema"]))
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{commits.location}/{path}" for path in chosen])
