"""Spreading of hot keys.

One key may hold a third of all rows. Adaptive execution splits such a key only
where both join sides come straight out of a shuffle; a side that is itself an
aggregate on the join key does not. The helpers here do it in the plan instead.

A key is hot when it has more than ``min_rows`` rows and is among the ``max_keys``
largest. So what is broadcast has at most ``max_keys`` rows whatever the size of the
data, and a key left whole has at most ``max(min_rows, all rows / max_keys)`` rows. A hot
key is cut into slots of about ``min_rows`` rows, and the other side's rows of the key are
copied to each, one copy per that many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_HOT_KEYS = 20_000
MIN_HOT_ROWS = 1_000_000
# where one row becomes twenty and more
FAN_OUT_ROWS = 50_000
NULL_SLOTS = 1_024

_SLOT, _PARTS = "_slot", "_parts"


def count_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key as (keys, n); rows without a key are left out, ``add_slot`` spreads those anyway."""
    known = rows.na.drop(subset=list(keys))
    return known.groupBy(*keys).agg(F.count("*").alias("n"))


def hot_keys(
    counts: DataFrame, keys: Sequence[str], min_rows: int = MIN_HOT_ROWS, max_keys: int = MAX_HOT_KEYS
) -> DataFrame:
    """Hot keys of ``counts`` (one row per key, row count in ``n``) with their number of slots."""
    largest = counts.filter(F.col("n") > min_rows).orderBy(F.desc("n"), *keys).limit(max_keys)
    return largest.select(*keys, F.ceil(F.col("n") / min_rows).cast("int").alias(_PARTS))


def add_slot(rows: DataFrame, keys: Sequence[str], hot: DataFrame, slot: str = _SLOT) -> DataFrame:
    """Give each row its slot: 0, or for a hot key one of its slots.

    The slot follows from the row and the partition it stands in, both of which a
    re-run task sees again; equal rows from different partitions still part.
    """
    pick = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in rows.columns])
    no_key = F.lit(False)
    for key in keys:
        no_key = no_key | F.col(key).isNull()
    chosen = (
        F.when(no_key, F.pmod(pick, F.lit(NULL_SLOTS)))
        .when(F.col(_PARTS).isNull(), F.lit(0))
        .otherwise(F.pmod(pick, F.col(_PARTS)))
    )
    return rows.join(F.broadcast(hot), list(keys), "left").withColumn(slot, chosen.cast("int")).drop(_PARTS)


def keep_partitions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` by ``keys`` in the session's full number of shuffle partitions.

    For work that is heavy per row, or makes many rows of one: partitions merged by the size of
    what goes in would be too few for it.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    hot: DataFrame,
    how: str = "inner",
    fans_out: bool = False,
) -> DataFrame:
    """``rows`` joined to ``lookup`` with the hot keys of ``rows`` cut into slots.

    ``how`` is inner, left or left_semi. Set ``fans_out`` if the join makes many rows of each.
    """
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1))
    copied = lookup.join(F.broadcast(hot), list(keys), "left").withColumn(_SLOT, copies).drop(_PARTS)
    slotted = add_slot(rows, keys, hot)
    if fans_out:
        slotted = keep_partitions(slotted, [*keys, _SLOT])
    return slotted.join(copied, [*keys, _SLOT], how).drop(_SLOT)
