import pytest
from pyspark.sql import functions as F

from shoptide.functions.spread import add_slot, count_keys, hot_keys, spread_join


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows has key 0, a tenth no key."""
    key = F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 50)
    return spark.range(0, 3000, numPartitions=5).select(key.alias("k"), F.col("id").alias("v"))


def counts_of(rows):
    return count_keys(rows, ["k"])


def test_hot_keys(rows):
    assert [r["k"] for r in hot_keys(counts_of(rows), ["k"], min_rows=200).collect()] == [0]
    largest = hot_keys(counts_of(rows), ["k"], min_rows=10, max_keys=1).collect()
    assert len(largest) == 1 and largest[0]["k"] == 0
    assert hot_keys(counts_of(rows), ["k"]).count() == 0


def test_slots_are_even(rows):
    hot = hot_keys(counts_of(rows), ["k"], min_rows=100)
    sizes = {(r["k"], r["_slot"]): r["count"] for r in add_slot(rows, ["k"], hot).groupBy("k", "_slot").count().collect()}
    cut = [n for (k, _), n in sizes.items() if k == 0]
    assert len(cut) > 5 and max(cut) < 200
    assert {slot for k, slot in sizes if k not in (0, None)} == {0}
    assert len([1 for k, _ in sizes if k is None]) > 100


def test_copies_of_one_row_are_parted_too(spark):
    copies = spark.range(0, 400, numPartitions=4).select(F.lit(1).alias("k"))
    slotted = add_slot(copies, ["k"], hot_keys(counts_of(copies), ["k"], min_rows=50))
    assert slotted.select("_slot").distinct().count() > 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("min_rows", [50, 10_000])
def test_join_is_the_plain_join(spark, rows, how, min_rows):
    lookup = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w")).filter("k != 7")
    lookup = lookup.unionByName(lookup.filter("k < 2").withColumn("w", F.lit(-1).cast("long")))
    hot = hot_keys(counts_of(rows), ["k"], min_rows=min_rows)
    plain = lambda frame: sorted(tuple((v is None, v) for v in r) for r in frame.collect())
    assert plain(spread_join(rows, lookup, ["k"], hot, how)) == plain(rows.join(lookup, ["k"], how))
