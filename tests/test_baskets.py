import random
from collections import Counter
from itertools import combinations
from math import ceil

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from shoptide.functions import spread
from shoptide.operators import baskets as module
from shoptide.operators.baskets import basket_census, baskets, copurchase_rules, product_complementary

from shoptide.plans.settle import settle

ITEMS = "order_id string, product_id string"


def lines(spark, orders):
    return spark.createDataFrame([(o, p) for o, products in orders.items() for p in products], ITEMS)


def rules_of(frame):
    return {
        (r["product_id_1"], r["product_id_2"]): (r["co_purchase_count"], r["confidence"], r["lift"])
        for r in frame.collect()
    }


def by_hand(orders, min_count, min_confidence):
    kept = [set(p) for p in orders.values() if len(set(p)) > 1]
    single = Counter(p for b in kept for p in b)
    pair = Counter(c for b in kept for c in combinations(sorted(b), 2))
    found = {}
    for (a, b), n in pair.items():
        for x, y in ((a, b), (b, a)):
            if n >= min_count and n / single[x] >= min_confidence:
                found[x, y] = (n, n / single[x], n / single[x] / (single[y] / len(kept)))
    return found


HAND = {"1": "AB", "2": "ABC", "3": "A", "4": "AA"}


def test_baskets_are_distinct_and_mixed(spark):
    assert sorted(baskets(lines(spark, HAND)).collect()) == [("1", "A"), ("1", "B"), ("2", "A"), ("2", "B"), ("2", "C")]
    assert basket_census(lines(spark, HAND)).baskets == 2


def test_hand_rules(spark):
    found = rules_of(copurchase_rules(lines(spark, HAND)))
    assert found["A", "B"] == (2, 1.0, 1.0)
    assert found["A", "C"] == (1, 0.5, 1.0)
    assert found == by_hand(HAND, 1, 0.005)


def test_complementary_view(spark):
    products = spark.createDataFrame([("A", "x"), ("B", "y")], "product_id string, category string")
    rows = {(r["product_id_1"], r["product_id_2"]): r for r in product_complementary(lines(spark, HAND), products).collect()}
    assert rows["A", "B"]["complementary_score"] == 0.73
    assert rows["A", "B"]["category_cross_sell"] is True
    assert rows["A", "C"]["category_cross_sell"] is None
    assert rows["A", "B"]["relationship_type"] == "co_purchase"


def test_rounding_is_half_up(spark):
    from shoptide.functions.scoring import complementary_score

    row = spark.createDataFrame([(0.15, 1.0)], "c double, l double").select(complementary_score(F.col("c"), F.col("l")).alias("s"))
    assert row.first()["s"] == 0.14  # 0.105 + 0.03 = 0.135


def random_orders(seed, orders=250, products=25, giants=()):
    rng = random.Random(seed)
    catalogue = [f"P{i:02}" for i in range(products)]
    made = {f"o{i}": rng.choices(catalogue, weights=range(1, products + 1), k=rng.randint(1, 6)) for i in range(orders)}
    for i, size in enumerate(giants):
        made[f"giant{i}"] = rng.sample(catalogue, size) * 8
    return made


@pytest.mark.parametrize("min_count", [1, 2, 4, 9])
@pytest.mark.parametrize("giants", [(), (20,), (20, 22, 25)])
def test_equals_counting_by_hand(spark, min_count, giants):
    """Oversized baskets are counted the other way round, and the counts stay exact."""
    orders = random_orders(3, giants=giants)
    found = rules_of(copurchase_rules(lines(spark, orders), min_count=min_count, max_basket=30, settle=settle))
    assert found == by_hand(orders, min_count, 0.005)


def test_one_order_with_a_third_of_all_lines(spark, monkeypatch):
    monkeypatch.setattr(module, "hot_keys", lambda c, k: spread.hot_keys(c, k, min_rows=10))
    orders = random_orders(5, giants=(25,))
    orders["copies"] = ["P01"] * 400
    frame = lines(spark, orders).repartition(4)
    assert rules_of(copurchase_rules(frame, min_count=3, max_basket=50, settle=settle)) == by_hand(orders, 3, 0.005)
    wanted = {(o, p) for o, ps in orders.items() if len(set(ps)) > 1 for p in ps}
    assert sorted(baskets(frame).collect()) == sorted(wanted)


def test_large_baskets_are_paired_in_blocks(spark):
    """Three baskets too large to be paired whole, of which a pair needs two: one is met from the other end, two in blocks."""
    orders = {f"o{i}": [f"P{k:03}" for k in range(i, 120, i + 1)] for i in range(3)} | {"x": ["P000", "P001"]}
    frame = lines(spark, orders)
    known = basket_census(frame, min_count=2, max_basket=10)
    assert (known.large, known.blocked) == (1, 2)
    found = rules_of(copurchase_rules(frame, min_count=2, max_basket=10, settle=settle))
    assert found == by_hand(orders, 2, 0.005)


def test_no_group_of_blocks_holds_a_whole_basket(spark):
    items = spark.range(1_000).select(F.lit("o").alias("order_id"), F.format_string("P%04d", "id").alias("product_id"))
    pairs = module._pairs_by_block(items.withColumn("_blocks", F.lit(20)))
    assert pairs.count() == pairs.distinct().count() == 1_000 * 999 // 2
    assert pairs.filter("a >= b").isEmpty()


def test_size_bound_is_raised_until_it_is_exact(spark):
    orders = random_orders(7, giants=(20, 21, 22, 23))
    for min_count in (1, 2, 3, 9):
        known = basket_census(lines(spark, orders), min_count=min_count, max_basket=30)
        assert known.large < known.min_count
        assert known.large == min(min_count - 1, 4)


def test_equals_frequent_item_sets(spark):
    orders = random_orders(11)
    frame = lines(spark, orders)
    arrays = frame.groupBy("order_id").agg(F.collect_set("product_id").alias("items")).filter(F.size("items") > 1)
    support = 3 / arrays.count()
    mined = FPGrowth(itemsCol="items", minSupport=support, minConfidence=0.05).fit(arrays).associationRules
    wanted = {
        (r["antecedent"][0], r["consequent"][0]): (r["confidence"], r["lift"])
        for r in mined.filter((F.size("antecedent") == 1) & (F.size("consequent") == 1)).collect()
    }
    found = rules_of(copurchase_rules(frame, min_support=support, min_confidence=0.05))
    assert basket_census(frame, min_support=support).min_count == ceil(support * arrays.count())
    assert {k: v[1] for k, v in found.items()} == pytest.approx({k: v[0] for k, v in wanted.items()})
    assert {k: v[2] for k, v in found.items()} == pytest.approx({k: v[1] for k, v in wanted.items()})
