import bisect
import random
from collections import Counter

import pytest

from shoptide.functions import spread
from shoptide.operators import similarity
from shoptide.operators.similarity import product_similarity

PRODUCTS = "product_id string, category string, price double"


def found(spark, rows, **options):
    frame = product_similarity(spark.createDataFrame(rows, PRODUCTS), **options)
    return sorted((r["product_id_1"], r["product_id_2"], r["similarity_score"]) for r in frame.collect())


def brute_force(rows, k):
    prices = [p for _, _, p in rows if p is not None]
    width = (max(prices) - min(prices)) if prices and max(prices) > min(prices) else 1.0
    pairs = []
    for a, category, price in rows:
        scored = []
        for b, other, second in rows:
            if a != b and category is not None and category == other:
                score = None
                if price is not None and second is not None:
                    score = 0.5 + 0.5 * (1.0 - abs(price - second) / width)
                scored.append((score is None, -(score or 0.0), b, score))
        pairs += [(a, b, score) for _, _, b, score in sorted(scored)[:k]]
    return sorted(pairs)


def test_hand_example(spark):
    rows = [("A", "x", 10.0), ("B", "x", 20.0), ("C", "x", 40.0), ("D", "y", 15.0), ("E", None, 15.0)]
    scores = {(a, b): s for a, b, s in found(spark, rows)}
    assert set(scores) == {(a, b) for a in "ABC" for b in "ABC" if a != b}
    assert scores["A", "B"] == scores["B", "A"] == pytest.approx(0.8333, abs=1e-4)
    assert scores["B", "C"] == pytest.approx(0.6667, abs=1e-4)
    assert scores["A", "C"] == pytest.approx(0.5)


def test_empty(spark):
    assert found(spark, []) == []


CASES = {
    "equal prices": [(f"p{i:03}", "x", 5.0) for i in range(40)],
    "few prices": [(f"p{i:03}", f"c{i % 2}", float(i % 5)) for i in range(120)],
    "no prices": [(f"p{i:03}", "x", None) for i in range(9)],
    "some without a price": [(f"p{i:03}", f"c{i % 6}", float(i) if i % 4 else None) for i in range(24)],
    "uneven prices": [(f"p{i:03}", "x", float(2**i)) for i in range(30)],
}


@pytest.mark.parametrize("cell_points", [1, 6, 5_000])
@pytest.mark.parametrize("name", CASES)
def test_equals_brute_force(spark, name, cell_points):
    assert found(spark, CASES[name], k=3, cell_points=cell_points) == brute_force(CASES[name], 3)


def test_cells_of_skewed_prices_are_of_even_size(spark):
    rng = random.Random(5)
    rows = [(f"p{i}", "x", rng.lognormvariate(3, 2)) for i in range(4_000)] + [("q", "y", 1.0)]
    priced = spark.createDataFrame(rows, PRODUCTS)
    (ends,) = similarity.cell_ends(priced, cell_points=100).collect()
    assert ends["category"] == "x" and ends["_ends"] == sorted(ends["_ends"])
    sizes = Counter(bisect.bisect_left(ends["_ends"], price) for _, category, price in rows if category == "x")
    assert len(sizes) == 40 and max(sizes.values()) <= 200


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force_on_random_catalogues(spark, seed, monkeypatch):
    monkeypatch.setattr(similarity, "hot_keys", lambda c, k, min_rows=5: spread.hot_keys(c, k, min_rows=min(min_rows, 8)))
    rng = random.Random(seed)
    rows = [
        (f"p{i:04}", rng.choice(["a", "a", "a", "b", "c", None]), rng.choice([None, 1.0, round(rng.lognormvariate(3, 1), 2)]))
        for i in range(300)
    ]
    assert found(spark, rows, k=5, cell_points=8) == brute_force(rows, 5)
