"""Tree search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptide.llm.neighbours import grow, nearest_neighbours
from shoptide.llm.queries import QUERIES


def plainly(ids, vectors, wanted, k=10):
    out = {}
    for q in wanted:
        away = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, away)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), away[i]) for i in order]
    return out


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("where", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_recall(spark, where):
    rows = spark.read.parquet(f"{where}/embeddings.parquet").toPandas()
    ids, vectors = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(float)
    true = plainly(ids, vectors, ids[ids % 100 == 0])
    found = by_query(QUERIES["op10_nearest_neighbours"](spark, where).collect())
    assert found.keys() == true.keys() and all(len(x) == 10 for x in found.values())
    same = sum(len({a for a, _ in found[q]} & {a for a, _ in true[q]}) for q in true)
    assert same / sum(map(len, true.values())) >= 0.9
    exact = {q: dict(zip(ids.tolist(), np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1)))) for q in true}
    assert all(s == pytest.approx(exact[q][i], abs=1e-12) for q, x in found.items() for i, s in x)


def test_repeated_vectors_fill_many_shards(spark):
    rng = np.random.default_rng(0)
    vectors = np.concatenate([np.tile(rng.normal(size=8), (300, 1)), rng.normal(size=(200, 8))])
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = by_query(nearest_neighbours(frame, F.col("vec_id") % 50 == 0, leaf=8, shard=16, sample=200, recall=1.0).collect())
    true = plainly(np.arange(500), vectors, range(0, 500, 50))
    assert [found[q] for q in range(0, 300, 50)] == [true[q] for q in range(0, 300, 50)]  # ties to the smaller id


def test_queries_mostly_of_another_length(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 31)] + [(i, [float(i), 1.0, 2.0]) for i in range(100, 105)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = nearest_neighbours(frame, F.col("vec_id").isin(5, 100, 101, 102), k=2).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in found) == [(5, 1, 4), (5, 2, 6)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [0.0, 1.0]), (8, [1.0, 0.0]), (None, [1.0, 1.0]), (9, [1.0])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, query_id string, leaf int")
    found = by_query(nearest_neighbours(frame, F.col("vec_id") <= 7).collect())
    root = float(np.sqrt(2))
    assert found == {0: [(8, 0.0), (7, root)], 7: [(0, root), (8, root)]}
    assert nearest_neighbours(frame.limit(0), F.col("vec_id") <= 7).count() == 0
    assert nearest_neighbours(frame.filter("vec_id = 0"), F.col("vec_id") <= 7).count() == 0


def test_best_bin_first_orders_leaves_by_distance():
    rng = np.random.default_rng(3)
    sample = rng.normal(size=(500, 4))
    tree = grow(sample, branch=500, leaf=1)  # one level: the order is that of the centres
    order = [x for x, _ in tree.order(sample[0], np.ones(tree.leaves, int), 20)]
    centres = tree.centres[tree.leaf >= 0]
    assert order == np.argsort(((centres - sample[0]) ** 2).sum(1))[:20].tolist()
