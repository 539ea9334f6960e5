"""Nearest neighbours by a hierarchical k-means tree.

1. A tree of centres is fitted on a bounded sample of the vectors: k-means with ``branch`` children a node, until a
   leaf has at most ``leaf`` sample vectors. Every vector is then sent down the tree to its leaf.
2. A query goes through the tree best-bin-first: a priority queue holds the nodes met but not opened by
   their centres' distance, the nearest is opened next, and leaves come out in the order of their visit.
3. How many vectors to see is calibrated: for a bounded sample of vectors as queries, the true neighbours are found
   by brute force over all vectors, in blocks, and leaf visits are widened until the share of
   true neighbours that lies in visited leaves reaches the target. A query visits leaves until it has met
   that many vectors, and at least k besides itself.
4. Queries meet vectors by (leaf, shard). A leaf's vectors are dealt over as many shards as it needs to stay
   about ``shard`` rows, and its queries are copied to each, so no leaf, and no vector that is repeated
   very often, is one task's. A task holds one shard while the shard's queries stream past it. A query's
   best k of each shard are merged by rank.

Distances of candidates are taken in double precision from the original vectors; a screen by inner products only
leaves out what is farther than the k-th by more than its rounding error. Ties go to the smaller id.

Vectors that are null, all zero, or hold a null or non-finite component, rows without an id, and vectors of another
length than most take no part, neither as queries nor as candidates. Rows that repeat an id are candidates
each, but a query leaves out all rows of its own id. With fewer candidates than k, all are returned.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 20_000
CALIBRATION = 100
BRANCH = 16
LEAF = 64
SHARD = 4_096
RECALL = 0.97
ROUNDS = 8
BLOCK = 1 << 22  # entries of a block of distances
PENDING = 20_000  # queries whose best a task keeps before it gives them out


@dataclass
class Tree:
    """Nodes in breadth-first order. ``child[i]`` is the first child of node i, ``children[i]`` their number, 0 for a leaf."""

    centres: np.ndarray
    child: np.ndarray
    children: np.ndarray
    leaf: np.ndarray  # a leaf's number, -1 inside

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child at every level."""
        node = np.zeros(len(vectors), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.children[node])
            if not len(inner):
                return self.leaf[node]
            for i in np.unique(node[inner]):
                rows = inner[node[inner] == i]
                at = slice(self.child[i], self.child[i] + self.children[i])
                node[rows] = self.child[i] + nearest(vectors[rows], self.centres[at])

    def order(self, vector: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[int, int]]:
        """Leaves by best-bin-first until they hold ``least`` vectors: (leaf, vectors met before it)."""
        away = np.sqrt(((self.centres - vector) ** 2).sum(1)) if len(self.centres) < 4096 else None
        heap, met, out = [(0.0, 0)], 0, []
        while heap and met < least:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                if counts[self.leaf[node]]:
                    out.append((int(self.leaf[node]), met))
                    met += int(counts[self.leaf[node]])
                continue
            at = range(self.child[node], self.child[node] + self.children[node])
            apart = away[at.start : at.stop] if away is not None else np.sqrt(((self.centres[at.start : at.stop] - vector) ** 2).sum(1))
            for i, d in zip(at, apart.tolist()):
                heapq.heappush(heap, (d, i))
        return out


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each vector."""
    out, step = np.empty(len(vectors), dtype=np.int64), max(1, BLOCK // len(centres))
    norms = (centres**2).sum(1)
    for at in range(0, len(vectors), step):
        out[at : at + step] = (norms - 2 * vectors[at : at + step] @ centres.T).argmin(1)
    return out


def split(vectors: np.ndarray, branch: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Centres and labels of up to ``branch`` clusters, none empty."""
    different = np.unique(vectors, axis=0)
    centres = different[rng.choice(len(different), min(branch, len(different)), replace=False)]
    for _ in range(ROUNDS):
        label = nearest(vectors, centres)
        size = np.bincount(label, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, label, vectors)
        centres = total[size > 0] / size[size > 0, None]
    return centres, nearest(vectors, centres)


def grow(sample: np.ndarray, branch: int = BRANCH, leaf: int = LEAF, seed: int = 0) -> Tree:
    rng = np.random.default_rng(seed)
    width = sample.shape[1]
    centres, child, children = [sample.mean(0) if len(sample) else np.zeros(width)], [0], [0]
    todo = [(0, np.arange(len(sample)))]
    for node, rows in todo:  # grows while it is walked
        if len(rows) <= leaf:
            continue
        found, label = split(sample[rows], min(branch, -(-len(rows) // leaf)), rng)
        kept = np.unique(label)
        if len(kept) < 2:
            continue  # equal vectors
        child[node], children[node] = len(centres), len(kept)
        for k in kept:
            todo.append((len(centres), rows[label == k]))
            centres.append(found[k])
            child.append(0)
            children.append(0)
    inside = np.array(children) > 0
    number = np.where(inside, -1, np.cumsum(~inside) - 1)
    return Tree(np.array(centres), np.array(child), np.array(children), number)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that take part, and their length."""
    good = F.size("vector") > 0
    good &= F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good &= F.exists("vector", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull()).filter(good)
    width = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    return rows.filter(F.size("vector") == (width.width if width else 0)), width.width if width else 0


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy().astype(np.float64, copy=False).reshape(len(vectors), width)


def sampled(rows: DataFrame, n: int, width: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of n rows by a hash order, so the same ones each time."""
    got = rows.orderBy(F.xxhash64(F.lit(salt), "id", "vector")).limit(n).toArrow()
    return np.array(got["id"].to_pylist()), matrix(got["vector"].combine_chunks(), width)


def best(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query its k nearest rows as (row numbers, distances), rows of its own id left out."""
    norms = (vectors**2).sum(1)
    step = max(1, BLOCK // max(1, len(vectors)))
    for at in range(0, len(queries), step):
        some = queries[at : at + step]
        rough = norms - 2 * some @ vectors.T
        slack = 1e-9 * (norms.max() + (some**2).sum(1))
        for i, row in enumerate(rough):
            row[ids == own[at + i]] = np.inf
            kth = np.partition(row, min(k, len(row)) - 1)[min(k, len(row)) - 1]
            near = np.flatnonzero(row <= min(kth + slack[i], np.finfo(float).max))
            exact = np.sqrt(((vectors[near] - some[i]) ** 2).sum(1))
            order = np.lexsort((ids[near], exact))[:k]
            yield near[order], exact[order]


class Best:
    """The k nearest per query of what a task has found so far."""

    def __init__(self, k: int):
        self.k, self.found = k, {}

    def add(self, query, ids: np.ndarray, away: np.ndarray) -> None:
        parts = self.found.setdefault(query, [])
        parts.append((ids, away))
        if len(parts) > 8:
            self.found[query] = [self.merged(parts)]

    def merged(self, parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        ids, away = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((ids, away))[: self.k]
        return ids[order], away[order]

    def flush(self) -> pa.RecordBatch:
        merged = [self.merged(parts) for parts in self.found.values()]
        queries = np.repeat(np.array(list(self.found)), [len(x) for x, _ in merged])
        self.found = {}
        columns = [queries, np.concatenate([x for x, _ in merged]), np.concatenate([x for _, x in merged])]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["query_id", "vec_id", "score"])


def calibrate(tree: Tree, rows: DataFrame, counts: np.ndarray, width: int, k: int, n: int, recall: float) -> int:
    """Vectors that a query has to meet so that ``recall`` of the true neighbours are among them."""
    ids, queries = sampled(rows, n, width, salt=2)
    if not len(ids):
        return k
    shared = rows.sparkSession.sparkContext.broadcast((tree, ids, queries))

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, own, wanted = shared.value
        for batch in batches:
            if batch.num_rows:
                vectors, names = matrix(batch.column("vector"), width), np.array(batch.column("id").to_pylist())
                leaf = tree.assign(vectors)
                for q, (near, away) in enumerate(best(vectors, names, wanted, own, k)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(near), q)), pa.array(away), pa.array(names[near]), pa.array(leaf[near])], ["query", "away", "id", "leaf"])

    found = rows.mapInArrow(brute, f"query long, away double, id {dict(rows.dtypes)['id']}, leaf long")
    # a batch gives k rows a query, and a query keeps k of all
    true = top(found, "query", k, F.col("away"), F.col("id")).select("query", "leaf").collect()
    by_query: dict[int, list[int]] = {}
    for r in true:
        by_query.setdefault(r.query, []).append(r.leaf)
    needed = []
    for q, leaves in by_query.items():
        met = dict(tree.order(queries[q], counts, int(counts.sum()) + 1))
        needed += [met[x] + 1 for x in leaves]
    if not needed:  # a single vector has no neighbours
        return k
    needed.sort()
    return max(k, needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))])


def top(rows: DataFrame, query: str, k: int, *order: Column) -> DataFrame:
    from pyspark.sql import Window

    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(query).orderBy(*order)))
    return ranked.filter(F.col("rank") <= k)


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    sample: int = SAMPLE,
    calibration: int = CALIBRATION,
    recall: float = RECALL,
    leaf: int = LEAF,
    shard: int = SHARD,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row that ``is_query`` (over the id column) holds for, the k
    nearest other rows by Euclidean distance. ``sample`` bounds the vectors that the tree is fitted on, and
    ``calibration`` the queries that are checked by brute force."""
    spark = vectors.sparkSession
    chosen, width = usable(vectors, vec_id, embedding)
    kind = dict(chosen.dtypes)["id"]
    if not width:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    tree = grow(sampled(chosen, sample, width, salt=1)[1], leaf=leaf)
    shared = spark.sparkContext.broadcast(tree)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves = shared.value.assign(matrix(batch.column("vector"), width)) if batch.num_rows else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaves)], ["id", "vector", "leaf"])

    placed = chosen.mapInArrow(place, f"id {kind}, vector array<double>, leaf long")
    # the leaves are bounded by the sample
    counts = np.zeros(tree.leaves, dtype=np.int64)
    for r in placed.groupBy("leaf").count().collect():
        counts[r["leaf"]] = r["count"]
    least = calibrate(tree, chosen, counts, width, k, calibration, recall)
    shards = -(-counts // shard)
    state = spark.sparkContext.broadcast((tree, counts, shards, least))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, counts, shards, least = state.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                rows, leaves, parts = [], [], []
                for i, vector in enumerate(matrix(some.column("vector"), width)):
                    # its own row counts among those met
                    for x, _ in tree.order(vector, counts, max(least, k) + 1):
                        for part in range(shards[x]):
                            rows.append(i)
                            leaves.append(x)
                            parts.append(part)
                taken = some.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaves, pa.int64()), pa.array(parts, pa.int64())], ["id", "vector", "leaf", "shard"])

    dealt = F.broadcast(spark.createDataFrame([(i, int(n)) for i, n in enumerate(shards)], "leaf long, shards long"))
    candidates = placed.join(dealt, "leaf").withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.col("shards"))).drop("shards")
    asking = chosen.select(F.col("id").alias(vec_id), "vector").filter(is_query).select(F.col(vec_id).alias("id"), "vector")
    asking = asking.mapInArrow(visit, f"id {kind}, vector array<double>, leaf long, shard long")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by leaf and shard, a shard's vectors before its queries: holds one shard, queries stream by."""
        held, key, kept = [], None, Best(k)
        for batch in batches:
            leaf, part, asks = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("leaf", "shard", "asks"))
            new = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(part) != 0) | (np.diff(asks.astype(int)) != 0)) + 1
            edges = [0, *new.tolist(), batch.num_rows] if batch.num_rows else []
            for begin, end in zip(edges, edges[1:]):
                some = batch.slice(begin, end - begin)
                ids, points = np.array(some.column("id").to_pylist()), matrix(some.column("vector"), width)
                if (leaf[begin], part[begin]) != key:
                    held, key = [], (leaf[begin], part[begin])
                if not asks[begin]:
                    held.append((ids, points))
                elif held:
                    if len(held) > 1:
                        held = [(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))]
                    names, vectors = held[0]
                    for query, (near, away) in zip(ids, best(vectors, names, points, ids, k)):
                        kept.add(query, names[near], away)
                    if len(kept.found) > PENDING:
                        yield kept.flush()
        if kept.found:
            yield kept.flush()

    both = candidates.withColumn("asks", F.lit(False)).unionByName(asking.withColumn("asks", F.lit(True)))
    met = both.repartition("leaf", "shard").sortWithinPartitions("leaf", "shard", "asks")
    found = met.mapInArrow(meet, f"query_id {kind}, vec_id {kind}, score double")
    ranked = top(found, "query_id", k, F.col("score"), F.col("vec_id"))
    return ranked.select("query_id", "rank", "vec_id", "score")
