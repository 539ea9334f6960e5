"""Near-copies by an LSH forest over MinHash signatures.

1. A text's set is that of its hashed word shingles. Texts with equal sets (two 64-bit sums of the
   hashes) are one class, and a class goes on as one set: thousands of copies cost one.
2. The forest has TREES sorted orders. In each, a class stands by a region - the first DEPTH minima of that tree's hash
   functions, at that depth two sets of similarity 0.8 meet in half of the trees - and in it by a label of further minima.
   Candidates are neighbours with the longest common prefix: a region of up to WINDOW classes is compared whole, at its
   shallow depth; a denser one is cut along its sorted labels into overlapping windows, whose members share longer prefixes
   the denser it is. Members are compared on signatures, in the task, one window at a time.
3. A window proposes, for each class, its most similar partners and the window's hub (the class that most others resemble);
   hubs are carried on through a region. So proposals grow with the rows, not with their square, and
   large groups of copies of one text meet at that text.
4. Proposals are confirmed on full sets: the links are exact.
5. Further rounds propose across the components found so far, with other orders and again the best partners, now of
   other components only, until a round links nothing new.
6. What the forest did not show is found by an exact join, so nothing above decides on the result. Shingles have one order, the
   seldom ones first. Two sets that are similar enough have their first common shingle early in both (the prefix filter), where
   enough of both is left behind it. Classes of different components that share a shingle at such places are compared by counts of
   their shingles in buckets, which bound what they have in common, and then confirmed on full sets.
   The forest's components keep copies of one text from meeting pair by pair, and members of a template family meet
   at the template's shingles only if they differ in few others.

No link is missed but by equal 64-bit hashes. Pairs of the join grow with the square of a group only where many different components
share seldom shingles at early places.

A null or empty text has no set, is its own component and kept. A null id counts as larger than any. Rows that repeat an id are in
the component of their text each. Column names cannot clash: only the id and the text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.components import components
from shoptide.llm.shared import settle
from shoptide.llm.words import UNSPACED, WORDS, mixed, small_batches, words_of

SHINGLE = 5
PERCENT = 80
TREES = 16  # a power of two
DEPTH = 3
LABEL = 5
HASHES = 128
WINDOW = 256
PARTNERS = 3
HUBS = 4
MARGIN = 0.1  # below the threshold, what a signature may say of a pair that the forest proposes
BUCKETS = 1 << 21  # counts that order shingles; any order gives the same links
SLICE = 1 << 12
PAIRS = 1 << 18  # pairs that a task makes at a time

_RNG = np.random.default_rng(20_240_601)
FACTORS = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tree_hashes(order: int) -> np.ndarray:
    """The hash functions of each tree of a round's orders: DEPTH for the region, LABEL for the label."""
    rng = np.random.default_rng(order)
    return np.stack([rng.choice(HASHES, DEPTH + LABEL, replace=False) for _ in range(TREES)])


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different shingles of some texts, sorted by text, and where each text's begin."""
    words = words_of(texts, UNSPACED)
    at, hashes = words.windows(size)
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < size))
    whole = WORDS[0].spans(words.hashes, words.first[short], words.first[short + 1])
    text = np.concatenate((words.text[at], short))
    hashes = np.concatenate((hashes, whole))
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) > 0) | (hashes[1:] != hashes[:-1])
    text, hashes = text[new], hashes[new]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1))


def sums(hashes: np.ndarray, first: np.ndarray, salt: int) -> np.ndarray:
    """A sum by text that tells sets apart; 0 for an empty one."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes + np.uint64(salt)), dtype=np.uint64)))
    return (total[first[1:]] - total[first[:-1]]).view(np.int64)


def minima(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The signature of each text with a set, HASHES minima each."""
    starts = first[:-1][np.diff(first) > 0]
    if not len(starts):
        return np.empty((0, HASHES), np.uint64)
    return np.stack([np.minimum.reduceat(hashes * f, starts) for f in FACTORS], axis=1)


def signatures(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """(id, mark, n, class, check, minima): a hash of the text as it stands; the class is 0 without a set; minima 16 bits each."""
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    schema = T.StructType([rows.schema["id"]]).add("mark", "long").add("n", "long").add("class", "long").add("check", "long").add("minima", "binary")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "text"):
                hashes, first = shingle_sets(some.column("text"), size)
                n = np.diff(first)
                bits = (mixed(minima(hashes, first)) >> np.uint64(48)).astype("<u2")
                held = iter(bits)
                signs = [next(held).tobytes() if k else None for k in n]
                made = [n, sums(hashes, first, 1), sums(hashes, first, 2)]
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("mark"), *(pa.array(x) for x in made), pa.array(signs, pa.binary())], schema.names)

    return rows.mapInArrow(work, schema)


def regions(signs: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """The region of each signature in each tree; its last bits name the tree, so regions of different trees are never equal."""
    for tree, own in enumerate(tree_hashes(order)):
        region = np.full(len(signs), tree + 1, np.uint64)
        for j in own[:DEPTH]:
            region = mixed(region * np.uint64(0x9E3779B97F4A7C15) + signs[:, j])
        yield ((region & ~np.uint64(TREES - 1)) | np.uint64(tree)).view(np.int64)


def crowded(classes: DataFrame, order: int) -> DataFrame:
    """(class, trees): the trees, a bit each, in which a class shares its region. In the others it has no neighbour, and most classes have
    none in any, so these small rows spare most of the forest's."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                signs = np.frombuffer(b"".join(some.column("minima").to_pylist()), "<u2").reshape(-1, HASHES)
                for region in regions(signs, order):
                    yield pa.RecordBatch.from_arrays([pa.array(region), some.column("class")], ["region", "class"])

    places = classes.select("class", "minima").mapInArrow(work, "region long, class long")
    # the neighbours in the order of a region tell whether there are any, without its size
    along = Window.partitionBy("region").orderBy("class")
    beside = F.coalesce(F.lag("class").over(along), F.lead("class").over(along))
    shared = places.withColumn("beside", beside).filter("beside is not null")
    return shared.groupBy("class").agg(F.bit_or(F.expr(f"shiftleft(1, cast(region & {TREES - 1} as int))")).alias("trees"))


def forest(classes: DataFrame, order: int) -> DataFrame:
    """A row per class and tree in which it has neighbours: (region, label, class, root, sign). The sign is what windows
    compare: 4 bits of each minimum, two to a byte."""
    hashes = tree_hashes(order)
    schema = "region long, label binary, class long, root long, sign binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                some = batch.slice(at, 2048)
                signs = np.frombuffer(b"".join(some.column("minima").to_pylist()), "<u2").reshape(-1, HASHES)
                small = np.ascontiguousarray(signs.astype(np.uint8))
                names, roots, trees = some.column("class").to_numpy(), some.column("root").to_numpy(), some.column("trees").to_numpy()
                short = pa.array([x.tobytes() for x in (small[:, ::2] & 15) | (small[:, 1::2] << 4)], pa.binary())
                for tree, region in enumerate(regions(signs, order)):
                    held = np.flatnonzero(trees >> tree & 1)
                    labels = np.ascontiguousarray(small[held][:, hashes[tree, DEPTH:]])
                    columns = [pa.array(region[held]), pa.array([x.tobytes() for x in labels], pa.binary()), pa.array(names[held]), pa.array(roots[held]), short.take(pa.array(held))]
                    yield pa.RecordBatch.from_arrays(columns, ["region", "label", "class", "root", "sign"])

    return classes.join(crowded(classes, order), "class").select("class", "root", "minima", "trees").mapInArrow(work, schema)


def unpacked(signs: np.ndarray) -> np.ndarray:
    """A row of HASHES small numbers for each packed sign."""
    return np.stack((signs & 15, signs >> 4), axis=2).reshape(len(signs), -1)


def proposals(signs: np.ndarray, roots: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Pairs (i, j) of a window that may be links and are not in one component yet, a few for each member; its hub."""
    same = np.stack([(signs == row).mean(1) for row in signs])
    alike = (same - 1 / 16) / (1 - 1 / 16)
    alike[alike < least] = 0
    np.fill_diagonal(alike, 0)
    hub = int((alike > 0).sum(1).argmax())
    alike[roots[:, None] == roots] = 0
    # what is surely linked to the hub needs no partners of its own: its group meets there, however large
    others = np.flatnonzero(alike[:, hub] < least + 2 * MARGIN)
    k = min(PARTNERS, len(signs) - 1)
    near = np.argpartition(-alike[others], k - 1, axis=1)[:, :k]
    i, j = np.repeat(others, k), near.ravel()
    i, j = np.concatenate((i, np.arange(len(signs)))), np.concatenate((j, np.full(len(signs), hub)))
    good = alike[i, j] > 0
    return i[good], j[good], hub


def candidates(rows: DataFrame, least: float) -> DataFrame:
    """Pairs of classes (a, b), a < b, that windows of the sorted orders propose."""
    ordered = rows.repartition("region").sortWithinPartitions("region", "label", "class")

    def region_pairs(names: np.ndarray, roots: np.ndarray, signs: np.ndarray, state: dict) -> list[tuple[np.ndarray, np.ndarray]]:
        i, j, hub = proposals(unpacked(signs), roots, least)
        hubs = state.setdefault("hubs", [])
        if names[hub] not in [h for h, _, _ in hubs]:
            state["hubs"] = [*hubs[-HUBS + 1 :], (names[hub], roots[hub], signs[hub])]
        return [(names[i], names[j])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # the open region's rows that wait for a full window
        region, state = None, {}

        def close(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held
            while len(held) > 1 and (last or len(held) >= WINDOW):
                some = held[:WINDOW]
                names = np.array([x[0] for x in some] + [h for h, _, _ in state.get("hubs", [])])
                roots = np.array([x[1] for x in some] + [r for _, r, _ in state.get("hubs", [])])
                signs = np.stack([np.frombuffer(x[2], np.uint8) for x in some] + [s for _, _, s in state.get("hubs", [])])
                for a, b in region_pairs(names, roots, signs, state):
                    low, high = np.minimum(a, b), np.maximum(a, b)
                    pairs = np.unique(np.stack((low, high), axis=1)[low != high], axis=0)
                    if len(pairs):
                        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])
                # half a window stays on, so that neighbours meet wherever the cut falls
                held = [] if last and len(held) <= WINDOW else held[WINDOW // 2 :]

        for batch in batches:
            regions = batch.column("region").to_numpy()
            names, roots, signs = batch.column("class").to_numpy(), batch.column("root").to_numpy(), batch.column("sign")
            edges = [0, *(np.flatnonzero(np.diff(regions)) + 1).tolist(), len(regions)]
            for begin, end in zip(edges, edges[1:]):
                if begin == end:
                    continue
                if regions[begin] != region:
                    yield from close(last=True)
                    held, region, state = [], regions[begin], {}
                for at in range(begin, end, WINDOW):
                    held += [(names[k], roots[k], signs[k].as_py()) for k in range(at, min(end, at + WINDOW))] if end - begin > 1 or held or end == len(regions) else []
                    yield from close(last=False)
        yield from close(last=True)

    return ordered.mapInArrow(work, "a long, b long").distinct()


def sketch(hashes: np.ndarray) -> bytes | None:
    """How many of a set's shingles fall in each of some buckets, a byte each and half as many as shingles or more; None if a byte is too small.
    Sketches of different lengths compare after folding the longer one."""
    m = max(64, 1 << (len(hashes) // 2).bit_length())
    held = np.bincount((mixed(hashes) & np.uint64(m - 1)).astype(np.int64), minlength=m)
    return held.astype(np.uint8).tobytes() if held.max() < 256 else None


def may_link(x: bytes | None, y: bytes | None, percent: int) -> bool:
    """False only where the sketches show that the sets are not similar enough: no bucket holds more common shingles than the smaller count."""
    if x is None or y is None:
        return True
    u, v = np.frombuffer(x, np.uint8).astype(np.int64), np.frombuffer(y, np.uint8).astype(np.int64)
    m = min(len(u), len(v))
    u, v = u.reshape(-1, m).sum(0), v.reshape(-1, m).sum(0)
    common = int(np.minimum(u, v).sum())
    return 100 * common >= percent * (int(u.sum()) + int(v.sum()) - common)


def full_sets(docs: DataFrame, ids: DataFrame, classes: DataFrame, size: int, doc_id: str, text: str, sketched: bool = False) -> DataFrame:
    """(class, shingles) of the classes, from the texts of the documents ``ids`` that stand for them; or (class, sketch)."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    rows = rows.join(ids, rows["id"].eqNullSafe(ids["own"]), "left_semi")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "text"):
                hashes, first = shingle_sets(some.column("text"), size)
                if sketched:
                    made = pa.array([sketch(hashes[i:j]) for i, j in zip(first, first[1:])], pa.binary())
                else:
                    made = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(sums(hashes, first, 1)), made], names)

    names, kind = (["class", "sketch"], "binary") if sketched else (["class", "shingles"], "array<long>")
    sets = rows.select("text").mapInArrow(work, f"class long, {names[1]} {kind}")
    return sets.join(classes, "class", "left_semi").dropDuplicates(["class"])


def screened(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches do not rule out. A sketch is an eighth of a set or less, so most of what is not similar is told apart
    without moving sets."""
    first = sketches.select(F.col("class").alias("a"), F.col("sketch").alias("x"))
    second = sketches.select(F.col("class").alias("b"), F.col("sketch").alias("y"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            yield batch.select(["a", "b"]).filter(pa.array([may_link(x, y, percent) for x, y in both], pa.bool_()))

    both = pairs.join(first, "a").join(second, "b")
    return both.select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    first = sets.select(F.col("class").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("class").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(first, "a").join(second, "b")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, keep = batch.column("x"), batch.column("y"), np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                u, v = x[i].values.to_numpy(), y[i].values.to_numpy()
                common = len(np.intersect1d(u, v, assume_unique=True))
                keep[i] = 100 * common >= percent * (len(u) + len(v) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "x", "y").mapInArrow(work, "a long, b long")


def shingle_counts(docs: DataFrame, size: int, text: str) -> np.ndarray:
    """How many texts have a shingle of each of BUCKETS buckets."""

    def count_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for some in small_batches(batch, "text"):
                hashes, _ = shingle_sets(some.column("text"), size)
                np.add.at(total, buckets(hashes), 1)
        slices = total.reshape(-1, SLICE)
        used = np.flatnonzero(slices.any(axis=1))
        packed = [slices[k].astype("<u2" if slices[k].max() < 1 << 16 else "<i8").tobytes() for k in used]
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(packed, pa.binary())], ["slice", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SLICE, np.int64)
        for held in table.column("counts"):
            own = held.as_py()
            total += np.frombuffer(own, "<u2" if len(own) == 2 * SLICE else "<i8")
        return pa.table({"slice": table.column("slice")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "slice long, counts binary"
    counted = docs.select(F.col(text).alias("text")).mapInArrow(count_texts, schema).groupBy("slice").applyInArrow(add, schema)
    counts = np.zeros((BUCKETS // SLICE, SLICE), np.int64)
    for row in counted.collect():
        counts[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return counts.ravel()


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes) & np.uint64(BUCKETS - 1)).astype(np.int64)


def prefixes(docs: DataFrame, size: int, percent: int, text: str) -> DataFrame:
    """(class, n, shingles): the first shingles of each set, seldom ones first, among which a set of at least ``percent`` hundredths
    in common has one of its own."""
    counts = docs.sparkSession.sparkContext.broadcast(shingle_counts(docs, size, text))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "text"):
                hashes, first = shingle_sets(some.column("text"), size)
                n = np.diff(first)
                owner = np.repeat(np.arange(len(n)), n)
                ordered = hashes[np.lexsort((hashes, counts.value[buckets(hashes)], owner))]
                length = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
                early = np.arange(len(ordered)) - first[:-1][owner] < length[owner]
                ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(np.minimum(length, n))))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ordered[early].view(np.int64)))
                made = pa.RecordBatch.from_arrays([pa.array(sums(hashes, first, 1)), pa.array(n), lists], ["class", "n", "shingles"])
                yield made.filter(pa.array(n > 0))

    return docs.select(F.col(text).alias("text")).mapInArrow(work, "class long, n long, shingles array<long>").dropDuplicates(["class"])


def meeting(docs: DataFrame, roots: DataFrame, size: int, percent: int, text: str) -> DataFrame:
    """Pairs of classes (a, b), a < b, of different components that may be links: all there are, by the prefix filter."""
    held = prefixes(docs, size, percent, text).join(roots, "class")
    rows = held.select("class", "root", "n", F.posexplode("shingles").alias("place", "shingle"))
    # these rows are most of what is shuffled: size and place go as one number
    ordered = rows.select("shingle", "root", "class", (F.shiftleft("n", 32) + F.col("place")).alias("size_place")).repartition("shingle").sortWithinPartitions("shingle", "root")

    def pairs_of(shingle: np.ndarray, root: np.ndarray, names: np.ndarray, size_place: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(shingle):
            return
        n, place = size_place >> 32, size_place & 0xFFFFFFFF
        same = np.diff(shingle) == 0
        ends = np.append(np.flatnonzero(~same) + 1, len(shingle))
        runs = np.append(np.flatnonzero(~same | (np.diff(root) != 0)) + 1, len(shingle))
        at = np.arange(len(shingle))
        start = runs[np.searchsorted(runs, at, "right")]  # the next component of the same shingle
        many = ends[np.searchsorted(ends, at, "right")] - start
        upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(many)))
        for low in range(0, int(upto[-1]), PAIRS):
            k = np.arange(low, min(low + PAIRS, int(upto[-1])))
            i = np.searchsorted(upto, k, "right") - 1
            j = start[i] + k - upto[i]
            left = np.minimum(n[i] - place[i], n[j] - place[j])
            good = (100 + percent) * left >= percent * (n[i] + n[j])
            a, b = names[i[good]], names[j[good]]
            found = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[list[np.ndarray]] = []  # rows of the last shingle, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy() for k in range(4)]
            cut = int(np.searchsorted(columns[0], columns[0][-1]))
            if waiting and columns[0][0] == columns[0][-1] == waiting[0][0][0]:
                waiting.append(columns)
                continue
            yield from pairs_of(*(np.concatenate([w[k] for w in waiting] + [columns[k][:cut]]) for k in range(4)))
            waiting = [[c[cut:] for c in columns]]
        if waiting:
            yield from pairs_of(*(np.concatenate([w[k] for w in waiting]) for k in range(4)))

    return ordered.mapInArrow(work, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    size: int = SHINGLE,
    percent: int = PERCENT,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id, kept, text_hash) of each document. Links are pairs of texts whose sets of ``size`` words have at
    least ``percent`` hundredths of their union in common; a component's id is its smallest id, whose document is kept."""
    signed = settle(signatures(docs, size, doc_id, text), "signatures")
    # one row a class: its smallest id
    classes = settle(signed.filter("n > 0").groupBy("class", "check", "n").agg(F.min("id").alias("own"), F.first("minima").alias("minima")), "classes")
    least = max(0.0, percent / 100 - MARGIN)
    nodes = classes.withColumn("root", F.col("class"))
    links, tested, mapping = None, None, None

    def sets_of(pairs: DataFrame, sketched: bool = False) -> DataFrame:
        active = settle(pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "active")
        ids = settle(classes.join(active, "class").select("own"), "ids")
        return full_sets(docs, ids, active, size, doc_id, text, sketched)

    def confirm(pairs: DataFrame) -> DataFrame:
        return settle(confirmed(pairs, sets_of(pairs), percent), "found")

    for order in count():  # ends: every further round joins components
        pairs = candidates(forest(nodes, order), least)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = settle(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = confirm(pairs)
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        mapping = settle(components(links), "components")
        # only what resembles something can gain a link: the others met no candidate in any tree
        seen = tested.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        joined = classes.join(seen, "class").join(mapping.withColumnRenamed("node", "class"), "class", "left")
        nodes = settle(joined.withColumn("root", F.coalesce("root", "class")), "nodes")
    roots = classes.select("class")
    if mapping is None:
        roots = roots.withColumn("root", F.col("class"))
    else:
        roots = roots.join(mapping.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    met = settle(meeting(docs, roots, size, percent, text).join(tested, ["a", "b"], "left_anti"), "pairs")
    # nearly none of these is a link, and they grow faster than the classes
    found = confirm(settle(screened(met, sets_of(met, sketched=True), percent), "pairs"))
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        mapping = settle(components(links), "components")
    if mapping is None:
        owners = classes.select("class", "check", "own")
    else:
        joined = classes.join(mapping.withColumnRenamed("node", "class"), "class", "left")
        joined = joined.withColumn("root", F.coalesce("root", "class"))
        smallest = joined.groupBy("root").agg(F.min("own").alias("least"))
        owners = joined.join(smallest, "root").select("class", "check", F.col("least").alias("own"))
    owners = settle(owners, "owners")
    result = signed.select("id", "mark", "n", "class", "check").join(owners, ["class", "check"], "left")
    component = F.when(F.col("n") > 0, F.col("own")).otherwise(F.col("id"))
    result = result.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("mark").alias("text_hash"))
    return result.withColumn("kept", F.col(doc_id).eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that of its smallest id. Rows that repeat an id and a text count as one
    document and stay or go together."""
    found = near_duplicates(docs, size, percent, doc_id, text).filter("not kept")
    gone = settle(found.select(F.col(doc_id).alias("id"), F.col("text_hash").alias("mark")).distinct(), "gone")
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("own"), F.xxhash64(text).alias("own_mark"))
    left = rows.join(gone, rows["own"].eqNullSafe(gone["id"]) & (rows["own_mark"] == gone["mark"]), "left_anti")
    return left.select("row.*")
