"""Near-copies against all pairs of full sets."""

import random
import re

import numpy as np

from shoptide.llm import nearcopies
from shoptide.llm.components import components
from shoptide.llm.nearcopies import drop_near_duplicates, near_duplicates
from shoptide.llm.queries import QUERIES


def plainly(docs, size, percent=80):
    """(id, n, component, kept) by comparing every pair; ids differ."""
    sets = {}
    for i, text in docs:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    pairs = {(a, b) for of in holders.values() for a in of for b in of if a < b}
    for a, b in pairs:
        common = len(sets[a] & sets[b])
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets.items())


def test_query_equals_all_pairs(spark, folder, read):
    found = sorted(tuple(r) for r in QUERIES["op7_near_duplicates"](spark, folder).collect())
    wanted = plainly([(r.doc_id, r.text) for r in read("documents").collect()], 4)
    assert found == wanted and any(not r[3] for r in wanted)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(150)]
    docs = []
    for i in range(500):
        words = list(base)
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        docs.append((i, " ".join(words)))
    docs += [(500 + i, docs[7][1]) for i in range(200)] + [(1000 + i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(60))) for i in range(100)]
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=5)
    columns = ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(tuple(r) for r in found.select(columns).collect()) == plainly(docs, 5)


def test_links_inside_a_template_family(spark):
    shared = [f"t{k}" for k in range(130)]
    # by fours 0.77 alike, below the threshold; each of 40 pairs has four words more in common, 0.81
    docs = [(i, " ".join(shared + [f"p{i // 2}x{k}" for k in range(4 if i < 80 else 0)] + [f"u{i}x{k}" for k in range(15 if i < 80 else 19)])) for i in range(700)]
    found = near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), size=4).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == [(i, i // 2 * 2 if i < 80 else i) for i in range(700)]


def test_a_link_that_signatures_deny(spark):
    pairs = []
    for seed in (101, 162, 2102, 2616):  # 0.802 alike, by their signatures under 0.69
        words = [f"p{seed}x{i}" for i in range(103)]
        pairs += [" ".join(words), " ".join(words[:92] + [f"q{seed}x{i}" for i in range(92, 103)])]
    docs = spark.createDataFrame(list(enumerate(pairs)), "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in near_duplicates(docs, size=4).collect()) == [(i, i // 2 * 2) for i in range(8)]


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    texts = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, long), (8, long + " end"), (9, "É x y z"), (10, "é x y z"), (11, "same text here now"), (None, "same text here now"), (11, "same text here now")]
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts], "doc_id long, text string, n string, class int")
    rows = near_duplicates(docs, size=4).collect()
    assert len(rows) == len(texts)
    got = {(r.doc_id, r.component_id, r.n_shingles, r.kept) for r in rows}
    assert got >= {(1, 1, 0, True), (2, 2, 0, True), (3, 3, 0, True), (4, 4, 1, True), (5, 4, 1, False), (6, 6, 1, True), (8, 7, 29_998, False)}
    assert got >= {(9, 9, 1, True), (10, 10, 1, True), (11, 11, 1, True), (None, 11, 1, False)}
    assert near_duplicates(docs.limit(0)).count() == 0
    left = drop_near_duplicates(docs, size=4)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(map(str, [1, 2, 3, 4, 6, 7, 9, 10, 11, 11]))


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 60)] + [(100, 101), (7, 3)], "a long, b long")
    found = {r.node: r.root for r in components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_sketches_rule_out_no_link():
    rng = np.random.default_rng(5)
    told_apart = 0
    for size in (1, 7, 60, 900, 5000):
        for share in (0.0, 0.5, 0.85, 0.889, 0.9, 1.0):
            u = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            common = u[: round(share * len(u))]
            v = np.unique(np.concatenate((common, rng.integers(0, 1 << 63, len(u) - len(common), dtype=np.uint64))))
            exact = 100 * len(np.intersect1d(u, v)) >= 80 * len(np.union1d(u, v))
            kept = nearcopies.may_link(nearcopies.sketch(u), nearcopies.sketch(v), 80)
            assert kept or not exact
            told_apart += not kept
    assert told_apart >= 9
    short, long = np.arange(100, dtype=np.uint64), np.arange(125, dtype=np.uint64)  # exactly at the threshold
    assert nearcopies.may_link(nearcopies.sketch(short), nearcopies.sketch(long), 80)
    fold = np.arange(250, dtype=np.uint64), np.arange(260, dtype=np.uint64)
    assert len(nearcopies.sketch(fold[0])) != len(nearcopies.sketch(fold[1])) and nearcopies.may_link(*map(nearcopies.sketch, fold), 80)
    assert nearcopies.may_link(None, nearcopies.sketch(short), 80)
