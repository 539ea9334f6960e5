"""Lyndon arrays, runs and collapsed texts against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from shoptide.llm.periodic import find_runs, lyndon_lengths, runs_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_lyndon(x):
    """To the next smaller suffix."""
    n = len(x)
    return [next((j for j in range(i + 1, n) if x[j:] < x[i:]), n) - i for i in range(n)]


def plain_runs(words, shortest=24, copies=3):
    """Maximal stretches of equality at each distance, of those the ones whose distance is the smallest period."""
    found, n = [], len(words)
    for q in range(1, n // copies + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, copies * q):
                stretch = words[i : j + q]
                if not any(stretch[d:] == stretch[:-d] for d in range(1, q)):
                    found.append((i, q, j - i + q))
            i = j + 1
    return sorted(found)


def sequences():
    rng = random.Random(5)
    yield from ([], [0], [0, 0], [1, 0], [0, 1])
    for n in (3, 8, 20, 60, 150):
        for letters in (1, 2, 3, 8):
            for _ in range(12):
                x = [rng.randrange(letters) for _ in range(n)]
                if n >= 20:
                    a, p = rng.randrange(n // 2), rng.randrange(1, n // 4)
                    x[a:] = [x[a + i % p] for i in range(n - a)]
                yield x
    thue = [bin(i).count("1") & 1 for i in range(256)]
    fibonacci = [0], [0, 1]
    while len(fibonacci[1]) < 300:
        fibonacci = fibonacci[1], fibonacci[1] + fibonacci[0]
    yield from (thue, fibonacci[1], thue[:32] * 6, [0] * 100 + [1] + [0] * 99, ([0] * 9 + [1]) * 12 + [0] * 30)


def close_up(x):
    names = {v: i for i, v in enumerate(sorted(set(x)))}
    return [names[v] for v in x]


def test_lyndon_lengths():
    for x in map(close_up, sequences()):
        assert lyndon_lengths(x) == plain_lyndon(x), x


@pytest.mark.parametrize(("shortest", "copies"), [(24, 3), (4, 2), (2, 2), (9, 4)])
def test_runs(shortest, copies):
    for x in sequences():
        assert runs_of(np.array(x, np.int64), shortest, copies) == plain_runs(x, shortest, copies), x


def expected(doc, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = plain_runs(words)
    dropped = {i for s, q, k in runs for i in range(s + q, s + k)}
    best = min(runs, key=lambda r: (-Fraction(r[2], r[1]), r[0], r[1]), default=None)
    top = (best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4
    listed = "".join(f"{s},{k},{q}\n" for s, q, k in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def query(spark, rows, path):
    from shoptide.llm.queries import op12_periodic_runs

    spark.createDataFrame(rows, "doc_id long, text string, runs int").repartition(3).write.parquet(f"{path}/documents.parquet")
    return op12_periodic_runs(spark, str(path))


def test_odd_rows(spark, tmp_path):
    rng = random.Random(3)
    fresh = lambda n: " ".join(f"wé{rng.randrange(10**6)}" for _ in range(n))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a " * 23), (5, "a " * 24), (5, "a " * 24), (5, "b\x0cc\n" * 40), (None, "x y z " * 9)]
    rows += [(k, f"{fresh(k)} {'ab cd  Ab ' * (k % 13)}\n{fresh(5)} {fresh(9) + ' ' + fresh(3)}") for k in range(10, 60)]
    rows += [(100, fresh(300) + " " + (fresh(150) + " ") * 3), (101, "\u3000 a\u00a0b " * 30), (102, "x" * 5000 + " q" * 60), (103, ("p q " * 3 + "r ") * 40)]
    got = query(spark, [(*r, 7) for r in rows], tmp_path / "in").select(*COLUMNS)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)


def test_empty_table(spark, tmp_path):
    assert query(spark, [], tmp_path / "in").collect() == []


def test_texts(spark):
    docs = spark.createDataFrame([(1, "to be " * 20 + "or not", 3)], "doc_id long, text string, collapsed int")
    row = find_runs(docs).first()
    assert row.collapsed == "to be or not" and [tuple(r) for r in row.runs] == [(0, 40, 2)] and tuple(row.strongest) == (0, 40, 2)
    assert row.text == "to be " * 20 + "or not"


def test_registered_query(spark, folder, read):
    from shoptide.llm.queries import QUERIES

    want = [expected(r.doc_id, r.text) for r in read("documents").collect()]
    got = QUERIES["op12_periodic_runs"](spark, folder).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert sum(r[1] for r in want) > 0
