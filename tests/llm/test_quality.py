"""Quality rules against a plain version, and texts without their boilerplate lines."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shoptide.llm.quality import MEASURES, apply_quality_rules, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, source string, text string, n_words string, row string"


def plain(rows, max_docs):
    """(measures..., removed words, base_failed, kept) by row number."""
    lines_of, docs_of = {}, defaultdict(set)
    for k, (doc, host, text) in enumerate(rows):
        lines_of[k] = [x for x in (text or "").split("\n") if WORD.search(x)]
        for line in lines_of[k]:
            docs_of[host, re.sub("[0-9]", "0", " ".join(WORD.findall(line.lower())))].add(doc)
    out = []
    for k, (doc, host, text) in enumerate(rows):
        text = text or ""
        words = WORD.findall(text)
        windows = defaultdict(list)
        for i in range(len(words) - 2):
            windows[tuple(words[i : i + 3])].append(i)
        repeated = {j for at in windows.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
        seen = Counter(lines_of[k])
        removed = 0
        for line in lines_of[k]:
            key = re.sub("[0-9]", "0", " ".join(WORD.findall(line.lower())))
            if len(docs_of[host, key]) > max_docs:
                removed += len(WORD.findall(line))
        n = len(words)
        failed = n < 50 or 100 * len(repeated) > 50 * n
        depleted = n - removed < 50 or removed * 100 > n * 50
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((doc, n, sum(map(len, words)), symbols, len(lines_of[k]) - len(seen), len(repeated), removed, failed, not failed and not depleted))
    return out


def result(frame):
    return [tuple(r) for r in frame.select("doc_id", *MEASURES, "n_removed_words", "base_failed", "kept").collect()]


def fixture():
    letters = str.maketrans("0123456789", "abcdefghij")
    fresh = lambda k, n: " ".join(f"w{k}x{i}é".translate(letters) for i in range(n))
    rows = [(k, "a" if k % 3 else "b", f"{fresh(k, 60)}\nShare  this {k}!\n{fresh(k + 1000, 5)}") for k in range(24)]
    rows += [(100 + k, "a", "\n".join([fresh(7, 45), "Share this 5!", fresh(9000 + k, 55 + 5 * k)])) for k in range(8)]
    rows += [(200, "a", None), (201, "a", ""), (202, None, " \t\n\x0b "), (203, None, "a b c a b c a b c " * 20)]
    rows += [(204, "b", "# * $ <p>\n \n# * $ <p>\nx|y"), (None, None, fresh(5, 70)), (5, "a", fresh(5, 90)), (5, "a", fresh(5, 90))]
    rows += [(206, "c", "long " + fresh(3, 9000) + "\n" + fresh(3, 40)), (207, "c", "a b c d " * 30), (208, "c", "aa aa aa aa"), (209, "c", "x y x y x y")]
    return rows


@pytest.mark.parametrize("max_docs", [0, 3, 20])
def test_equals_plain(spark, max_docs):
    rows = fixture()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert sorted(result(quality_rules(docs, max_docs=max_docs)), key=str) == sorted(plain(rows, max_docs), key=str)


def test_extra_columns_stay(spark):
    docs = spark.createDataFrame([(1, "a", "one two", "own", "mine")], SCHEMA)
    found = quality_rules(docs)
    assert found.columns == ["doc_id", "source", "row", *MEASURES, "n_removed_words", "base_failed", "kept"]
    assert found.first().row == "mine" and found.first().n_words == 2


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert result(quality_rules(docs)) == [] and apply_quality_rules(docs).collect() == []


def test_texts_lose_boilerplate(spark):
    rows = fixture()
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    kept = apply_quality_rules(docs, max_docs=6)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[1] == rows[1][2].replace("Share  this 1!\n", "")  # sixteen documents of its host have it
    assert set(texts) == {r[0] for r in plain(rows, 6) if r[-1]}


def test_no_python_in_plan(spark):
    docs = spark.createDataFrame([(*r, "x", "y") for r in fixture()], SCHEMA)
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_registered_query(spark, folder, read):
    from shoptide.llm.queries import QUERIES

    rows = [(r.doc_id, r.source, r.text) for r in read("documents").collect()]
    want = [r[:6] + r[7:] for r in plain(rows, 20)]
    got = QUERIES["op11_quality_rules"](spark, folder).select("doc_id", *MEASURES, "base_failed", "kept")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert got.select(F.count_if(~F.col("kept"))).first()[0] > 0
