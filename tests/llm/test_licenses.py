"""Licences against dictionaries and loops."""

import math
import re
from collections import Counter

import pytest

from shoptide.llm.licenses import LEAST, TEMPLATES, scan_licenses
from shoptide.llm.queries import NOTICE_WORDS, QUERIES


def words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plainly(files):
    """{id: (license, score, origin, from)} of (id, path, text, is licence file)."""
    lines = [w for _, _, t, _ in files for line in (t or "").split("\n") if (w := words(line))]
    df = Counter(x for w in lines for x in set(w))
    templates = sorted((name, words(t)) for name, texts in TEMPLATES.items() for t in texts)
    vocabulary = {x for _, w in templates for x in w}
    idf = lambda x: math.log((len(lines) + 1) / ((df[x] if x in vocabulary else 0) + 1)) + 1

    def cosine(w, t):
        a, b = Counter(w), Counter(t)
        size = sum((n * idf(x)) ** 2 for x, n in a.items() if x in vocabulary) + sum(n * idf(x) ** 2 for x, n in a.items() if x not in vocabulary)
        return sum(a[x] * b[x] * idf(x) ** 2 for x in b) / math.sqrt(size * sum((n * idf(x)) ** 2 for x, n in b.items()))

    own, lent = {}, {}
    for i, path, text, is_file in files:
        units = [w for line in (text or "").split("\n") if (w := words(line)) and vocabulary & set(w)]
        units += [words(text)] if is_file and words(text) else []
        found = min(((-round(cosine(u, t), 9), name) for u in units for name, t in templates), default=None)
        if found and -found[0] >= LEAST:
            own[i] = (found[1], -found[0])
            if is_file and path is not None:
                d = path.rpartition("/")[0]
                lent[d] = min(lent.get(d, (0, "", "")), (-own[i][1], path, found[1]))
    out = {}
    for i, path, _, _ in files:
        out[i] = (*own[i], "own", None) if i in own else (None, None, None, None)
        d = None if i in own or path is None else path.rpartition("/")[0]
        while d is not None:
            if d in lent:
                out[i] = (lent[d][2], None, "inherited", lent[d][1])
                break
            d = d.rpartition("/")[0] if d else None
    return out


def same(found, wanted):
    assert found.keys() == wanted.keys()
    for i, (name, score, origin, of) in found.items():
        assert (name, origin, of) == (wanted[i][0], wanted[i][2], wanted[i][3]), i
        assert score == (None if wanted[i][1] is None else pytest.approx(wanted[i][1], abs=1e-6))


def test_query_equals_plain_scan(spark, folder, read):
    docs = read("documents").collect()
    short = lambda t: len(re.split(r"\s+", t)) <= NOTICE_WORDS
    wanted = plainly([(r.doc_id, f"{r.source}/{r.lang}/{r.doc_id}", r.text, short(r.text)) for r in docs])
    rows = QUERIES["op9_licenses"](spark, folder).collect()
    same({r.doc_id: tuple(r)[1:] for r in rows}, wanted)
    assert len(rows) == len(docs) and any(w[2] == "own" for w in wanted.values())


def test_nearest_ancestor(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "LICENSE", mit), (2, "a/b/COPYING", gpl), (3, "a/b/c/x.py", "code"), (4, "a/y.py", "code\nmore"), (5, "z.py", None), (6, "a/b/own.py", "# Licensed under CC BY 4.0\ncode"), (7, None, "code"), (8, "", "code"), (9, "q/LICENSE", "no words of it here at all"), (10, "q/r", "")]
    files += [(11, "a/b/c/d/" + "e/" * 50 + "f", "word " * 50_000), (12, "a/b/LICENSE-MIT", "\n".join([mit] * 3))]
    frame = spark.createDataFrame([(*f, "mine", 2) for f in files], "id long, path string, text string, own string, license int")
    rows = scan_licenses(frame).collect()
    wanted = plainly([(i, p, t, bool(p) and bool(re.search(r"(^|/)(LICENSE|COPYING)[^/]*$", p))) for i, p, t in files])
    same({r.id: (r.license, r.score, r.origin, r.license_path) for r in rows}, wanted)
    assert wanted[3][0] == wanted[11][0] == "GPL-3.0" and wanted[4][0] == wanted[5][0] == "MIT" and wanted[6][2] == "own"
    assert all(r.own == "mine" for r in rows)
    assert scan_licenses(frame.limit(0)).count() == 0
