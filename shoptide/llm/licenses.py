"""Licence scans: TF-IDF cosine to templates, then inheritance from the nearest directory above.

Units are the lines of a file, and for licence files also the whole text. A unit's vector has the weights tf * idf of its
words; a word that no template has counts at the highest idf, so text around a notice lowers its cosine. The idf of the
template words is counted over the lines of all files: each task adds up its own, a row a word. A file has the licence of
its best unit if the cosine reaches ``least``; ties go to the smaller licence name.

A licence file lends its licence to its directory and all below. Only the different directories are joined with
their ancestors, not the files, and each takes the deepest that has one; files without a licence of their own then join their
directory. Of several licence files in a directory the best cosine, to twelve places, counts, then the smaller path.

Null and empty texts have no licence of their own. A null path has no directory and inherits nothing. Equal rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns
from shoptide.llm.shared import settle
from shoptide.llm.words import ALPHANUMERIC, small_batches, words_of

LEAST = 0.75
FILE_NAME = r"(?i)(^|/)(licen[cs]e|copying|unlicense|notice)[^/]*$"

# How licences are stated in headers and notices
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "SPDX-License-Identifier: CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2", "SPDX-License-Identifier: GPL-2.0-only"),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only"),
    "MIT": ("Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT"),
    "MPL-2.0": ("SPDX-License-Identifier: MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
}


class Matcher:
    """Templates as unit vectors over their words."""

    def __init__(self, templates: Mapping[str, Sequence[str]]):
        pairs = sorted((name, text) for name, texts in templates.items() for text in texts)
        self.names = [name for name, _ in pairs]
        words = words_of(pa.array([text for _, text in pairs], pa.string()), ALPHANUMERIC)
        self.words = np.unique(words.hashes)
        self.tf = np.zeros((len(pairs), len(self.words)))
        np.add.at(self.tf, (words.text, np.searchsorted(self.words, words.hashes)), 1)
        self.weigh(np.zeros(len(self.words)), 0)

    def weigh(self, lines_with: np.ndarray, lines: int) -> None:
        self.idf = np.log((lines + 1) / (lines_with + 1)) + 1
        self.rarest = np.log(lines + 1) + 1
        vectors = self.tf * self.idf
        self.vectors = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return at, self.words[at] == hashes

    def best(self, hashes: np.ndarray, unit: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each unit its best template and cosine."""
        best, score = np.zeros(units, np.int64), np.zeros(units)
        at, known = self.known(hashes)
        others = np.bincount(unit[~known], minlength=units) * self.rarest**2
        for begin in range(0, units, 4096):
            a, b = np.searchsorted(unit, (begin, begin + 4096))
            inside = np.flatnonzero(known[a:b]) + a
            tf = np.zeros((min(4096, units - begin), len(self.words)))
            np.add.at(tf, (unit[inside] - begin, at[inside]), 1)
            tf *= self.idf
            size = np.sqrt((tf**2).sum(1) + others[begin : begin + 4096])
            cosine = tf @ self.vectors.T / np.maximum(size, 1e-12)[:, None]
            best[begin : begin + 4096] = cosine.round(12).argmax(1)  # templates are sorted by name
            score[begin : begin + 4096] = cosine.max(1)
        return best, score


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Word hashes, the line and the text each word is of, and the number of lines with words, numbered over all texts."""
    words = words_of(texts, ALPHANUMERIC)
    line = np.searchsorted(np.flatnonzero(words.data == 0x0A), words.starts) + words.text
    new = np.ones(len(line), bool)
    new[1:] = np.diff(line) > 0
    return words.hashes, np.cumsum(new) - 1, words.text, int(new.sum())


def fit_matcher(files: DataFrame, text: str, templates: Mapping[str, Sequence[str]]) -> Matcher:
    """Templates weighted by how many of all lines have each of their words."""
    matcher = Matcher(templates)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = np.zeros(len(matcher.words), np.int64), 0
        for batch in batches:
            for some in small_batches(batch, "text"):
                hashes, line, _, n = lines_of(some.column("text"))
                at, known = matcher.known(hashes)
                different = np.unique(line[known] * len(matcher.words) + at[known])
                found += np.bincount(different % len(matcher.words), minlength=len(found))
                total += n
        yield pa.RecordBatch.from_pydict({"word": pa.array(np.arange(-1, len(found)), pa.int64()), "n": pa.array(np.concatenate(([total], found)), pa.int64())})

    sums = files.select(F.col(text).alias("text")).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = {r.word: r.n for r in sums.collect()}  # a row a template word
    matcher.weigh(np.array([counts.get(i, 0) for i in range(len(matcher.words))]), counts.get(-1, 0))
    return matcher


def scan_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    licence_file: Column | None = None,
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """``files`` without their text, with license, score, origin (own, inherited or null) and license_path (the licence file that
    an inherited licence is from). ``licence_file`` tells licence files, over the columns of ``files``; by default their names do."""
    is_file = F.coalesce(F.col(path).rlike(FILE_NAME) if licence_file is None else licence_file, F.lit(False))
    row = F.struct(*[F.col(c) for c in files.columns if c != text])
    rows = files.select(row.alias("row"), F.col(path).cast("string").alias("path"), F.col(text).alias("text"), is_file.alias("is_file"))
    shared = files.sparkSession.sparkContext.broadcast(fit_matcher(files, text, templates))

    def work(batch: pa.RecordBatch):
        matcher, n = shared.value, batch.num_rows
        hashes, line, of, lines = lines_of(batch.column("text"))
        best, score = matcher.best(hashes, line, lines)
        owner = np.zeros(lines, np.int64)
        owner[line] = of
        whole = np.flatnonzero(batch.column("is_file").to_numpy(zero_copy_only=False))
        whole_best, whole_score = matcher.best(hashes, of, n)
        best, score, owner = np.concatenate((best, whole_best[whole])), np.concatenate((score, whole_score[whole])), np.concatenate((owner, whole))
        score = np.minimum(score.round(12), 1)  # from here on: what differs by noise alone is equal
        order = np.lexsort((best, -score, owner))
        first = order[np.unique(owner[order], return_index=True)[1]]
        names, scores = [None] * n, [None] * n
        for i in first[score[first] >= least].tolist():
            names[owner[i]], scores[owner[i]] = matcher.names[best[i]], float(score[i])
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

    added = [T.StructField("own", T.StringType()), T.StructField("score", T.DoubleType())]
    stated = settle(add_columns(rows, "text", added, work).drop("text"), "licences")
    directory = F.regexp_replace("path", r"/?[^/]*$", "")
    stated = stated.withColumn("dir", directory)
    # the licence of each directory that has a licence file
    ranked = F.min(F.struct((-F.col("score")).alias("less"), F.col("path"), F.col("own").alias("license")))
    lent = stated.filter("is_file and own is not null and path is not null").groupBy("dir").agg(ranked.alias("x"))
    lent = settle(lent.select(F.col("dir").alias("ancestor"), "x.license", F.col("x.path").alias("from")), "lent")
    dirs = stated.filter("own is null and path is not null").select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(F.array_join(F.slice(parts, 1, k), "/").alias("ancestor"), k.alias("depth")))
    climbed = dirs.select("dir", F.explode(above).alias("up")).select("dir", "up.ancestor", "up.depth").distinct()
    deepest = climbed.join(lent, "ancestor").groupBy("dir").agg(F.max(F.struct("depth", "license", "from")).alias("x"))
    heirs = settle(deepest.select(F.col("dir").alias("heir"), F.col("x.license").alias("lent"), F.col("x.from").alias("from")), "heirs")
    done = stated.join(heirs, F.when(F.col("own").isNull(), F.col("dir")) == F.col("heir"), "left")
    origin = F.when(F.col("own").isNotNull(), "own").when(F.col("lent").isNotNull(), "inherited")
    result = [F.coalesce("own", "lent").alias("license"), F.col("score"), origin.alias("origin"), F.col("from").alias("license_path")]
    names = {"license", "score", "origin", "license_path"}
    return done.select(*[F.col("row")[c].alias(c) for c in files.columns if c != text and c not in names], *result)
