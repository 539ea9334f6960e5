"""Toxicity grades by cumulative-link ordinal regression over words.

One set of weights serves all grades: with a text's score s (the sum of the weights of the features it has),
``P(grade >= k) = logistic(s - threshold_k)`` for ordered thresholds. The expected severity is the sum of these probabilities.
A text's features are its different words, the beginnings of its words (inflected languages vary the ends), and which of
these it holds at least twice.

Fit. The features of a bounded sample of the labelled documents - ``sample`` labels in a hash order of their ids - are counted by
aggregates and screened by how differently often the documents of grade 0 and of higher grades have them. Only which of the sample hold the
``most`` screened ones goes to the driver, however long the texts are. There the weights are found by proximal gradient steps,
whose L1 penalty leaves features without influence at zero. So a long clean text does not add up noise.

Scoring. The few weighted features are broadcast as sorted 64-bit hashes (no buckets, so rare words do not fall on
toxic ones); each task looks the words of its whole texts up. Nothing is shuffled.

A null or empty text has score 0 and so grade 0. Labels without grade or document are left out; of several labels of a document the highest
counts. Without labels, or with only one grade among them, everything gets severity 0. Equal rows get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns
from shoptide.llm.shared import settle
from shoptide.llm.words import Words, prefix_hashes, small_batches, words_of

SAMPLE = 4_000
FEATURES = 4_096
BEGINNINGS = (4, 5, 6, 7)  # characters
LEVELS = 3
LEAST_DOCUMENTS = 3  # that hold a word
STEPS = 1_000
PENALTY = 2e-4
WIDEST = 20.0


def logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and word beginnings, and the text each is of."""
    hashes, texts = [words.hashes], [words.text]
    for chars in BEGINNINGS:
        long, some = prefix_hashes(words, chars)
        hashes.append(some)
        texts.append(words.text[long])
    return np.concatenate(hashes), np.concatenate(texts)


@dataclass
class Ordinal:
    """``words`` sorted; ``weights`` has a row for holding a word and one for holding it twice or more;
    ``thresholds`` are those of grades 1, 2, ..."""

    words: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5  # a text has grade k if P(grade >= k) reaches this

    def scores(self, hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
        """The score of each of n texts, from its features' hashes and the text each is of."""
        if not len(self.words) or not len(hashes):
            return np.zeros(n)
        likely = np.zeros(1 << 16, dtype=bool)
        likely[self.words & np.uint64(0xFFFF)] = True
        maybe = np.flatnonzero(likely[hashes & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.words, hashes[maybe]), len(self.words) - 1)
        known = self.words[at] == hashes[maybe]
        pairs, times = np.unique(text[maybe[known]] * len(self.words) + at[known], return_counts=True)
        word = pairs % len(self.words)
        return np.bincount(pairs // len(self.words), self.weights[0, word] + self.weights[1, word] * (times > 1), minlength=n)

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) by text and k."""
        return logistic(scores[:, None] - self.thresholds)


def apart(at: np.ndarray, rows: np.ndarray, grades: np.ndarray, n: int) -> np.ndarray:
    """How differently often documents of grade 0 and above hold each of n words, in standard deviations."""
    holding = np.bincount(at, minlength=n)
    expected = holding * (grades > 0).mean()
    out = np.abs(np.bincount(at, grades[rows] > 0, minlength=n) - expected) / np.sqrt(expected * (1 - holding / len(grades)) + 1)
    return np.where(holding < LEAST_DOCUMENTS, 0, out)


def fit(hashes: np.ndarray, rows: np.ndarray, twice: np.ndarray, grades: np.ndarray, most: int = FEATURES) -> Ordinal:
    """``hashes[i]`` is a feature that document ``rows[i]`` holds, each pair once, and ``twice[i]`` whether it does so
    more than once; ``grades`` by document."""
    levels = int(grades.max()) if len(grades) else 0
    if not levels or not (grades < levels).any():
        return Ordinal(np.empty(0, np.uint64), np.empty((2, 0)), np.full(max(levels, 1), WIDEST))
    words, at = np.unique(hashes, return_inverse=True)
    by = np.maximum(apart(at, rows, grades, len(words)), apart(at[twice], rows[twice], grades, len(words)))
    kept = np.sort(np.argsort(-by, kind="stable")[:most])
    kept = kept[by[kept] > 0]
    number = np.full(len(words), -1)
    number[kept] = np.arange(len(kept))
    words, at = words[kept], number[at]
    # columns of the words, then of the words held twice
    rows = np.concatenate((rows[at >= 0], rows[(at >= 0) & twice]))
    at = np.concatenate((at[at >= 0], at[(at >= 0) & twice] + len(words)))
    columns = 2 * len(words)
    n = len(grades)
    weights = np.zeros(columns)
    rank = np.arange(1, levels + 1)
    above = np.clip(((grades[:, None] >= rank).sum(0) + 0.5) / (n + 1), 1e-6, 1 - 1e-6)
    thresholds = np.log((1 - above) / above)
    # AdaGrad steps: rare words move as fast as frequent ones
    size_w, size_t = np.full(columns, 1e-8), np.full(levels, 1e-8)
    edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
    for _ in range(STEPS):
        scores = np.bincount(rows, weights[at], minlength=n)
        low, high = edges[grades] - scores, edges[grades + 1] - scores
        under, over = logistic(low), logistic(high)
        chance = np.maximum(over - under, 1e-12)
        # derivatives of the mean of -log chance
        by_score = (1 - under - over) / n
        by_weight = np.bincount(at, by_score[rows], minlength=columns)
        steep_low, steep_high = under * (1 - under) / chance / n, over * (1 - over) / chance / n
        by_edge = np.bincount(grades, steep_low, minlength=levels + 1)[1:] - np.bincount(grades, steep_high, minlength=levels + 1)[:-1]
        size_w += by_weight**2
        size_t += by_edge**2
        step = 0.5 / np.sqrt(size_w)
        weights -= step * by_weight
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * PENALTY, 0)
        thresholds = np.maximum.accumulate(np.clip(thresholds - 0.1 / np.sqrt(size_t) * by_edge, -WIDEST, WIDEST) + rank * 1e-6)
        edges = np.concatenate(([-np.inf], thresholds, [np.inf]))
    weights = weights.reshape(2, -1)
    kept = (weights != 0).any(0)
    return Ordinal(words[kept], weights[:, kept], thresholds)


def feature_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, grade, text) to (id, grade, the different features as signed numbers, whether each occurs twice)."""
    for batch in batches:
        for some in small_batches(batch, "text"):
            hashes, text = features(words_of(some.column("text")))
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order], text[order]
            first = np.flatnonzero(np.concatenate((np.ones(min(1, len(text)), bool), (np.diff(text) > 0) | (hashes[1:] != hashes[:-1]))))
            twice = np.diff(np.append(first, len(hashes))) > 1
            offsets = pa.array(np.searchsorted(text[first], np.arange(some.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, x) for x in (pa.array(hashes[first].view(np.int64)), pa.array(twice))]
            yield pa.RecordBatch.from_arrays([some.column("id"), some.column("grade"), *lists], ["id", "grade", "words", "twice"])


def spread_grades(marks: np.ndarray, toxic: np.ndarray, levels: int) -> np.ndarray:
    """Grades of documents that are only known to be toxic or not: the toxic ones in ``levels`` equal parts by their marks,
    how many features they hold that nearly only toxic documents have."""
    order = np.flatnonzero(toxic > 0)
    order = order[np.argsort(marks[order], kind="stable")]
    grades = np.zeros(len(toxic), dtype=np.int64)
    grades[order] = 1 + np.arange(len(order)) * levels // max(1, len(order))
    return grades


def best_cut(chances: np.ndarray, toxic: np.ndarray) -> float:
    """The middle of the cuts with the best F1 on held-out documents."""
    if not toxic.any():
        return 0.5
    cuts = np.arange(0.1, 0.91, 0.05)
    f1 = [2 * (toxic & (chances >= c)).sum() / (toxic.sum() + (chances >= c).sum()) for c in cuts]
    return float(np.median(cuts[np.array(f1) >= max(f1) - 1e-12]))


def feature_counts(pairs: DataFrame) -> DataFrame:
    """(word, n and bad) over pairs (word, twice, grade, held): how many documents hold a feature, and how many of these are of grade 1 or
    more; the same as known_n and known_bad without the held-out documents, and as twice_n and twice_bad where they hold it twice."""
    counts = []
    for name, those in (("", F.lit(True)), ("known_", ~F.col("held")), ("twice_", ~F.col("held") & F.col("twice"))):
        counts += [F.count_if(those).alias(f"{name}n"), F.count_if(those & (F.col("grade") > 0)).alias(f"{name}bad")]
    return pairs.groupBy("word").agg(*counts).filter(F.col("n") >= LEAST_DOCUMENTS)


def most_apart(counts: DataFrame, grades: np.ndarray, most: int) -> DataFrame:
    """The ``most`` features that tell the known documents of these grades best apart, as ``fit`` would choose them; ``apart`` as a column."""
    share, n = float((grades > 0).mean()) if len(grades) else 0.0, max(1, len(grades))

    def by(name: str) -> Column:
        holding, bad = F.col(f"{name}_n"), F.col(f"{name}_bad")
        expected = holding * F.lit(share)
        return F.when(holding >= LEAST_DOCUMENTS, F.abs(bad - expected) / F.sqrt(expected * (1 - holding / F.lit(n)) + 1)).otherwise(0.0)

    ranked = counts.select("word", F.greatest(by("known"), by("twice")).alias("by")).filter("by > 0")
    # hashes are unsigned, so negative numbers are the largest
    return ranked.orderBy(F.col("by").desc(), F.col("word") < 0, "word").limit(most).select("word")


def train(
    docs: DataFrame,
    labels: DataFrame,
    grade: Column,
    levels: int = LEVELS,
    doc_id: str = "doc_id",
    text: str = "text",
    sample: int = SAMPLE,
    most: int = FEATURES,
) -> Ordinal:
    """The model of a sample of ``sample`` labels. ``grade`` over the labels gives 0, 1, 2, ...; where it only
    tells 0 from 1, the documents of grade 1 are parted into ``levels`` grades. A fourth of the sample is held out to choose the cut."""
    spark = docs.sparkSession
    graded = labels.select(F.col(doc_id).alias("id"), grade.cast("int").alias("grade")).na.drop().filter("grade >= 0")
    chosen = graded.groupBy("id").agg(F.max("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(sample)
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    # at most ``sample`` ids
    rows = texts.join(F.broadcast(chosen), "id")
    # an id that many rows repeat counts once, with one of its texts
    rows = rows.groupBy("id").agg(F.first("grade").alias("grade"), F.min_by("text", F.xxhash64("text")).alias("text"))
    schema = T.StructType([rows.schema["id"], rows.schema["grade"]])
    schema.add("words", T.ArrayType(T.LongType())).add("twice", T.ArrayType(T.BooleanType()))
    sets = settle(rows.mapInArrow(feature_sets, schema), "features")
    found = sets.select("id", "grade").toArrow().sort_by("id")
    if not len(found):
        return fit(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64))
    grades = found["grade"].to_numpy().astype(np.int64)
    toxic = grades > 0
    held = np.random.default_rng(0).random(len(grades)) < 0.25
    numbers = found.select(["id"]).append_column("number", pa.array(np.arange(len(grades)))).append_column("held", pa.array(held))
    pairs = sets.join(F.broadcast(spark.createDataFrame(numbers)), "id")
    pairs = pairs.select("number", "grade", "held", F.inline(F.arrays_zip(F.col("words").alias("word"), "twice")))
    counts = settle(feature_counts(pairs), "counts")
    if grades.max() == 1:
        marked = counts.filter((F.col("n") >= 5) & (F.col("bad") >= F.lit(0.9) * F.col("n"))).select("word")
        holding = pairs.filter("grade > 0").join(marked, "word", "left_semi")
        sums = holding.groupBy("number").agg(F.sum(1 + F.col("twice").cast("int")).alias("marks")).toArrow()
        marks = np.zeros(len(grades))
        marks[sums["number"].to_numpy()] = sums["marks"].to_numpy()
        grades = spread_grades(marks, grades, levels)
    # the driver gets the pairs of the screened features only
    screened = most_apart(counts, grades[~held], most)
    kept = pairs.select("number", "word", "twice").join(F.broadcast(screened), "word").toArrow()
    rows, hashes, flags = kept["number"].to_numpy(), kept["word"].to_numpy().view(np.uint64), kept["twice"].to_numpy()
    order = np.lexsort((hashes, rows))
    rows, hashes, flags = rows[order], hashes[order], flags[order]
    known = ~held[rows]
    number = np.cumsum(~held) - 1
    model = fit(hashes[known], number[rows[known]], flags[known], grades[~held], most)
    times = np.where(flags, 2, 1)[~known]  # a feature held more than once counts as held twice
    scores = model.scores(np.repeat(hashes[~known], times), np.repeat(rows[~known], times), len(grades))
    neutral = float(model.exceed(np.zeros(1))[0, 0])
    # a text without any weighted feature gives no ground to reject it
    return replace(model, cut=max(best_cut(model.exceed(scores)[held, 0], toxic[held]), neutral + 1e-9))


def grade_toxicity(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """``docs`` with expected_severity, p_toxic (of grade 1 or more), and grade (the highest that is likely enough)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = [T.StructField("expected_severity", T.DoubleType()), T.StructField("p_toxic", T.DoubleType()), T.StructField("grade", T.IntegerType())]

    def work(batch: pa.RecordBatch):
        words = words_of(batch.column(text))
        exceed = shared.value.exceed(shared.value.scores(*features(words), batch.num_rows))
        return [pa.array(exceed.sum(1)), pa.array(exceed[:, 0]), pa.array((exceed >= shared.value.cut).sum(1), type=pa.int32())]

    return add_columns(docs, text, added, work)


def drop_toxic(docs: DataFrame, model: Ordinal, text: str = "text") -> DataFrame:
    """The documents of grade 0, as they were."""
    graded = grade_toxicity(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), model)
    return graded.filter("grade = 0").select("row.*")
