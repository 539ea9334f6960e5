"""Line dedup by a deletion-neighbourhood join, within one edited word.

A line is dropped where an equal line, or one that differs by one word added, left out or replaced, stands earlier: in
a document with a smaller id, or further up in the same one. Words are what white space parts, with A-Z lower-cased. Lines of fewer
than NEAR words are only dropped if equal; blank lines never are.

Two lines within one edit have a variant in common: each with the edited word deleted, or the longer one with
it deleted and the shorter as it is. Emitting a variant per word for every line of a corpus is too much, so variants are made twice:

1. Coarse, for all lines: a whole block of words around the edit is deleted (two to four blocks a line), once with and once
   without the word that the other line may have more. Lines within one edit still have a variant in common, and there are
   five variants a line instead of one a word. Variants are hashed keys; a key that only one line has is forgotten, by an aggregation.
2. Fine, only for lines that share a coarse key: one word deleted. Lines of equal length that share a variant at the same
   place are within one edit of each other, all of them, so the earliest of a group stands for it: no pairs are
   made within a group, and a key of any size is combined before the shuffle. Longer lines meet the line that equals their variant.
3. The words of each line and the earliest one found are compared.

The joins are shuffles at every size: what they join grows with the corpus, so a broadcast that a small one allows tells
nothing of the cost on a large one.

Nulls and empty texts have no lines. A null id comes before all. Rows that repeat an id count as the same place, so a line never
drops itself in its twin; each loses only lines of its own text. A document that loses all its lines is dropped with them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.shared import settle
from shoptide.llm.words import UNSPACED, WORDS, Words, mixed, small_batches, words_of

NEAR = 5
PAIR = ["h1", "h2"]


def tiers(longest: int) -> list[tuple[int, int, int]]:
    """(least words, most words, words of a block); two lengths that differ by one share a tier."""
    out, least = [(4, 8, 2), (8, 16, 4)], 16
    while least <= longest:
        out.append((least, least * 3 // 2, least * 3 // 4))
        least = least * 3 // 2
    return out


class Lines:
    """The lines of some texts that have words: the text and number of each, its first word and its number of words."""

    def __init__(self, words: Words):
        self.words = words
        breaks = np.flatnonzero(words.data == 0x0A)
        line = np.searchsorted(breaks, words.starts)
        unit = line + words.text
        new = np.ones(len(unit), bool)
        new[1:] = np.diff(unit) > 0
        self.first = np.flatnonzero(new)
        self.n = np.diff(np.append(self.first, len(unit)))
        self.text = words.text[self.first]
        self.number = line[self.first] - np.searchsorted(breaks, words.begins[self.text])

    def hashes(self, lane: int) -> np.ndarray:
        return WORDS[lane].spans(self.words.hashes, self.first, self.first + self.n)

    def without(self, line: np.ndarray, at: np.ndarray, size: np.ndarray, lane: int = 0) -> np.ndarray:
        """Hashes of lines without the ``size`` words from the word ``at``, which count also where the words end before."""
        first, n = self.first[line], self.n[line]
        stop = np.minimum(at + size, n)
        left = (n - (stop - at)).astype(np.uint64)
        powers = WORDS[lane]
        before = powers.raw(self.words.hashes, first, first + at)
        after = powers.raw(self.words.hashes, first + stop, first + n)
        return mixed(before + after * powers.upto(len(self.words.hashes) + 1)[0][at] + mixed(left))

    def coarse(self) -> tuple[np.ndarray, np.ndarray]:
        """(line, key) of the block variants."""
        lines, keys = [], []
        for least, most, block in tiers(int(self.n.max()) if len(self.n) else 0):
            mine = np.flatnonzero((self.n >= max(least, NEAR - 1)) & (self.n <= most))
            count = self.n[mine] // block + 1
            line = np.repeat(mine, count)
            nth = np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count)
            at = nth * block
            for size in (block, block - 1):
                key = self.without(line, at, np.full(len(line), size))
                lines.append(line)
                keys.append(mixed(key + (nth * 100_003 + block).astype(np.uint64)))
        if not lines:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        line, key = np.concatenate(lines), np.concatenate(keys)
        order = np.argsort(line, kind="stable")
        return line[order], key[order]


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def all_lines(docs: DataFrame) -> DataFrame:
    """(doc, mark, line, h1, h2, keys) of the lines with words of (doc, mark, text)."""
    schema = T.StructType([docs.schema["doc"], docs.schema["mark"]]).add("line", "long").add("h1", "long").add("h2", "long").add("keys", T.ArrayType(T.LongType()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "text"):
                lines = Lines(words_of(some.column("text"), UNSPACED))
                line, key = lines.coarse()
                keys = pa.ListArray.from_arrays(pa.array(np.searchsorted(line, np.arange(len(lines.n) + 1)), pa.int32()), signed(key))
                of = pa.array(lines.text)
                columns = [some.column("doc").take(of), some.column("mark").take(of), pa.array(lines.number), signed(lines.hashes(0)), signed(lines.hashes(1)), keys]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return docs.select("doc", "mark", "text").mapInArrow(work, schema)


def wanted_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h1, h2, words) of the lines in ``wanted`` (doc, line, h1, h2), cut from their documents."""
    by_doc = wanted.groupBy(F.col("doc").alias("of")).agg(F.collect_list("line").alias("lines"))
    rows = docs.join(by_doc.hint("shuffle_hash"), docs["doc"].eqNullSafe(by_doc["of"])).select("text", "lines")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "text"):
                lines = Lines(words_of(some.column("text"), UNSPACED))
                asked = [set(x) for x in some.column("lines").to_pylist()]
                mine = np.array([i for i, (t, k) in enumerate(zip(lines.text.tolist(), lines.number.tolist())) if k in asked[t]], np.int64)
                w = lines.words
                texts = [b" ".join(w.word(j) for j in range(f, f + n)).decode() for f, n in zip(lines.first[mine].tolist(), lines.n[mine].tolist())]
                yield pa.RecordBatch.from_arrays([signed(lines.hashes(0)[mine]), signed(lines.hashes(1)[mine]), pa.array(texts, pa.string())], [*PAIR, "words"])

    return rows.mapInArrow(work, "h1 long, h2 long, words string")


def fine_variants(texts: DataFrame) -> DataFrame:
    """(x1, x2, at, h1, h2, place) of each line: without its word ``at``, or whole, ``at`` -1."""
    schema = T.StructType().add("x1", "long").add("x2", "long").add("at", "long").add("h1", "long").add("h2", "long").add(texts.schema["place"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in small_batches(batch, "words", 1 << 18):
                lines = Lines(words_of(some.column("words"), UNSPACED))
                whole = np.arange(len(lines.n))
                line = np.concatenate((whole, np.repeat(whole, lines.n)))
                at = np.concatenate((np.full(len(whole), -1), np.arange(lines.n.sum()) - np.repeat(np.cumsum(lines.n) - lines.n, lines.n)))
                # a line of NEAR - 1 words is only near to a longer one
                able = (at < 0) | (lines.n[line] >= NEAR)
                line, at = line[able], at[able]
                zero = np.zeros(len(line), np.int64)
                keys = [lines.without(line, np.maximum(at, 0), zero + (at >= 0), lane) for lane in (0, 1)]
                of = pa.array(lines.text[line])
                yield pa.RecordBatch.from_arrays([*map(signed, keys), pa.array(at), *(some.column(c).take(of) for c in (*PAIR, "place"))], schema.names)

    return texts.select(*PAIR, "place", "words").mapInArrow(work, schema)


def one_edit(a: list[str], b: list[str]) -> bool:
    """Whether two word lists are within one word added, left out or replaced."""
    short, long = sorted((a, b), key=len)
    if len(long) - len(short) > 1:
        return False
    i = 0
    while i < len(short) and short[i] == long[i]:
        i += 1
    return short[i + (len(short) == len(long)) :] == long[i + 1 :]


def near_earlier(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(h1, h2, earlier) of the different lines that have one within one edit standing earlier: its place."""
    keyed = lines.select(*PAIR, F.explode("keys").alias("key"))
    # the keys that different lines have: two hashes a key, whatever its rows
    shared = settle(keyed.groupBy("key").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).filter("low <> high").select("key"), "keys")
    near = settle(keyed.join(shared.hint("merge"), "key", "left_semi").select(*PAIR).distinct(), "near")
    places = lines.join(near.hint("merge"), PAIR, "left_semi").groupBy(*PAIR).agg(F.min(F.struct("doc", "line")).alias("place"))
    places = settle(places, "places")
    cut = wanted_texts(docs, places.select("place.doc", "place.line")).join(places, PAIR).dropDuplicates(PAIR)
    texts = settle(cut.select(*PAIR, "place", "words").filter(F.size(F.split("words", " ")) >= NEAR - 1), "texts")
    fine = settle(fine_variants(texts), "variants")
    x = ["x1", "x2"]
    same = fine.filter("at >= 0").groupBy(*x, "at").agg(F.min("place").alias("earlier"), F.count("*").alias("n"))
    same = settle(same.filter("n > 1").drop("n"), "same")
    whole = fine.groupBy(*x).agg(F.min(F.when(F.col("at") < 0, F.col("place"))).alias("whole"), F.min(F.when(F.col("at") >= 0, F.col("place"))).alias("longer"))
    whole = settle(whole.filter("whole is not null and longer is not null"), "whole")
    met = fine.join(same.hint("merge"), [*x, "at"]).select(*PAIR, "place", "earlier")
    other = F.when(F.col("at") < 0, F.col("longer")).otherwise(F.col("whole"))
    met = met.unionByName(fine.join(whole.hint("merge"), x).select(*PAIR, "place", other.alias("earlier")))
    found = met.filter("earlier < place").groupBy(*PAIR).agg(F.min("earlier").alias("earlier"))
    by_place = texts.select(F.col("place").alias("earlier"), F.col("words").alias("other"))
    pairs = found.join(texts.select(*PAIR, "words"), PAIR).join(by_place, "earlier")

    @F.pandas_udf("boolean")
    def close(a, b):
        import pandas as pd

        split = ((x.split(" "), y.split(" ")) for x, y in zip(a, b))
        return pd.Series([max(len(x), len(y)) >= NEAR and one_edit(x, y) for x, y in split])

    return pairs.filter(close("words", "other")).select(*PAIR, "earlier")


def dropped_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line, kept_doc_id, kept_line, edits, text_hash) of the lines to drop, lines counted from 0, and the earlier line each
    repeats: its earliest neighbour within one edit, or its own first occurrence. The hash of the whole text tells rows that share an id apart."""
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    lines = settle(all_lines(rows), "lines")
    near = near_earlier(rows, lines)
    firsts = lines.groupBy(*PAIR).agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("n"))
    decided = firsts.join(near, PAIR, "left").filter("n > 1 or earlier is not null")
    decided = settle(decided.select(*PAIR, F.least(F.coalesce("earlier", "first"), "first").alias("target"), F.when(F.col("earlier") < F.col("first"), 1).otherwise(0).alias("edits")), "decided")
    marked = lines.select("doc", "mark", "line", *PAIR).join(decided.hint("merge"), PAIR).filter(F.struct("doc", "line") > F.col("target"))
    return marked.select(F.col("doc").alias(doc_id), "line", F.col("target.doc").alias("kept_doc_id"), F.col("target.line").alias("kept_line"), "edits", F.col("mark").alias("text_hash"))


def drop_lines(docs: DataFrame, dropped: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines in ``dropped``, nor the documents that have lost all their words with them."""
    by_doc = dropped.groupBy(F.col(doc_id).alias("_of"), F.col("text_hash").alias("_hash")).agg(F.collect_set(F.col("line").cast("int")).alias("_lines"))
    rows = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("_id"), F.col(text).alias("text"), F.xxhash64(text).alias("_mark"))
    joined = rows.join(by_doc, rows["_id"].eqNullSafe(by_doc["_of"]) & (rows["_mark"] == by_doc["_hash"]), "left").select("row", "text", "_lines")
    # set difference and lookups by place: the work grows with the lines, not with lines times dropped ones
    joined = joined.withColumn("_all", F.split("text", "\n"))
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size("_all") - 1), "_lines"), lambda i: F.get("_all", i))
    cut = F.when(F.col("_lines").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    done = joined.withColumn("cut", cut).filter(F.col("_lines").isNull() | F.col("cut").rlike(r"[^ \t\n\x0B\f\r]"))
    return done.select(*[F.col("cut").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return drop_lines(docs, dropped_lines(docs, doc_id, text), doc_id, text)
