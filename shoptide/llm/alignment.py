"""Alignment of two tokenizers over a corpus: which tokens of one overlap which of the other, and how usual each pair is.

A is a byte-level BPE file that gets a space and the text, B a sentencepiece model that gets the text and adds the space itself, so the
tokens of both part the same bytes. Where both end a token, a group ends; two tokens are linked if their bytes overlap. A pair of ids counts once for
each document that holds it linked.

1. Equal texts are brought together by a shuffle on the full text, which combines them before it, and counted: each distinct text is
   tokenised and aligned once, and weighs as many documents as have it.
2. A text is cut before a space that stands behind a character that is not white space. There, both tokenizers begin anew, so a group ends. The units between are aligned
   on their own, and a worker keeps what it has found for the short ones. What is settled of a text: its measures, its different pairs and how many links each has.
3. Pairs are counted over all texts, by weight, combined before the shuffle; each A id's highest count is at most a row a vocabulary entry.
4. The links are given their pair's count in two tiers: a broadcast table of the TABLE most usual pairs, and for all other pairs a join by shuffle.
   Both always run, and the result does not depend on TABLE.
5. A text's measures are joined to the ids of its documents by a digest of the text. Texts that more than a HEAVY-th of all documents have are fewer than
   HEAVY and are broadcast, all others joined by shuffle, so copies of one text are never gathered in one task.

Null and empty texts have no tokens, nor have texts that the tokens of A or B do not give back byte by byte: their measures are zeros, their
groups the empty string. Equal rows get a row each. Special strings in a text are plain text. Columns of the input that are
named like an added one are replaced.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.shared import settle
from shoptide.llm.words import small_batches

TABLE = 1 << 19
HEAVY = 10_000
LONGEST = 32
TOGETHER = 512  # units that are encoded as one text
CACHE = 400_000

SPACE = "▁"  # sentencepiece's sign for a space
CUT = re.compile(r"(?<=\S)(?= )")
MEASURES = ("n_a", "n_b", "n_groups", "n_links")
KEY = "key"
STEPS = 16  # of the counts' doublings


def byte_of() -> dict[str, int]:
    """The character that a byte-level vocabulary writes for each byte: printable ones stand for themselves, the others are
    moved up behind the first 256."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Aligner:
    """The two tokenizers, and the units that the worker has aligned."""

    def __init__(self, a_path: str, b_path: str):
        # Spark's tasks use the cores; threads of the library would only get in each other's way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        decoded, special = byte_of(), {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            self.a_bytes[i] = entry.encode() if entry in special else bytes(decoded[c] for c in entry)
        piece = self.b.id_to_piece
        self.b_bytes = [
            bytes([int(piece(i)[3:-1], 16)]) if self.b.is_byte(i) else piece(i).replace(SPACE, " ").encode() for i in range(self.b.get_piece_size())
        ]
        # no piece reaches over a cut, and the model changes nothing but spaces
        probe = "  a bÉﬁ\n\t c "
        same = self.b.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        self.cuts = same and not any(SPACE in piece(i).lstrip(SPACE) for i in range(len(self.b_bytes)))
        self.fresh: dict[str, tuple] = {}
        self.stale: dict[str, tuple] = {}

    def units(self, text: str) -> list[str]:
        """The text with a space before it, cut where both tokenizers begin anew."""
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def align(self, units: list[str]) -> list[tuple | None]:
        """Of each unit (tokens of A, tokens of B, groups as text, the pairs of the links as 64-bit numbers), or None where tokens do not give back its bytes."""
        # those that end in white space would not stay apart from the next one; of a lone space the model makes nothing
        able = [i for i, x in enumerate(units) if not x[-1].isspace()]
        found = dict(zip(able, self._together([units[i] for i in able])))
        return [found[i] if i in found else self._together([x])[0] for i, x in enumerate(units)]

    def _together(self, units: list[str]) -> list[tuple | None]:
        """The units encoded as one text, or one by one if that does not give back their bytes."""
        if not units:
            return []
        data = [x.encode() for x in units]
        whole = "".join(units)
        a = self.a.encode(whole, add_special_tokens=False).ids
        if len(whole) == 1:
            one, none = self.b.encode(["a ", "a"], num_threads=1)
            b = one[len(none) :]
        else:
            b = self.b.encode(whole[1:], num_threads=1)
        as_a, as_b, joined = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b], b"".join(data)
        if b"".join(as_a) == joined == b"".join(as_b):
            return self._walk(a, b, list(map(len, as_a)), list(map(len, as_b)), list(accumulate(map(len, data))))
        return [None] if len(units) == 1 else [self._together([x])[0] for x in units]

    @staticmethod
    def _walk(a: list[int], b: list[int], a_size: list[int], b_size: list[int], ends: list[int]) -> list[tuple]:
        """One walk over both: each step's tokens overlap, and the one that ends first gives way to its next. Both end at each of ``ends``."""
        out, links, groups = [], array("q"), []
        i = j = group_a = group_b = first_a = first_b = unit = 0
        a_end, b_end = a_size[0], b_size[0]
        while True:
            links.append(a[i] << 32 | b[j])
            if a_end < b_end:
                i += 1
                a_end += a_size[i]
            elif b_end < a_end:
                j += 1
                b_end += b_size[j]
            else:
                i, j = i + 1, j + 1
                one = i - group_a == 1 == j - group_b
                groups.append(f"{a[group_a]}|{b[group_b]}" if one else f"{','.join(map(str, a[group_a:i]))}|{','.join(map(str, b[group_b:j]))}")
                group_a, group_b = i, j
                if a_end == ends[unit]:
                    out.append((i - first_a, j - first_b, ";".join(groups), links.tobytes()))
                    links, groups, first_a, first_b, unit = array("q"), [], i, j, unit + 1
                    if unit == len(ends):
                        return out
                a_end, b_end = a_end + a_size[i], b_end + b_size[j]

    def texts(self, texts: list[str]) -> list[list[tuple]]:
        """The aligned units of each text; none where its tokens do not give it back."""
        if len(self.fresh) > CACHE:
            self.stale, self.fresh = self.fresh, {}
        known, stale, long = self.fresh, self.stale, {}
        cut = [self.units(x) for x in texts]
        wanted = [x for x in {x for units in cut for x in units} if x not in known]
        known.update((x, stale[x]) for x in wanted if x in stale)
        wanted = [x for x in wanted if x not in known]
        for begin in range(0, len(wanted), TOGETHER):
            some = wanted[begin : begin + TOGETHER]
            for x, made in zip(some, self.align(some)):
                (known if len(x) <= LONGEST else long)[x] = made
        out = []
        for text, units in zip(texts, cut):
            found = [known[x] if x in known else long[x] for x in units]
            # what one unit lacks another could only make up for in the text as a whole
            out.append([x for x in self._together([" " + text]) if x] if None in found else found)
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner; it and its cache outlive the task."""
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a_path, b_path)
    return _aligners[a_path, b_path]


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256)).alias(KEY)


def align_texts(texts: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(key, n_docs, measures, groups_sha256, pairs, links) of (text, key, n_docs): the different pairs of a text,
    id of A times 2**32 plus id of B, and how many links each has."""
    names = [KEY, "n_docs", *MEASURES, "groups_sha256", "pairs", "links"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(a_path, b_path)
        for batch in batches:
            for some in small_batches(batch, "text"):
                measures, digests, pairs, links, ends = [], [], [], [], [0]
                for units in tool.texts(some.column("text").to_pylist()):
                    flat = np.frombuffer(b"".join([u[3] for u in units]), np.int64)
                    different, many = np.unique(flat, return_counts=True)
                    groups = ";".join([u[2] for u in units])
                    measures.append((sum(u[0] for u in units), sum(u[1] for u in units), groups.count("|"), len(flat)))
                    digests.append(hashlib.sha256(groups.encode()).hexdigest() if units else "")
                    pairs.append(different)
                    links.append(many)
                    ends.append(ends[-1] + len(different))
                columns = [some.column(c) for c in (KEY, "n_docs")]
                columns += [pa.array([m[i] for m in measures], pa.int64()) for i in range(len(MEASURES))]
                columns.append(pa.array(digests, pa.string()))
                places = pa.array(ends, pa.int32())
                columns.append(pa.ListArray.from_arrays(places, pa.array(np.concatenate(pairs) if pairs else [], pa.int64())))
                columns.append(pa.ListArray.from_arrays(places, pa.array(np.concatenate(links) if links else [], pa.int32(), safe=False)))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "key binary, n_docs long, " + ", ".join(f"{m} long" for m in MEASURES) + ", groups_sha256 string, pairs array<long>, links array<int>"
    return texts.select("text", KEY, "n_docs").mapInArrow(work, schema)


def count_pairs(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether no pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair"), "n_docs").groupBy("pair").agg(F.sum("n_docs").alias("count"))
    counts = settle(counts.withColumn("a", F.shiftright("pair", 32).cast("int")), "counts")
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # at most a row an entry of A's vocabulary
    return counts.join(F.broadcast(highest), "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def most_usual(counts: DataFrame, table: int) -> DataFrame:
    """At most ``table`` rows of ``counts``: all with a count above a limit, which comes from a histogram of the counts."""
    step = F.floor(F.log2("count") * STEPS).cast("int")
    histogram = sorted(((r.step, r.n) for r in counts.groupBy(step.alias("step")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, 64 * STEPS
    for at, n in histogram:
        if total + n > table:
            break
        total, least = total + n, at
    return counts.filter(step >= least)


def weigh_links(aligned: DataFrame, counts: DataFrame, table: int = TABLE) -> DataFrame:
    """(key, n_docs, measures, groups_sha256, n_best, count_sum) of ``aligned``."""
    spark = aligned.sparkSession
    usual = most_usual(counts, table).toArrow()
    order = np.argsort(usual.column("pair").to_numpy())
    packed = [usual.column(c).to_numpy()[order] for c in ("pair", "count", "best")]
    known = spark.sparkContext.broadcast(packed)
    names = [KEY, "n_docs", *MEASURES, "groups_sha256", "n_best", "count_sum", "rest"]
    kind = pa.struct([("pair", pa.int64()), ("n", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = known.value
        for batch in batches:
            lists, many = batch.column("pairs"), batch.column("links").flatten().to_numpy()
            pairs = lists.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().fill_null(0).to_numpy())
            at = np.minimum(np.searchsorted(pair, pairs), max(0, len(pair) - 1))
            found = pair[at] == pairs if len(pair) else np.zeros(len(pairs), bool)
            weight, top = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
            weight[found] = count[at[found]] * many[found]
            top[found] = best[at[found]] * many[found]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row, top)
            np.add.at(sums[1], row, weight)
            left = ~found
            ends = np.searchsorted(row[left], np.arange(batch.num_rows + 1))
            rest = pa.StructArray.from_arrays([pa.array(pairs[left]), pa.array(many[left])], fields=list(kind))
            columns = [batch.column(c) for c in names[:-3]] + [pa.array(x) for x in sums]
            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "key binary, n_docs long, " + ", ".join(f"{m} long" for m in MEASURES)
    schema += ", groups_sha256 string, n_best long, count_sum long, rest array<struct<pair: long, n: int>>"
    first = settle(aligned.mapInArrow(work, schema), "weighed")
    rest = first.select(KEY, F.explode("rest").alias("x")).select(KEY, "x.pair", "x.n")
    weighed = rest.join(counts.hint("merge"), "pair").groupBy(KEY)
    more = weighed.agg(F.sum(F.col("n") * F.col("best").cast("int")).alias("more_best"), F.sum(F.col("n") * F.col("count")).alias("more_sum"))
    total = lambda x, y: (F.col(x) + F.coalesce(F.col(y), F.lit(0))).alias(x)
    joined = first.join(more.hint("merge"), KEY, "left")
    return joined.select(KEY, "n_docs", *MEASURES, "groups_sha256", total("n_best", "more_best"), total("count_sum", "more_sum"))


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, text: str = "text", table: int = TABLE) -> tuple[DataFrame, DataFrame]:
    """The columns of ``docs`` but its text, with n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many documents as any of its
    A id), count_sum (their pairs' counts summed over the links) and groups_sha256; and the pairs (a, b, count, best).

    The tokenizers are files that every executor has at these paths."""
    texts = docs.select(F.col(text).cast("string").alias("text")).filter("text <> ''").groupBy("text").agg(F.count("*").alias("n_docs"))
    aligned = settle(align_texts(texts.select("text", "n_docs", text_key("text")), a_path, b_path), "aligned")
    counts = settle(count_pairs(aligned), "pairs")
    measures = settle(weigh_links(aligned, counts, table), "measures")
    added = [*MEASURES, "n_best", "count_sum", "groups_sha256"]
    row = F.struct(*[F.col(c) for c in docs.columns if c != text and c not in added], F.lit(1).alias("_"))
    rows = docs.select(row.alias("row"), text_key(F.col(text).cast("string")))
    total = measures.agg(F.sum("n_docs")).first()[0] or 0
    hot = measures.filter(F.col("n_docs") * HEAVY > total).drop("n_docs")  # fewer than HEAVY texts
    cold = measures.filter(F.col("n_docs") * HEAVY <= total).drop("n_docs")
    heavy = rows.join(F.broadcast(hot), KEY)
    others = rows.join(F.broadcast(hot.select(KEY)), KEY, "left_anti").join(cold.hint("merge"), KEY, "left")
    numbers = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in added[:-1]]
    found = heavy.unionByName(others)
    carried = [F.col("row")[c].alias(c) for c in docs.columns if c != text and c not in added]
    pairs = counts.select(F.shiftright("pair", 32).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "count", "best")
    return found.select(*carried, *numbers, F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256")), pairs
