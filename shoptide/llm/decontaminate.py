"""Benchmark decontamination: n-grams of test items found in training texts.

The windows of the items - n consecutive words, or the whole item if it has fewer - are hashed and
broadcast; every task slides over its documents' words, looks the window hashes up and compares the
words of each find. Nothing is shuffled.

The broadcast has a checked size: the items are taken in blocks of at most BLOCK_CHARS characters. A
benchmark beyond that makes more blocks, and the documents pass through one after the other in the
same tasks, each adding its finds to those before.

Words are runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased. A null or empty text has no
words and is clean. An item without words is in nothing. Repeated items count once per id, an item
without id marks words but is not listed. Equal rows each get their row.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns, per_row
from shoptide.llm.words import Words, words_of

WINDOW = 10
BLOCK_CHARS = 16_000_000
FILTER_BITS = 20

SPAN = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
ARROW_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])


class WindowIndex:
    """Windows of some items by length: sorted hashes, and what each hash stands for."""

    def __init__(self, ids: list, texts: list[str | None], n: int):
        words = words_of(pa.array(texts, type=pa.string()))
        found: dict[int, dict[int, dict[bytes, set]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
        sizes = np.diff(words.first)
        for size in sorted({min(int(s), n) for s in sizes if s}):
            starts, hashes = words.windows(size)
            for start, value in zip(starts.tolist(), hashes.tolist()):
                item = int(words.text[start])
                if min(int(sizes[item]), n) == size:
                    found[size][value][window_text(words, start, size)].add(ids[item])
        self.lengths = {}
        for size, by_hash in found.items():
            hashes = np.array(sorted(by_hash), dtype=np.uint64)
            likely = np.zeros(1 << FILTER_BITS, dtype=bool)
            likely[hashes & np.uint64(len(likely) - 1)] = True
            meanings = [{text: sorted(x for x in of if x is not None) for text, of in by_hash[h].items()} for h in hashes.tolist()]
            self.lengths[size] = (hashes, likely, meanings)

    def hits(self, words: Words) -> tuple[np.ndarray, list[set]]:
        """Which words lie in an occurrence of a window; the ids of the items found, by text."""
        edge = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        items: list[set] = [set() for _ in range(len(words.first) - 1)]
        for size, (known, likely, meanings) in self.lengths.items():
            starts, hashes = words.windows(size)
            maybe = np.flatnonzero(likely[hashes & np.uint64(len(likely) - 1)])
            at = np.searchsorted(known, hashes[maybe])
            same = known[np.minimum(at, len(known) - 1)] == hashes[maybe]
            for start, k in zip(starts[maybe[same]].tolist(), at[same].tolist()):
                of = meanings[k].get(window_text(words, start, size))
                if of is not None:
                    items[words.text[start]].update(of)
                    edge[start] += 1
                    edge[start + size] -= 1
        return np.cumsum(edge[:-1]) > 0, items


def window_text(words: Words, start: int, size: int) -> bytes:
    return b" ".join([words.word(i) for i in range(start, start + size)])


def spans_of(words: Words, hit: np.ndarray) -> list[list[dict]]:
    """Byte ranges of the runs of hit words, by text."""
    spans: list[list[dict]] = [[] for _ in range(len(words.first) - 1)]
    where = np.flatnonzero(hit)
    if len(where):
        fresh = np.concatenate(([True], (np.diff(where) > 1) | (np.diff(words.text[where]) > 0)))
        last = np.concatenate((fresh[1:], [True]))
        for i, j in zip(where[fresh].tolist(), where[last].tolist()):
            text = words.text[i]
            begin = words.begins[text]
            spans[text].append({"begin": int(words.starts[i] - begin), "end": int(words.ends[j] - begin)})
    return spans


def scan_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = WINDOW,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside an occurrence of a window), hit_items (ids of the
    items with occurring windows) and hit_spans (byte ranges of the text)."""
    spark = docs.sparkSession
    kind = benchmark.schema[item].dataType
    items = benchmark.select(F.col(item).alias("id"), F.col(item_text).alias("words"))
    chars = items.agg(F.sum(F.length("words"))).first()[0] or 0
    blocks = -(-chars // block_chars) or 1
    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_items", T.ArrayType(kind)),
        T.StructField("hit_spans", T.ArrayType(SPAN)),
    ]
    id_type = pa.array([], type=_arrow_type(kind)).type

    def step(index, merge: bool):
        def work(batch: pa.RecordBatch):
            words = words_of(batch.column(text))
            hit, found = index.value.hits(words)
            if merge:
                for i, (ids, spans) in enumerate(zip(batch.column("hit_items").to_pylist(), batch.column("hit_spans").to_pylist())):
                    found[i].update(ids)
                    for span in spans:
                        edges = [words.begins[i] + span["begin"], words.begins[i] + span["end"]]
                        begin, end = np.searchsorted(words.starts, edges)
                        hit[begin:end] = True
            return [
                pa.array(np.diff(words.first), type=pa.int64()),
                pa.array(per_row(hit, words.first), type=pa.int64()),
                pa.array([sorted(x) for x in found], type=pa.list_(id_type)),
                pa.array(spans_of(words, hit), type=pa.list_(ARROW_SPAN)),
            ]

        return work

    for block in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("words"), F.lit(blocks)) == block).collect()
        index = spark.sparkContext.broadcast(WindowIndex([r.id for r in mine], [r.words for r in mine], n))
        docs = add_columns(docs, text, added, step(index, block > 0))
    return docs


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def items_digest(items: Column) -> Column:
    """SHA-256 of the ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ","), 256)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", **scan) -> DataFrame:
    """``docs`` without the documents that hold a window, or (``remove="spans"``) without the words that
    lie in one, all else kept. The columns are those of ``docs``."""
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is documents or spans, not {remove}")
    # the row goes along whole, so that no column's name can clash
    scanned = scan_benchmark(docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), benchmark, **scan)
    if remove == "documents":
        return scanned.filter("n_hit = 0").select("row.*")

    def cut(batch: pa.RecordBatch):
        texts = []
        for value, spans in zip(batch.column("text").to_pylist(), batch.column("hit_spans").to_pylist()):
            if spans:
                raw, at, rest = value.encode(), 0, []
                for span in spans:
                    rest.append(raw[at : span["begin"]])
                    at = span["end"]
                value = b"".join([*rest, raw[at:]]).decode()
            texts.append(value)
        return [pa.array(texts, type=pa.string())]

    done = add_columns(scanned, "text", [T.StructField("text", T.StringType())], cut)
    return done.select(*[F.col("text").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
