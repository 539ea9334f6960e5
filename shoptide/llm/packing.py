"""Mixture-controlled packing of documents into sequences of fixed length.

Each source has a queue of its documents' tokens. A deficit round-robin goes over the queues: in every
round a queue gains its target share of the round's tokens, sends what it has gained in units of
``UNIT`` tokens, and carries the rest into the next round. The windows are cut from the stream that this
sends, so each is full, holds the target proportions to a unit or two a source, and only the last
one of all can be short. A queue that has run dry sends nothing, and the windows go on with the others.

After r rounds a queue has sent ``min(its tokens, r * quantum`` in whole units ``)``. With this closed form
no task has to replay the rounds: it needs its documents' places in their queues, which are prefix sums, and the
queues' lengths. So deficits carry over windows and partitions alike, and every piece is placed on its own.

1. Each map task tokenizes its documents, noting the tokens of the same queue before each in the task.
   The ids are settled, two bytes each where the vocabulary allows it.
2. Token sums per task and queue, two levels of prefix sums over them: where each task's share of each queue begins.
   Ranges of BLOCK tasks bound the rows that any window function sees together.
3. The ids are read again and cut into pieces. Spark broadcasts the begins where they are few and joins by shuffle else.

A source with at least a MAX_QUEUES-th of all documents, or with a target, has a queue of its own; the others share SHARED queues by
hash. So there are at most MAX_QUEUES + SHARED queues and one a target, whatever the number of sources. Pieces carry their true source.

A null or empty text is a document of the end id alone. A null source is the source "". Equal rows are packed each.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.alignment import byte_of
from shoptide.llm.shared import settle
from shoptide.llm.words import small_batches

LENGTH = 2048
UNIT = 16
MAX_QUEUES = 1024
SHARED = 64
OWN = "="  # begins the name of a source's own queue
BLOCK = 1024
STEPS = 200_000  # units placed at a time
CELLS = 1 << 20
FRACTION = 16  # bits behind the point of a quantum

# The split of byte-level BPE, and the characters on whose class versions of Unicode, or libraries, may differ
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ODD = re.compile("[\x1c-\x1f]|[^\x00-\u024f]")


def native(ids: array) -> bytes:
    """Little-endian bytes."""
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def same_merges(merges: list[tuple[bytes, bytes]], ranks: dict[bytes, int]) -> bool:
    """Whether merging by rank, of any two neighbours that make an entry, gives what the listed merges give. So it is if ids rise with the merges,
    and each entry is left, by the merges before it, in just the two parts that its own merge puts together."""
    last = -1
    for left, right in merges:
        limit = ranks[left + right]
        if limit <= last:
            return False
        last, parts = limit, [bytes([x]) for x in left + right]
        while len(parts) > 2:
            found = min((ranks.get(x + y, limit), i) for i, (x, y) in enumerate(zip(parts, parts[1:])))
            if found[0] >= limit:
                return False
            parts[found[1] : found[1] + 2] = [parts[found[1]] + parts[found[1] + 1]]
        if parts != [left, right]:
            return False
    return True


class BytePairs:
    """Ids of a tokenizers file as bytes. Texts go through the same vocabulary as ranks, which is faster, where that is sure to give the same ids."""

    def __init__(self, path: str, proven: bool | None = None):
        # Spark's tasks use the cores; threads of the library would only get in each other's way
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        described = json.loads(self.library.to_str())
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        special = [x["content"] for x in described["added_tokens"]]
        self.whole = re.compile("|".join([ODD.pattern, *map(re.escape, special)]))
        self.ranked = None
        splitter, model = described["pre_tokenizer"] or {}, described["model"]
        plain = not described["normalizer"] and splitter.get("type") == "ByteLevel" and not splitter["add_prefix_space"] and splitter["use_regex"]
        plain = plain and model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if plain:
            import tiktoken

            byte = byte_of()
            decoded = lambda x: bytes(byte[c] for c in x)
            ranks = {decoded(x): i for x, i in model["vocab"].items() if x not in special}
            merges = [tuple(map(decoded, x if isinstance(x, list) else x.split(" "))) for x in model["merges"]]
            self.proven = same_merges(merges, ranks) if proven is None else proven
            if self.proven:
                self.ranked = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        else:
            self.proven = False

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        out = []
        for text in texts:
            if not text:
                ids = []
            elif self.ranked is None or self.whole.search(text):
                ids = self.library.encode(text, add_special_tokens=False).ids
            else:
                ids = self.ranked.encode_ordinary(text)
            out.append(native(array(self.kind, ids)))
        return out


_tokenizers: dict[str, BytePairs] = {}


def tokenizer(path: str, proven: bool | None = None) -> BytePairs:
    """The worker's tokenizer, which outlives the task. The driver tells whether the merges have been found to be the same."""
    if path not in _tokenizers:
        _tokenizers[path] = BytePairs(path, proven)
    return _tokenizers[path]


def large_sources(rows: DataFrame, max_queues: int) -> list[str]:
    """The sources with at least a ``max_queues``-th of all rows, so at most that many."""
    counts = settle(rows.groupBy("source").agg(F.count("*").alias("n")), "sources")
    total = counts.agg(F.sum("n")).first()[0] or 0
    return [r["source"] for r in counts.filter(F.col("n") * max_queues >= total).select("source").collect()]


def tokenize(rows: DataFrame, model: str, end: int) -> DataFrame:
    """(doc, source, queue, part, before, n, ids) of (doc, source, queue, text): a document's ids with the end id, the map task, and the tokens of
    the same queue that come before it in the task."""
    schema = T.StructType([rows.schema["doc"], T.StructField("source", T.StringType()), T.StructField("queue", T.StringType())])
    for name, field in (("part", T.LongType()), ("before", T.LongType()), ("n", T.LongType()), ("ids", T.BinaryType())):
        schema.add(name, field)

    proven = tokenizer(model).proven

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, sums, part = tokenizer(model, proven), {}, TaskContext.get().partitionId()
        last = np.array([end], dtype=pairs.dtype).tobytes()
        for batch in batches:
            for some in small_batches(batch, "text"):
                ids = [x + last for x in pairs.ids(some.column("text").to_pylist())]
                sizes, before = [len(x) // pairs.dtype.itemsize for x in ids], []
                for name, n in zip(some.column("queue").to_pylist(), sizes):
                    before.append(sums.get(name, 0))
                    sums[name] = before[-1] + n
                made = [pa.array(np.full(len(ids), part), pa.int64()), pa.array(before, pa.int64()), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays([some.column("doc"), some.column("source"), some.column("queue"), *made], schema.names)

    return rows.select("doc", "source", "queue", "text").mapInArrow(work, schema)


def queue_begins(tokens: DataFrame) -> DataFrame:
    """(part, queue, begin): where the part's tokens begin in the queue."""
    sums = tokens.groupBy("part", "queue").agg(F.sum("n").alias("n")).withColumn("block", F.expr(f"part div {BLOCK}"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sums.groupBy("queue", "block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("queue", "block", before(Window.partitionBy("queue").orderBy("block")).alias("first"))
    inside = sums.select("part", "queue", "block", before(Window.partitionBy("queue", "block").orderBy("part")).alias("inside"))
    return inside.join(blocks, ["queue", "block"]).select("part", "queue", (F.col("first") + F.col("inside")).alias("begin"))


class RoundRobin:
    """The closed form of the rounds over queues of known lengths."""

    def __init__(self, lengths: Mapping[str, int], targets: Mapping[str, float] | None = None, length: int = LENGTH, unit: int = UNIT):
        """targets: shares of the windows by queue; a queue without one has its share of all tokens."""
        self.names = sorted(lengths)
        self.sizes = np.array([lengths[x] for x in self.names], dtype=np.int64)
        shares = self.sizes / max(1, self.sizes.sum())
        if targets:
            shares = np.array([targets.get(x, shares[i]) for i, x in enumerate(self.names)], dtype=float)
        self.length, self.unit = length, unit
        quantum = max(length, unit * len(self.names))  # of a whole round
        self.gain = np.maximum(1, np.rint(shares / max(shares.sum(), 1e-300) * quantum * (1 << FRACTION))).astype(np.int64)

    def sent(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens of each queue sent in so many rounds."""
        gained = (rounds[:, None] * self.gain) >> FRACTION
        return np.minimum(self.sizes, gained // self.unit * self.unit)

    def at_turns(self, turn: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each (turn, queue) what the queue has sent before the turn and after it, and what all have sent before the queue's share of
        the turn. Worked through some turns at a time, so that no more than CELLS numbers of turns times queues are held."""
        past, now, before = (np.empty(len(turn), np.int64) for _ in range(3))
        turns, row = np.unique(turn, return_inverse=True)
        order = np.argsort(row, kind="stable")
        step = max(1, CELLS // max(1, len(self.names)))
        for begin in range(0, len(turns), step):
            some = turns[begin : begin + step]
            a, b = np.searchsorted(row[order], (begin, begin + len(some)))
            mine = order[a:b]
            at, of = row[mine] - begin, q[mine]
            old, new = self.sent(some - 1), self.sent(some)
            past[mine], now[mine] = old[at, of], new[at, of]
            new -= old
            earlier = np.cumsum(new, axis=1) - new
            before[mine] = old.sum(1)[at] + earlier[at, of]
        return past, now, before

    def place(self, queue: np.ndarray, begin: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of documents that stand in their queues at begin:begin + n, n at least 1. Per piece: the
        document's number, the tokens before it, its length, and its place in the stream."""
        # each unit's round, then runs of a document's units in the same round
        first, last = begin // self.unit, (begin + n - 1) // self.unit
        count = last - first + 1
        doc = np.repeat(np.arange(len(n)), count)
        unit = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + first[doc]
        turn = -(-(((unit + 1) * self.unit) << FRACTION) // self.gain[queue[doc]])
        new = np.concatenate(([True], (np.diff(doc) > 0) | (np.diff(turn) > 0)))
        doc, turn = doc[new], turn[new]
        q = queue[doc]
        past, now, before = self.at_turns(turn, q)
        lo = np.maximum(past, begin[doc])
        hi = np.minimum(now, begin[doc] + n[doc])
        stream = before + lo - past
        start, size = lo - begin[doc], hi - lo
        # cut at the windows' ends
        windows = (stream + size - 1) // self.length - stream // self.length + 1
        piece = np.repeat(np.arange(len(doc)), windows)
        window = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows) + (stream // self.length)[piece]
        lo = np.maximum(stream[piece], window * self.length)
        hi = np.minimum(stream[piece] + size[piece], (window + 1) * self.length)
        doc, start = doc[piece], start[piece] + lo - stream[piece]
        # what follows on in the same window is one piece
        new = np.concatenate(([True], (np.diff(doc) > 0) | (np.diff(window) > 0) | (lo[1:] != hi[:-1])))
        at = np.flatnonzero(new)
        return doc[at], start[at], np.add.reduceat(hi - lo, at), lo[at]


def pack(
    docs: DataFrame,
    model: str,
    end: int = 1,
    length: int = LENGTH,
    targets: Mapping[str, float] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    max_queues: int = MAX_QUEUES,
) -> DataFrame:
    """Pieces of the documents: (doc id, source, start, length, ids, doc_tokens, sequence_id, offset), ids as
    little-endian unsigned 32-bit numbers. Sequences have ``length`` tokens, but for the last."""
    name = F.coalesce(F.col(source).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text"), name.alias("source"))
    own = sorted({*large_sources(rows, max_queues), *(targets or {})})
    queue = F.when(F.col("source").isin(own), F.concat(F.lit(OWN), "source")).otherwise(F.pmod(F.xxhash64("source"), F.lit(SHARED)).cast("string"))
    targets = {OWN + x: share for x, share in (targets or {}).items()}
    tokens = settle(tokenize(rows.withColumn("queue", queue), model, end), "tokens")
    begins = settle(queue_begins(tokens), "begins")
    lengths = {r.queue: r.n for r in tokens.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    robin = RoundRobin(lengths, targets, length)
    number = {x: i for i, x in enumerate(robin.names)}
    dtype = tokenizer(model).dtype
    placed = tokens.join(begins, ["part", "queue"]).select("doc", "source", "queue", (F.col("begin") + F.col("before")).alias("begin"), "n", "ids")
    schema = T.StructType([T.StructField(doc_id, docs.schema[doc_id].dataType), T.StructField("source", T.StringType())])
    for name, kind in (("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()), ("offset", T.LongType())):
        schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = np.cumsum(batch.column("n").to_numpy() // UNIT + 2)
            begin = 0
            while begin < batch.num_rows:
                past = units[begin - 1] if begin else 0
                stop = max(begin + 1, int(np.searchsorted(units, past + STEPS, side="right")))
                some = batch.slice(begin, stop - begin)
                begin = stop
                queue = np.array([number[x] for x in some.column("queue").to_pylist()])
                n = some.column("n").to_numpy()
                doc, start, size, stream = robin.place(queue, some.column("begin").to_numpy(), n)
                ids = [np.frombuffer(x.as_buffer(), dtype=dtype).astype("<u4") for x in some.column("ids")]
                pieces = [ids[d][s : s + k].tobytes() for d, s, k in zip(doc.tolist(), start.tolist(), size.tolist())]
                at = pa.array(doc)
                columns = [some.column("doc").take(at), some.column("source").take(at)]
                columns += [pa.array(start), pa.array(size), pa.array(pieces, pa.binary())]
                columns += [pa.array(n[doc]), pa.array(stream // length), pa.array(stream % length)]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return placed.mapInArrow(cut, schema)
