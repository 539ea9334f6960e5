"""Token counts of whole texts, without moving a pre-token.

A pre-token is a run of spaces with what follows up to the next space. Where no piece of the vocabulary
has a space behind another character, no merge crosses the border between two pre-tokens, so a text's
tokens are those of its pre-tokens one after the other, and the lengths add up.

Two tiers, both in the map task: a broadcast table of the corpus's frequent pre-tokens and their
lengths, then a cache in each Python worker, filled by the tokenizer itself. The table only saves
work: the count is the same with any table.

The table is made in one pass over all texts. Each task counts its own pre-tokens and gives out those
with at least a ``1 / SHARE`` part of the task's; that is at most SHARE rows a task, and a pre-token with that
share of the corpus has it in some task. Only these summaries are added up. The table has at most TABLE
entries of at most LONGEST characters, some MB whatever the corpus.

Null counts as empty text, with 0 tokens. Equal rows each get their row. The library handles special strings in
a text as it does by default. A very long text is walked through piece by piece; only a single pre-token is ever encoded whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns

TABLE = 1 << 16
SHARE = 20_000
LONGEST = 48
CACHE = 500_000

SPACE = "▁"  # the vocabulary's sign for a space; the library takes it for one in texts too
# white space at the start of the model's view of a text is one more space
PRE_TOKEN = re.compile(f"[ {SPACE}]+[^ {SPACE}]*")


class PieceCounter:
    """Counts tokens by a sentencepiece model."""

    def __init__(self, model: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.cuts = self._cuts()
        self.lengths: dict[str, int] = {}

    def _cuts(self) -> bool:
        """Whether texts may be cut before runs of spaces: no piece reaches over such a place, and
        text is taken as it is, with one space put before it."""
        pieces = (self.library.id_to_piece(i) for i in range(self.library.get_piece_size()))
        probe = "  a bÉﬁ\n\t c "
        as_it_is = self.library.normalize(probe) == SPACE + probe.replace(" ", SPACE)
        return as_it_is and not any(SPACE in piece.lstrip(SPACE) for piece in pieces)

    def pre_tokens(self, text: str) -> list[str]:
        return PRE_TOKEN.findall(" " + text) if text else []

    def length(self, pre_token: str) -> int:
        # the library puts the first space back
        return len(self.library.encode(pre_token[1:], num_threads=1)) if len(pre_token) > 1 else self._lone

    @property
    def _lone(self) -> int:
        """Tokens of a single space in front of nothing or of another pre-token."""
        return len(self.library.encode("a ", num_threads=1)) - len(self.library.encode("a", num_threads=1))

    def count(self, text: str | None, table: dict[str, int]) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.library.encode(text, num_threads=1))
        total, cache = 0, self.lengths
        for match in self.pre_tokens(text) if len(text) < 1 << 20 else (m[0] for m in PRE_TOKEN.finditer(" " + text)):
            size = table.get(match)
            if size is None:
                size = cache.get(match)
                if size is None:
                    size = self.length(match)
                    if len(match) <= LONGEST:
                        if len(cache) >= CACHE:
                            cache.clear()
                        cache[match] = size
            total += size
        return total


_counters: dict[str, PieceCounter] = {}


def counter(model: str) -> PieceCounter:
    """The worker's counter; it and its cache outlive the task."""
    if model not in _counters:
        _counters[model] = PieceCounter(model)
    return _counters[model]


def frequent_lengths(docs: DataFrame, model: str, text: str = "text", table: int = TABLE, share: int = SHARE) -> dict[str, int]:
    """Lengths of the corpus's most frequent pre-tokens, at most ``table`` of them."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, seen, total, floor = counter(model), Counter(), 0, 0
        for batch in batches:
            for value in batch.column(0):
                found = [] if (value := value.as_py()) is None else library.pre_tokens(value)
                seen.update(found)
                total += len(found)
                if len(seen) > 50 * share:
                    # bounded memory: what is below the share by now can be left to the caches
                    seen = Counter({k: n for k, n in seen.items() if n * share * 2 >= total})
        rows = [(k, n) for k, n in seen.items() if n * share >= total and len(k) <= LONGEST]
        yield pa.RecordBatch.from_pydict({"pre_token": pa.array([k for k, _ in rows], pa.string()), "n": pa.array([n for _, n in rows], pa.int64())})

    if not counter(model).cuts:
        return {}
    counts = docs.select(text).mapInArrow(summary, "pre_token string, n long").groupBy("pre_token").agg(F.sum("n").alias("n"))
    top = counts.orderBy(F.desc("n"), "pre_token").limit(table).select("pre_token").collect()
    return {r.pre_token: counter(model).length(r.pre_token) for r in top}


def count_tokens(docs: DataFrame, model: str, text: str = "text", table: int = TABLE) -> DataFrame:
    """``docs`` with n_tokens, the tokens of the whole text without begin, end or added special tokens.

    ``model`` is a sentencepiece file that every executor has at that path."""
    known = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, model, text, table))

    def work(batch: pa.RecordBatch):
        library, lengths = counter(model), known.value
        return [pa.array([library.count(value.as_py(), lengths) for value in batch.column(text)], type=pa.int64())]

    return add_columns(docs, text, [T.StructField("n_tokens", T.LongType())], work)
