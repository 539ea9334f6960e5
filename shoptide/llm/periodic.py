"""Runs: stretches of words that repeat with a period, found by their Lyndon roots.

A run is a stretch with smallest period q, of at least ``max(shortest, copies * q)`` words, that no neighbouring word extends with
that period. Each run has a root - one period of it - that is a Lyndon word of one of two orders of the words, one the reverse of the
other, and that is the longest Lyndon word starting at its place. So the places' longest Lyndon words are all the periods to look at:

1. Screen, over a batch of whole texts: each place of a run of this kind is in a stretch of words covered by windows of WINDOW words
   that stand in the text twice. All else is in no run. Equal hashes only ever let a stretch stay.
2. For each stretch, and for both orders, the places are grouped as in the first phase of Baier's suffix sorter: from the
   highest group down, each group's places hang themselves on the nearest place before that is in a lower group, and the
   places they hang on are moved up in their own group, further for more of them. A place's longest Lyndon word is itself and what hangs on it,
   known when its group's turn comes: the Lyndon array falls out of the grouping, without the suffixes ever being sorted.
3. Each root is extended both ways by longest common extensions, by ranks of the windows of 1, 2, 4, ... words, which
   compare words and not hashes. What is long enough is a run; the same run from several roots is one.

Words are what ASCII white space parts, compared as they are. A text is worked through in one task; other than its words, memory
goes with its stretches. Nulls and empty texts have no words and no runs. Equal rows get equal results.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from shoptide.llm.arrow import add_columns, lists
from shoptide.llm.words import UNSPACED, WORDS, buffers

SHORTEST = 24
COPIES = 3
WINDOW = 8


def numbered_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all words one after the other, where each word begins in them (and their end), the words' numbers - equal
    for equal words - and the first word of each text (and their end)."""
    at, raw = buffers(texts)
    inside = UNSPACED[raw]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    begins = at[:-1][at[:-1] < at[1:]]
    edge[begins] = inside[begins]
    starts = np.flatnonzero(edge)
    data = raw[inside]
    before = np.cumsum(inside, dtype=np.int64) - inside
    offsets = np.append(before[starts], len(data))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    return data, offsets, numbers, np.searchsorted(starts, at)


def stretches(numbers: np.ndarray, text: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Maximal stretches of words covered by windows that stand in their text twice or more."""
    if len(numbers) < window:
        return []
    at = np.flatnonzero(text[: len(text) - window + 1] == text[window - 1 :])
    values = (numbers + 1).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    key = WORDS[0].spans(values, at, at + window) ^ (text[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    order = np.argsort(key, kind="stable")
    twin = key[order][1:] == key[order][:-1]
    again = np.zeros(len(at), bool)
    again[order[1:][twin]] = True
    again[order[:-1][twin]] = True
    again = at[again]
    if not len(again):
        return []
    new = np.concatenate(([True], (again[1:] > again[:-1] + window) | (text[again[1:]] != text[again[:-1]])))
    first = np.flatnonzero(new)
    last = np.append(first[1:] - 1, len(again) - 1)
    return list(zip(again[first].tolist(), (again[last] + window).tolist()))


def lyndon_lengths(letters: list[int]) -> list[int]:
    """The length of the longest Lyndon word starting at each place, by Baier's grouping. ``letters`` are 0, 1, ... without gaps.

    ``order`` holds the places group by group, lowest group first, and ``group`` each place's group, by where that begins in ``order``. Groups
    at and above the one whose turn it is are never touched again."""
    n = len(letters)
    counts = [0] * (max(letters, default=-1) + 1)
    for x in letters:
        counts[x] += 1
    begin, at = [0] * len(counts), 0
    for x, k in enumerate(counts):
        begin[x], at = at, at + k
    group = [begin[x] for x in letters]
    size = [0] * n
    for x, k in enumerate(counts):
        if k:
            size[begin[x]] = k
    order, where, fill = [0] * n, [0] * n, begin[:]
    for i, x in enumerate(letters):
        where[i] = fill[x]
        order[fill[x]] = i
        fill[x] += 1
    before = [-1] * n  # the nearest place before that is in a lower group; known from the group's turn on
    length = [1] * n
    end = n
    while end > 0:
        turn = group[order[end - 1]]
        members = sorted(order[turn:end])
        end = turn
        hung: dict[int, int] = {}
        for i in members:
            j = i - 1
            # what is higher has had its turn, and what is of the group and earlier has it now
            while j >= 0 and group[j] >= turn:
                j = before[j]
            before[i] = j
            if j >= 0:
                length[j] += length[i]
                hung[j] = hung.get(j, 0) + 1
        if not hung:
            continue
        # those with more hung on them go higher in their group; those with none stay lowest
        for many in _by_count(hung):
            split: dict[int, int] = {}
            for j in many:
                g = group[j]
                # j changes places with the last of its group that has not moved in this pass
                moved = split.get(g, 0)
                last = g + size[g] - 1 - moved
                other, old = order[last], where[j]
                order[old], where[other] = other, old
                order[last], where[j] = j, last
                split[g] = moved + 1
            for g, moved in split.items():
                if moved < size[g]:
                    up = g + size[g] - moved
                    size[g] -= moved
                    size[up] = moved
                    for k in range(up, up + moved):
                        group[order[k]] = up
    return length


def _by_count(hung: dict[int, int]) -> list[list[int]]:
    """The places by how many hang on them, the most first: each pass leaves the places of fewer in what is left of the group."""
    by: dict[int, list[int]] = {}
    for j, k in hung.items():
        by.setdefault(k, []).append(j)
    return [by[k] for k in sorted(by, reverse=True)]


class Extensions:
    """Longest common extensions in a sequence, by ranks of its windows of 1, 2, 4, ... letters."""

    def __init__(self, letters: np.ndarray):
        self.n = len(letters)
        self.ranks = [letters]
        while 2 << (len(self.ranks) - 1) <= self.n:
            half, last = 1 << (len(self.ranks) - 1), self.ranks[-1]
            pairs = last[: len(last) - half] * (int(last.max()) + 1) + last[half:]
            ranks = np.unique(pairs, return_inverse=True)[1]
            self.ranks.append(ranks.astype(np.int64))
            if int(ranks.max()) + 1 == len(ranks):
                break  # all windows differ, as do all longer ones

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the letters from a on equal those from b on, a < b."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, step = self.ranks[k], 1 << k
            while True:  # only the widest window may fit twice
                able = np.flatnonzero(b + total + step <= self.n)
                able = able[ranks[(a + total)[able]] == ranks[(b + total)[able]]]
                if not len(able):
                    break
                total[able] += step
                if k < len(self.ranks) - 1:
                    break
        return total

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the letters before a equal those before b, a < b."""
        total = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ranks, step = self.ranks[k], 1 << k
            while True:
                able = np.flatnonzero(a - total - step >= 0)
                able = able[ranks[(a - total)[able] - step] == ranks[(b - total)[able] - step]]
                if not len(able):
                    break
                total[able] += step
                if k < len(self.ranks) - 1:
                    break
        return total


def runs_of(numbers: np.ndarray, shortest: int = SHORTEST, copies: int = COPIES) -> list[tuple[int, int, int]]:
    """(start, period, length) of the runs of a sequence, by start, then period."""
    letters = np.unique(numbers, return_inverse=True)[1].astype(np.int64)
    n = len(letters)
    if n < shortest:
        return []
    extensions, found = Extensions(letters), set()
    for ordered in (letters, letters.max() - letters):
        period = np.array(lyndon_lengths(ordered.tolist()), np.int64)
        at = np.flatnonzero(period * copies <= n)
        p = period[at]
        right, left = extensions.right(at, at + p), extensions.left(at, at + p)
        size = left + right + p
        long = size >= np.maximum(shortest, copies * p)
        found.update(zip((at - left)[long].tolist(), p[long].tolist(), size[long].tolist()))
    return sorted(found)


RUN = T.StructType([T.StructField(x, T.LongType()) for x in ("start", "length", "period")])


def find_runs(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, copies: int = COPIES) -> DataFrame:
    """``copies`` is 2 or more. ``docs`` with runs (start, length, period, by start and period, words counted from 0), strongest (the run with the
    greatest length / period, ties to the smaller start and then the smaller period; null without runs) and collapsed: the text's words joined by one
    space, without those that are in a run after its first period. Columns that have these names are replaced."""
    # all but its last period of a run comes again a period later
    window = max(1, min(WINDOW, shortest - shortest // copies))
    added = [T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN), T.StructField("collapsed", T.StringType())]
    kind = pa.struct([(x, pa.int64()) for x in ("start", "length", "period")])

    def work(batch: pa.RecordBatch):
        data, offsets, numbers, first = numbered_words(batch.column(text))
        of = np.repeat(np.arange(batch.num_rows), np.diff(first))
        found: dict[int, list[tuple[int, int, int]]] = {}
        keep = np.ones(len(numbers), bool)
        for begin, end in stretches(numbers, of, window):
            for start, period, length in runs_of(numbers[begin:end], shortest, copies):
                row = int(of[begin])
                found.setdefault(row, []).append((begin + start - int(first[row]), period, length))
                keep[begin + start + period : begin + start + length] = False
        runs, best = [], []
        for row in range(batch.num_rows):
            mine = [{"start": s, "length": k, "period": p} for s, p, k in sorted(found.get(row, []))]
            runs.append(mine)
            best.append(min(mine, key=lambda r: (-Fraction(r["length"], r["period"]), r["start"], r["period"]), default=None))
        return [lists(runs, kind), pa.array(best, kind), joined(data, offsets, first, keep)]

    return add_columns(docs, text, added, work)


def joined(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, keep: np.ndarray) -> pa.Array:
    """The kept words of each text with one space between them."""
    sizes = np.diff(offsets)
    kept = np.flatnonzero(keep)
    # each kept word is followed by a space, but for a text's last
    counts = np.searchsorted(kept, first)
    last = np.zeros(len(kept), bool)
    ends = counts[1:][counts[1:] > counts[:-1]] - 1
    last[ends] = True
    room = sizes[kept] + ~last
    begins = np.concatenate(([0], np.cumsum(room)))
    out = np.full(int(begins[-1]), 0x20, np.uint8)
    shift = np.repeat(begins[:-1] - offsets[:-1][kept], sizes[kept])
    source = np.flatnonzero(np.repeat(keep, sizes))
    out[source + shift] = data[source]
    texts = pa.Array.from_buffers(pa.large_string(), len(first) - 1, [None, pa.py_buffer(begins[counts]), pa.py_buffer(out)])
    return texts.cast(pa.string())
