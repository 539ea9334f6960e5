"""Words of whole texts, found and hashed a few megabytes at a time.

The separators of every word rule used here are ASCII characters, so words can be cut on the UTF-8
bytes. A word's hash is polynomial in its bytes and a window's hash is polynomial in its words, both
modulo 2**64, so a prefix sum gives the hash of any word or window by one subtraction. Hashes only
propose; what must be exact is compared on the words themselves or on two independent hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 19
BATCH_BYTES = 1 << 20
U64 = np.uint64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# letters and digits of ASCII and every other character; to be used on lower-cased bytes
ALPHANUMERIC = np.ones(256, dtype=bool)
ALPHANUMERIC[0x00:0x30] = ALPHANUMERIC[0x3A:0x61] = ALPHANUMERIC[0x7B:0x80] = False

# all that ASCII white space parts
UNSPACED = np.ones(256, dtype=bool)
UNSPACED[0x20] = UNSPACED[0x09:0x0E] = False


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as far as asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                row = np.full(size, base, dtype=U64)
                row[0] = 1
                setattr(self, name, np.cumprod(row, dtype=U64))
        return self.up[:n], self.down[:n]

    def raw(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The polynomial of values[start:end] for each pair. That of two spans one after the other is that of
        the first plus that of the second times the base to the length of the first."""
        up, down = self.upto(len(values) + 1)
        total = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * up[:-1], out=total[1:])
        return (total[ends] - total[starts]) * down[starts]

    def spans(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair, the same wherever the span stands."""
        return mixed(self.raw(values, starts, ends))


BYTES = Powers(0x9E3779B97F4A7C15)
# two lanes, for what needs more than 64 bits
WORDS = (Powers(0xD1342543DE82EF95), Powers(0xAF251AF3B0F025B5))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that leaves no visible structure."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """The words of some texts. ``first[i]:first[i + 1]`` are the words of text i."""

    data: np.ndarray  # bytes, lower-cased, a separator after each text
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    text: np.ndarray  # the text each word is of
    first: np.ndarray
    begins: np.ndarray  # where each text begins in data

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def windows(self, n: int, lane: int = 0, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of n words in one text (or one unit of ``within``, by word)."""
        unit = self.text if within is None else within
        if len(unit) < n:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=U64)
        at = np.flatnonzero(unit[: len(unit) - n + 1] == unit[n - 1 :])
        return at, WORDS[lane].spans(self.hashes, at, at + n)


def find_words(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in data, which ends with a separator. Works through
    chunks cut at separators, so that the memory besides the words' own is bounded by a chunk or a word."""
    starts, ends, hashes, at = [], [], [], 0
    while at < len(data):
        stop = min(at + CHUNK, len(data))
        while kinds[data[stop - 1]]:  # on to the end of the word
            more = np.flatnonzero(~kinds[data[stop : stop + 4096]])
            stop = stop + int(more[0]) + 1 if len(more) else min(stop + 4096, len(data))
        chunk = data[at:stop]
        edge = np.diff(np.concatenate(([0], kinds[chunk].view(np.int8))))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        starts.append(s + at)
        ends.append(e + at)
        hashes.append(BYTES.spans(chunk.astype(U64) + U64(1), s, e))
        at = stop
    if not starts:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, U64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def prefix_hashes(words: Words, chars: int) -> tuple[np.ndarray, np.ndarray]:
    """The words that have at least so many characters, and the hashes of their first ones."""
    begins_char = (words.data & 0xC0) != 0x80
    places = np.append(np.flatnonzero(begins_char), len(words.data))
    nth = np.searchsorted(places, words.starts)
    stops = places[np.minimum(nth + chars, len(places) - 1)]
    long = np.flatnonzero(stops <= words.ends)
    out = np.empty(len(long), dtype=U64)
    at = 0
    while at < len(long):
        base = words.starts[long[at]]
        end = max(at + 1, int(np.searchsorted(words.starts[long], base + CHUNK)))
        some = long[at:end]
        data = words.data[base : stops[some[-1]]].astype(U64) + U64(1)
        out[at:end] = BYTES.spans(data, words.starts[some] - base, stops[some] - base)
        at = end
    return long, mixed(out + U64(chars))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string array; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(1, np.int64), np.empty(0, np.uint8)
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return at - at[0], raw[at[0] : at[-1]]


def words_of(texts: pa.Array, kinds: np.ndarray = ALPHANUMERIC) -> Words:
    """The words of each text of a string array."""
    at, raw = buffers(texts)
    n = len(at) - 1
    # a separator behind each text, so that no word reaches over
    begins = at + np.arange(n + 1)
    data = np.zeros(len(raw) + n, dtype=np.uint8)
    keep = np.ones(len(data), dtype=bool)
    keep[begins[1:] - 1] = False
    data[keep] = LOWER[raw]
    data[begins[1:] - 1] = 0x20
    starts, ends, hashes = find_words(data, kinds)
    first = np.searchsorted(starts, begins)
    text = np.repeat(np.arange(n), np.diff(first))
    return Words(data, starts, ends, hashes, text, first, begins)


def small_batches(batch: pa.RecordBatch, column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes in the column, or one row that has more."""
    at, _ = buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + most, side="right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop
