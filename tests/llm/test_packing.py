"""Packing against the library's ids, a plain round-robin and the rules of sequences."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from shoptide.llm.packing import FRACTION, BytePairs, RoundRobin, pack, same_merges
from shoptide.llm.queries import QUERIES, tokenizer_path

MODEL = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    model = Tokenizer.from_file(MODEL)
    return lambda text: [*model.encode(text or "", add_special_tokens=False).ids, 1]


def whole(rows, length):
    """Checks the pieces and gives the ids of each document."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, bytes(r.ids)))
        assert r.length > 0 and len(r.ids) == 4 * r.length
    assert sorted(sequences) == list(range(len(sequences)))
    for k, pieces in sequences.items():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at == length or (k == len(sequences) - 1 and 0 < at < length)
    return {k: np.frombuffer(b"".join(x for _, x in sorted(v)), "<u4").tolist() for k, v in docs.items()}


def test_query_equals_library(spark, folder, read, library):
    found = QUERIES["op4_packing"](spark, folder).collect()
    texts = {r.doc_id: library(r.text) for r in read("documents").collect()}
    ends = defaultdict(int)
    for r in sorted(found, key=lambda r: (r.doc_id, r.start)):
        ids = texts[r.doc_id][r.start : r.start + r.length]
        assert (ends[r.doc_id], r.doc_tokens, len(ids)) == (r.start, len(texts[r.doc_id]), r.length)
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
        ends[r.doc_id] += r.length
    assert ends == {k: len(v) for k, v in texts.items()}


TEXTS = [None, "", "one two", "x²  y\x1c z", "a <|endoftext|> b", "日本語", "it's  fine\n\n", " lots of words" * 4000, "one two"]


@pytest.mark.parametrize("max_queues", [1024, 2])
def test_edges(spark, library, max_queues):
    rows = [(i, t, None if i % 3 == 0 else f"s{i % 3}", "x") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, start string")
    found = pack(docs, MODEL, length=64, max_queues=max_queues).collect()
    assert whole(found, 64) == {i: library(t) for i, t in enumerate(TEXTS)}


def test_repeated_and_null_ids(spark, library):
    docs = spark.createDataFrame([(None, "same text", "a")] * 3, "doc_id long, text string, source string")
    rows = pack(docs, MODEL, length=4).collect()
    assert sum(r.length for r in rows) == 3 * len(library("same text"))


def test_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string, source string"), MODEL).count() == 0


@pytest.mark.parametrize("targets", [None, {"a": 0.5, "b": 0.25, "c": 0.25}])
def test_equals_plain_round_robin(targets):
    sizes = {"a": 5000, "b": 20_011, "c": 37, "d": 3}
    robin = RoundRobin(sizes, targets, length=256, unit=8)
    queues, gained, stream, rounds = [list(range(sizes[x])) for x in robin.names], [0] * 4, [], 0
    while any(queues):
        rounds += 1
        for q, queue in enumerate(queues):
            gained[q] += int(robin.gain[q])
            take = gained[q] >> FRACTION
            take -= take % 8
            gained[q] -= take << FRACTION
            stream += [(q, x) for x in queue[:take]]
            del queue[:take]
    place = {x: i for i, x in enumerate(stream)}
    rng = np.random.default_rng(1)
    for q, name in enumerate(robin.names):
        cuts = np.unique(np.concatenate(([0, sizes[name]], rng.integers(0, sizes[name] + 1, 20))))
        n = np.diff(cuts)
        doc, start, size, at = robin.place(np.full(len(n), q), cuts[:-1], n)
        for d, s, k, p in zip(doc, start, size, at):
            assert [place[q, cuts[d] + s + i] for i in range(k)] == list(range(p, p + k))
            assert p // 256 == (p + k - 1) // 256
        assert size.sum() == sizes[name]


def test_windows_hold_the_target_shares():
    sizes = {"a": 100_000, "b": 200_000, "c": 50_000}
    robin = RoundRobin(sizes)
    held = np.zeros((3, 350_000 // 2048))
    for q, name in enumerate(robin.names):
        _, _, size, at = robin.place(np.array([q]), np.array([0]), np.array([sizes[name]]))
        for k, p in zip(size, at):
            if p // 2048 < held.shape[1]:
                held[q, p // 2048] += k
    assert np.abs(held / 2048 - np.array([[2 / 7], [4 / 7], [1 / 7]])).max() < 0.03


def test_many_sources_keep_names_and_targets(spark, library):
    rows = [(i, f"text number {i} of some words", f"s{i % 3000}") for i in range(3000)] + [(5000 + i, "large " * 30, "large") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    found = pack(docs, MODEL, targets={"s7": 0.5}, length=512, max_queues=100).collect()
    assert whole(found, 512) == {i: library(t) for i, t, _ in rows}
    names = {i: s for i, _, s in rows}
    assert all(r.source == names[r.doc_id] for r in found)
    # the one with a target has a queue of its own and is all sent at the start
    assert {r.sequence_id for r in found if r.source == "s7"} == {0}


def test_places_with_thousands_of_queues_in_bounded_memory():
    import tracemalloc

    robin = RoundRobin({f"q{i:04}": 1000 + i for i in range(5000)})
    queue = np.arange(5000).repeat(4)
    begin = np.tile(np.arange(4) * 250, 5000)
    tracemalloc.start()
    doc, start, size, at = robin.place(queue, begin, np.full(20_000, 250))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    order = np.argsort(at)
    assert (at[order][1:] >= (at + size)[order][:-1]).all() and size.sum() == 20_000 * 250


def test_ranks_are_used_only_where_they_give_the_listed_merges():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"bc": 257, b"abc": 258}
    listed = lambda *m: [tuple(x.split(b" ")) for x in m]
    assert same_merges(listed(b"a b", b"b c", b"ab c"), ranks)
    # "ab" comes first, so "a" and "bc" never meet, but the ranks would put "ab" and "c" together
    assert not same_merges(listed(b"a b", b"b c", b"a bc"), ranks)
    assert not same_merges(listed(b"b c", b"a b", b"a bc"), ranks)


def test_ranks_equal_library(library):
    rng = np.random.default_rng(4)
    letters = list("abcdefghij étöñ  \n\t.,!?'0123456789_-ABC²½\u00a0\u0085ß€") + [" the", "ing", "'ll", "'S", "<|endoftext|>", "\x1c"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 80))) for _ in range(3000)]
    pairs = BytePairs(MODEL)
    assert pairs.ranked is not None
    for text, ids in zip(texts, pairs.ids(texts)):
        assert [*np.frombuffer(ids, pairs.dtype).tolist(), 1] == library(text), text
