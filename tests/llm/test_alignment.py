"""Aligned tokens against whole texts encoded by the libraries and overlaps tried one by one."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shoptide.llm.alignment import align_tokenizers, byte_of

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(parts):
    at = 0
    for x in parts:
        yield at, at + len(x)
        at += len(x)


def plain(rows):
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    decoded = byte_of()
    b_bytes = lambda i: bytes([int(b_model.id_to_piece(i)[3:-1], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("\u2581", " ").encode()
    found, counts = [], Counter()
    for doc, text in rows:
        links, digest, groups, a, b = [], "", [], [], []
        if text:
            a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
            as_a, as_b = [bytes(decoded[c] for c in a_model.id_to_token(i)) for i in a], [b_bytes(i) for i in b]
            if b"".join(as_a) != (" " + text).encode() or b"".join(as_b) != (" " + text).encode():
                a = b = []
            else:
                a_spans, b_spans = list(spans(as_a)), list(spans(as_b))
                j = 0
                for i, (s, e) in enumerate(a_spans):
                    while b_spans[j][1] <= s:
                        j += 1
                    k = j
                    while k < len(b) and b_spans[k][0] < e:
                        links.append((a[i], b[k]))
                        k += 1
                ends = {e for _, e in a_spans} & {e for _, e in b_spans}
                side = lambda ids, where, lo, hi: ",".join(str(x) for x, (s, e) in zip(ids, where) if lo <= s and e <= hi)
                last = 0
                for e in sorted(ends):
                    groups.append(f"{side(a, a_spans, last, e)}|{side(b, b_spans, last, e)}" if len(ends) < 400 else None)
                    last = e
                if None in groups:
                    groups, i, j = [], 0, 0
                    for e in sorted(ends):
                        up, to = i, j
                        while a_spans[up][1] < e:
                            up += 1
                        while b_spans[to][1] < e:
                            to += 1
                        groups.append(f"{','.join(map(str, a[i:up + 1]))}|{','.join(map(str, b[j:to + 1]))}")
                        i, j = up + 1, to + 1
                digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        counts.update(set(links))
        found.append((doc, len(a), len(b), len(groups), links, digest))
    highest = defaultdict(int)
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc, n_a, n_b, n_groups, links, digest in found:
        best = sum(counts[p] == highest[p[0]] for p in links)
        out.append((doc, n_a, n_b, n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return out, counts


ODD = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "a "), (6, " a"), (7, "   a   b  \n\n  c\t d \r\n"), (8, "x\u2581y z"), (9, "\u2581"),
    (10, "<|endoftext|> and <s> </s> <unk> <0x0A> end"), (11, "\u4e2d\u6587 \u3042 e\u0301 \u00a0 \u2003x \x1c y \x85z"), (12, "\U0001f600\U0001f3fd ok \u200d"),
    (13, "a\x00b c"), (14, "na\u00efve co\u00f6perate 12345 it's we're DON'T ... --- !!!"), (15, "word " * 400), (16, "z" * 3000 + " " + "\u00e9" * 700),
    (17, "the cat sat"), (17, "the cat sat"), (18, "the cat sat"), (17, "the dog"), (None, "the dog"), (19, "\n\n\n"), (20, "tail \n "), (21, "\ufb01 \u210c \u00bd"),
]


@pytest.mark.parametrize("table", [0, 40, 1 << 19])
def test_equals_plain(spark, table):
    rows = ODD + [(100 + k, "the cat sat on the mat " * (1 + k % 3)) for k in range(30)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_a string").repartition(4)
    found, pairs = align_tokenizers(docs, A, B, table=table)
    want, counts = plain(rows)
    assert found.columns == COLUMNS
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert {(r.a, r.b): r["count"] for r in pairs.collect()} == dict(counts)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    found, pairs = align_tokenizers(docs, A, B)
    assert found.columns == COLUMNS and found.collect() == [] and pairs.collect() == []


def test_registered_query(spark, folder, read):
    from shoptide.llm.queries import QUERIES

    rows = [(r.doc_id, r.text) for r in read("documents").collect()]
    got = QUERIES["op13_tokenizer_alignment"](spark, folder).select(*COLUMNS)
    assert sorted(map(tuple, got.collect())) == sorted(plain(rows)[0])
