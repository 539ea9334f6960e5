"""Token counts against the library on whole texts."""

import pytest
import sentencepiece

from shoptide.llm.queries import QUERIES, tokenizer_path
from shoptide.llm.tokens import count_tokens

MODEL = tokenizer_path("piece_bpe_32k.model")
TEXTS = [None, "", " ", "a", "a  b ", "\n\n x\t", "▁a ▁▁ b", "<s> </s> <0x0A>", "日本語 テキスト 😀", "é" * 3000, "  " * 400 + "x", "w " * 40_000, "w " * 3]


@pytest.fixture(scope="module")
def library():
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    return lambda text: len(model.encode(text or ""))


def test_query_equals_library(spark, folder, read, library):
    found = sorted(tuple(r) for r in QUERIES["op6_token_counts"](spark, folder).collect())
    wanted = [(r.doc_id, len(r.text.encode()), library(r.text)) for r in read("documents").collect()]
    assert found == sorted((*x, x[2] > 4096) for x in wanted)


@pytest.mark.parametrize("table", [0, 5, 100_000])
def test_edges(spark, library, table):
    docs = spark.createDataFrame([(None, t, 7) for t in [*TEXTS, "a  b "]], "id long, text string, n_tokens int")
    rows = count_tokens(docs, MODEL, table=table).collect()
    assert sorted((str(r.text), r.n_tokens) for r in rows) == sorted((str(t), library(t)) for t in [*TEXTS, "a  b "])


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "text string"), MODEL).count() == 0
