"""Every stage against a plain version on its own input; the chain against the stages."""

import pytest
import test_decontaminate
import test_linededup
import test_nearcopies

import corpus_pipeline
from shoptide.llm.packing import tokenizer
from shoptide.llm.queries import tokenizer_path
from shoptide.llm.shared import settle


@pytest.fixture(scope="module")
def steps(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        result = settle(stage(spark, docs, folder), "stage")
        out.append((name, docs, result))
        docs = result
    return out


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages_are_in_order_and_keep_the_columns(steps):
    assert [name for name, _, _ in steps] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    for _, before, after in steps[:-1]:
        assert after.dtypes == before.dtypes


def test_toxic_documents_go(steps, read):
    _, before, after = steps[0]
    toxic = {r.doc_id for r in read("labels").collect() if r.toxic}
    left = texts(after)
    assert left.items() <= texts(before).items() and len(left) > 0.8 * before.count()
    assert sum(i in left for i in toxic) < len(toxic)


def test_repeated_lines_go(steps):
    _, before, after = steps[1]
    dropped = test_linededup.plainly(list(texts(before).items()))
    wanted = {}
    for i, text in texts(before).items():
        kept = [x for n, x in enumerate(text.split("\n")) if (i, n) not in dropped]
        if any(x.strip() for x in kept) or len(kept) == len(text.split("\n")):
            wanted[i] = "\n".join(kept)
    assert texts(after) == wanted


def test_one_document_of_a_group_stays(steps):
    _, before, after = steps[2]
    assert sorted(texts(after)) == [r[0] for r in test_nearcopies.plainly(list(texts(before).items()), 5) if r[3]]


def test_contaminated_documents_go(steps, read):
    _, before, after = steps[3]
    items = [(r.item_id, r.text) for r in read("benchmark").collect()]
    assert sorted(texts(after)) == sorted(r[0] for r in test_decontaminate.plainly(list(texts(before).items()), items) if not r[5])


def test_all_that_is_left_is_packed(steps):
    _, before, after = steps[4]
    pairs = tokenizer(tokenizer_path("byte_bpe_50k.json"))
    sizes = {i: len(pairs.ids([t])[0]) // pairs.dtype.itemsize + 1 for i, t in texts(before).items()}
    packed = {}
    for r in after.collect():
        packed[r.doc_id] = packed.get(r.doc_id, 0) + r.length
        assert r.doc_tokens == sizes[r.doc_id]
    assert packed == sizes


def test_run_is_the_chain_of_stages(spark, folder, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, steps[-1][2].collect()))
