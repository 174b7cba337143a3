"""The pipeline against plain computations of each stage on its own input."""

import hashlib
import re

import numpy as np
import pytest
import test_decontaminate
import test_hyperminhash
import test_pii

import corpus_pipeline
from admesh.llm import pieces, quality
from admesh.llm.tables import SCHEMAS
from admesh.llm.tables import table as scan

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Rows after every stage, the raw documents first."""
    from admesh.storage import RunFolder
    run, docs = RunFolder(spark), scan(spark, FOLDER, "documents")
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = run.write(stage(spark, docs, FOLDER), name)
        out.append(docs.collect())
        if name != "sentencepiece":
            assert ", ".join(f"{c} {t}" for c, t in docs.dtypes) == SCHEMAS["documents"]
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_quality(spark, stages):
    raw = texts(stages[0])
    labels = {r.doc_id: r for r in scan(spark, FOLDER, "labels").collect() if r.doc_id in raw}
    ids = sorted(labels)
    model = quality.fit(quality.summarise([raw[i] for i in ids]), np.array([labels[i].quality for i in ids]),
                        np.array([labels[i].toxic for i in ids]))
    order = sorted(raw)
    scores = quality.score(model, [raw[i] for i in order])
    kept = (scores["junk"] < quality.REJECT) & (scores["toxic"] < quality.REJECT)
    assert texts(stages[1]) == {i: raw[i] for i, k in zip(order, kept) if k}
    assert 0 < len(stages[1]) < len(raw)


def test_near_duplicates(stages):
    before = texts(stages[1])
    kept = {i for i, _, _, first in test_hyperminhash.brute(list(before.items())) if first}
    assert texts(stages[2]) == {i: before[i] for i in kept}
    assert len(kept) < len(before)


def test_decontamination(spark, stages):
    before = texts(stages[2])
    items = [(r.item_id, r.text) for r in scan(spark, FOLDER, "benchmark").collect()]
    leaks = {i for i, _ in test_decontaminate.brute(list(before.items()), items)}
    assert texts(stages[3]) == {i: t for i, t in before.items() if i not in leaks}
    assert leaks


def test_redaction(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert not test_pii.base(after[i])
        if "[" not in after[i]:
            assert after[i] == text
        outside = re.split(r"\[(?:EMAIL|IP|CARD|PHONE|SECRET)\]", after[i])
        assert re.fullmatch(".*?".join(map(re.escape, outside)), text, re.S)
    assert before != after and all(len(r.text) == r.n_chars for r in stages[4] if texts(stages[3])[r.doc_id] != r.text)


def test_segmentation(stages):
    vocab = pieces.vocabulary(pieces.MODEL)
    assert {r.doc_id: pieces.decode(vocab, r.ids) for r in stages[5]} == texts(stages[4])
    assert all(r.text_sha256 == hashlib.sha256(texts(stages[4])[r.doc_id].encode()).hexdigest() for r in stages[5])


def test_run_gives_the_last_stage(spark, stages):
    got = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == {r.doc_id: list(r.ids) for r in stages[5]}
