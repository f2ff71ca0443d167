"""The pipeline, stage by stage against what each operator says by itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from layerline.llm import toxicity
from layerline.llm.common import table
from layerline.operators.scale import materialize
from tests.llm.test_neardup import brute_force as near_brute_force
from tests.llm.test_quality import counted, fails


@pytest.fixture(scope="module")
def stages(spark, folder):
    documents = table(spark, folder, "documents")
    out = [documents]
    for name, stage in corpus_pipeline.STAGES:
        documents = materialize(stage(spark, documents, folder), f"test-{name}")
        out.append(documents)
    return out


def texts(frame) -> dict:
    return {r.doc_id: r.text for r in frame.collect()}


def test_columns(stages):
    for frame in stages[:-1]:
        assert frame.dtypes == stages[0].dtypes


def test_toxicity(spark, folder, stages):
    labels = table(spark, folder, "labels")
    model = toxicity.fit(toxicity.training_sample(stages[0], labels))
    scorer = toxicity.Scorer(model, toxicity.Settings.bits)
    clean = {
        k: t for k, t in texts(stages[0]).items() if scorer.document(scorer.sentences(t or "")[1]) < 0.7
    }
    assert texts(stages[1]) == clean


def test_quality(stages):
    before = texts(stages[1])
    assert texts(stages[2]) == {k: t for k, t in before.items() if not fails(counted(t))}


def test_lines(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert set(before) == set(after)
    seen = set()
    for key in sorted(before):
        own = before[key].split("\n")
        left = iter(own)
        # what stays is a part of the text in order
        assert after[key] == "" or all(line in left for line in after[key].split("\n"))
        for line in after[key].split("\n"):
            assert len(line) < 30 or line not in seen
            seen.add(line)
    for row in stages[3].collect():
        assert row.n_chars == len(row.text)


def test_near_duplicates(stages):
    before = texts(stages[3])
    kept = {k for k, _, _, stays in near_brute_force(list(before.items()), 5) if stays}
    assert texts(stages[4]) == {k: t for k, t in before.items() if k in kept}


def test_packing(stages):
    rows = stages[5].collect()
    assert {r.doc_id for r in rows} == set(texts(stages[4]))
    for row in rows:
        assert len(row.ids) == row.length
        assert zlib.crc32(np.array(row.ids, "<u4").tobytes()) == row.ids_crc32


def test_registered(spark, folder, stages):
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    total = lambda frame: frame.agg({"length": "sum"}).first()[0]
    assert total(corpus_pipeline.run(spark, folder)) == total(stages[5])


def test_one_row_of_each_group_of_repeated_and_null_keys(spark, folder):
    text = " ".join(f"word{i}" for i in range(60))
    edited, other = text + " end", " ".join(f"else{i}" for i in range(60))
    rows = [(1, text), (1, text), (1, edited), (2, text), (None, text)]  # one group
    rows += [(None, other), (None, other), (None, other + " end")]  # another, without any key
    rows += [(3, "alone in here with its six words"), (3, "something else under the same old key")]
    rows += [(None, ""), (None, ""), (5, ""), (5, ""), (6, None)]
    schema = "doc_id long, text string, n_chars long"
    frame = spark.createDataFrame([(k, t, 0) for k, t in rows], schema).repartition(3)
    left = sorted(((r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, frame, folder).collect()), key=repr)
    first = [r for r in left if r[1] in (text, edited)]
    assert len(first) == 1 and first[0][0] == 1
    second = [r for r in left if r[1] in (other, other + " end")]
    assert len(second) == 1
    assert [r for r in left if r not in first + second] == sorted(
        [rows[8], rows[9], (None, ""), (None, ""), (5, ""), (6, None)], key=repr
    )
