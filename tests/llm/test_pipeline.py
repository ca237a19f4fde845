"""The pipeline's stages on the small tables, and the registration."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cadence.llm import bpe, forest, templates
from cadence.llm.common import saved, table, workdir
from cadence.llm.queries import VOCABULARY
from tests.llm.test_forest import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="shared test tables not present")


def test_stages(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = [docs]
    folder = workdir(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(saved(stage(spark, kept[-1], SF), f"{folder}/{name}"))
        assert kept[-1].columns == docs.columns, name
    ids = [{r.doc_id for r in k.collect()} for k in kept]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    gone = ids[0] - ids[1]
    assert gone and sum(labels.get(d) == 1 for d in gone) <= 1 and sum(labels.get(d) == 0 for d in ids[1]) <= 1
    rows = [(r.doc_id, r.text) for r in kept[2].collect()]
    assert ids[3] == {d for d, _, c in brute(rows, 80) if d == c}
    items = table(spark, SF, "benchmark")
    assert ids[3] - ids[4] == {r.doc_id for r in templates.contaminated(kept[3], items).collect()}
    assert templates.contaminated(kept[4], items).count() == 0
    assert all(len(r.text) == r.n_chars for r in kept[2].collect())
    out = corpus_pipeline.STAGES[-1][1](spark, kept[4], SF).collect()
    own = bpe.Codec(bpe.load_vocabulary(VOCABULARY))
    text = {r.doc_id: r.text for r in kept[4].collect()}
    assert {r.doc_id for r in out} == ids[4] and all(r.ids == own.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) for r in out)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.ids_sha256) for r in whole) == sorted((r.doc_id, r.ids_sha256) for r in out)


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and forest.SHINGLE == 5
