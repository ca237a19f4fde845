"""The labelled sample is one text a doc_id before it is collected."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadence.llm.common import labelled_texts


def test_repeated_rows_are_not_collected(spark, monkeypatch):
    docs = spark.createDataFrame([*((1, f"text {i:03}") for i in range(500)), (2, "b"), (2, "a"), (3, "x" * 50)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 1), (None, 1)], "doc_id long, y int")
    sizes, kind = [], type(docs)
    plain = kind.toPandas
    monkeypatch.setattr(kind, "toPandas", lambda self: (got := plain(self), sizes.append(len(got)))[0])
    texts, y = labelled_texts(docs, labels, "y", F.lit(True), 100, 40)
    assert (texts, y.tolist()) == (["text 000", "a"], [1, 0])
    assert sizes == [2]
