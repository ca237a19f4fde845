"""The trained operators: parts against brute force, held-out accuracy, odd inputs."""

from __future__ import annotations

import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.llm import crf, language, toxicity
from cadence.llm.common import in_fold, table

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="shared test tables not present")
ODD = [(1, None, 5), (2, "", 5), (3, "123 !?", 5), (4, "a", 5), (4, "a", 5), (None, "the " * 60_000, 5), (6, "x\n\n\ny", 5), (7, "İ Σ 漢字 🙂", 5)]


def _odd(spark):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, score int")
    return docs, docs.select("doc_id", F.lit("en").alias("lang"), "text", "score")


# --- toxicity ------------------------------------------------------------------


def test_a_counterfactual_penalty_frees_identity_terms():
    rnd = random.Random(1)
    words = [f"word{i}" for i in range(40)]
    say = lambda *extra: " ".join(rnd.sample(words, 8) + list(extra)) + "."
    texts, y = [], []
    for i in range(400):
        bad = i % 4 == 0
        extra = ["awful"] * bad + ["muslims"] * (rnd.random() < (0.6 if bad else 0.02))  # a biased sample
        texts.append(say(*extra))
        y.append(int(bad and rnd.random() < 0.9))
    y = np.array(y)
    neutral = [say("muslims") for _ in range(50)]
    plain, free = toxicity.fit(texts, y, counterfactual=0.0), toxicity.fit(texts, y)
    swap = [next(toxicity.swapped(t)) for t in neutral]
    gap = lambda m: np.abs(toxicity.score(m, neutral) - toxicity.score(m, swap)).mean()
    assert gap(free) < 0.2 * gap(plain)
    assert toxicity.score(free, neutral).mean() < toxicity.score(plain, neutral).mean()
    assert (toxicity.score(free, [say("awful") for _ in range(20)]) > 0.3).all()


@needs_data
def test_held_out_toxicity(spark):
    sf = SF.replace("sf0.01", "sf0.1")
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    held = in_fold(F.col("doc_id"), 4, 2)
    got = toxicity.classify(docs, labels, ~held).where(held).join(labels, "doc_id").select("predicted", "toxic").toPandas()
    assert got[got.toxic == 1].predicted.mean() > 0.88 and got[got.toxic == 0].predicted.mean() < 0.02


# --- language ------------------------------------------------------------------


def test_kernel_is_the_cosine_of_presence():
    texts = ["abc abd", "xyz", "abc", "a"]
    grams = []
    for t in texts:
        s = t + " "
        grams.append({s[i : i + n] for n in language.ORDERS for i in range(len(s) - n + 1)})
    x = language.presence(texts)
    assert x.sum(1).tolist() == [len(g) for g in grams]
    k = language.kernel(x, x)
    for i, j in itertools.product(range(4), repeat=2):
        assert abs(k[i, j] - len(grams[i] & grams[j]) / np.sqrt(len(grams[i]) * len(grams[j]))) < 1e-6


@needs_data
def test_held_out_language(spark):
    docs = table(spark, SF, "documents")
    held = in_fold(F.col("doc_id"), 4, 2)
    got = language.identify(docs, ~held).where(held)
    assert got.where("lang_pred = lang").count() > 0.97 * got.count()


# --- quality -------------------------------------------------------------------


def test_marginals_equal_brute_force():
    rnd = np.random.default_rng(2)
    lengths = [4, 1, 3, 6]
    row = np.repeat(np.arange(4), lengths)
    unary, move = rnd.normal(size=len(row)), rnd.normal(size=(2, 2))
    p, pairs = crf.marginals(unary, move, row, 4)
    expect, both = [], np.zeros((2, 2))
    for d, n in enumerate(lengths):
        u = unary[row == d]
        weight = {x: np.exp(sum(u[i] * x[i] for i in range(n)) + sum(move[a, b] for a, b in zip(x, x[1:]))) for x in itertools.product([0, 1], repeat=n)}
        z = sum(weight.values())
        expect += [sum(w for x, w in weight.items() if x[i]) / z for i in range(n)]
        for x, w in weight.items():
            for a, b in zip(x, x[1:]):
                both[a, b] += w / z
    assert np.allclose(p, expect) and np.allclose(pairs, both)


@needs_data
def test_held_out_quality(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    held = in_fold(F.col("doc_id"), 5, 0)
    got = crf.classify(docs, labels, ~held).where(held).join(labels, "doc_id").select("predicted", "quality").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97


# --- odd inputs of all three ---------------------------------------------------


@needs_data
def test_defined_cases(spark):
    docs, with_lang = _odd(spark)
    labels = spark.createDataFrame([(i, i % 2, (i + 1) % 2) for i in range(1, 8)] + [(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    for run in (toxicity.classify, crf.classify):
        got = run(docs, labels, F.lit(True))
        assert got.count() == len(ODD) and got.where("score between 0 and 1 and predicted in (0, 1)").count() == len(ODD)
        assert got.columns.count("score") == 1
        assert run(docs.limit(0), labels, F.lit(True)).count() == 0
        assert run(docs, labels.limit(0), F.lit(True)).count() == len(ODD)
    got = {r.doc_id: r for r in language.identify(with_lang, F.lit(True)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[4].lang_pred == "en" and got[7].lang_pred == "en"
    assert language.identify(with_lang.withColumn("lang", F.lit(None).cast("string")), F.lit(True)).where("lang_pred = 'und'").count() == len(ODD)
    assert language.identify(with_lang.limit(0), F.lit(True)).count() == 0
