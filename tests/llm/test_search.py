"""Ranked search against a plain Python version, and on odd inputs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from cadence.llm import search

SCHEMA = "doc_id long, text string"
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, best=50):
    found = [(d, Counter(terms(t))) for d, t in docs]
    found = [(d, c, c.total()) for d, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    out = set()
    for item, text in items:
        scores = []
        for d, c, n in found:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if s > 0:
                scores.append((-s, d is None, d))
        out |= {(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(scores)[:best], 1)}
    return out


def corpus(rnd, n):
    word = lambda: rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.choice([1, 1, 2]) + rnd.choice(["", "", "é", "É", "ß", "7"])
    return [(d, " ".join(rnd.choice([word(), word().upper()]) + rnd.choice(["", ".", "-x", "_"]) for _ in range(rnd.randint(0, 60)))) for d in range(n)]


def test_ranks_equal_brute_force_and_groups_are_left_out(spark, monkeypatch):
    rnd = random.Random(6)
    docs = corpus(rnd, 600)
    docs += [(600 + k, docs[7][1]) for k in range(80)]  # ties, over the end of the list
    items = [(k, " ".join(t for _, t in corpus(rnd, 2))) for k in range(12)] + [(12, docs[7][1]), (13, "nowhereelse"), (14, "É é")]
    frame, asked = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, "item_id int, text string")
    got = search.search(frame, asked).collect()
    assert {tuple(r) for r in got} == brute(docs, items) and len(got) == len(set(got))
    monkeypatch.setattr(search, "MAX_TERMS", 40)  # several rounds
    monkeypatch.setattr(search, "BLOCK_ROWS", 7)
    got = search.search(frame, asked, best=3).collect()
    assert {tuple(r) for r in got} == brute(docs, items, 3)


def test_a_mask_group_is_evaluated_only_if_it_can_matter():
    rnd = np.random.default_rng(1)
    n_docs, n_terms = 4000, 30
    weight = np.arange(1, n_terms + 1) ** 3
    ranker = search.Ranker([np.arange(n_terms)], weight, n_docs, n_docs * 10, 10)
    held = [np.flatnonzero(rnd.random(n_terms) < 0.2) for _ in range(n_docs)]
    ends, at = np.concatenate(([0], np.cumsum([len(x) for x in held]))), np.concatenate(held)
    ranker.add(np.arange(n_docs), np.full(n_docs, 10), ends, at, np.ones(len(at), np.int32))
    part = 10**9 // (1000 + 20 * (50 + 50))
    scores = sorted(((int(weight[x].sum()) * part, -d) for d, x in enumerate(held)), reverse=True)[:10]
    assert sorted(ranker.kept[0], reverse=True) == scores
    assert ranker.evaluated < n_docs / 10


def test_nulls_empty_tables_repeats_and_names(spark):
    docs = [(1, "red apple"), (2, None), (3, ""), (None, "red apple"), (1, "red apple"), (5, "... !"), (6, "green pear " * 40_000)]
    items = [(7, "Apple"), (None, "pear"), (8, None), (9, ""), (7, "red"), (7, "Apple")]
    frame = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in docs], "doc_id long, text string, score int, rank int, item_id string")
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id int, text string, score int, doc_id int")
    got = [tuple(r) for r in search.search(frame, asked).collect()]
    assert sorted(got, key=str) == sorted(
        [(7, k, d, s) for (_, k, d, s) in _ranks(docs, "apple red")] + [(None, k, d, s) for (_, k, d, s) in _ranks(docs, "pear")], key=str
    )
    assert search.search(frame.limit(0), asked).count() == 0 and search.search(frame, asked.limit(0)).count() == 0


def _ranks(docs, text):
    """brute() keeps equal rows once; repeated documents are ranked beside each other."""
    named = [(k, t) for k, (_, t) in enumerate(docs)]
    rows = [(s, docs[k][0]) for _, _, k, s in brute(named, [(0, text)])]
    rows = sorted(rows, key=lambda x: (-x[0], x[1] is None, x[1] or 0))
    return [(0, k, d, s) for k, (s, d) in enumerate(rows, 1)]
