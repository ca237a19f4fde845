"""LSH forest: components against brute force, also with every group dense."""

from __future__ import annotations

import random
import re
import string

import pytest

from cadence.llm import forest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = {(d, t): shingles(t) for d, t in rows}
    top = {k: k for k in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    keys = [k for k in sets if k[0] is not None and sets[k]]
    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if 100 * len(x & y) >= percent * len(x | y):
                u, v = sorted((find(a), find(b)))
                top[v] = u
    return [(d, len(sets[d, t]), None if d is None else find((d, t))[0]) for d, t in rows]


def _corpus(seed, n_groups=12, copies=14):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4)))
    texts = []
    for _ in range(n_groups):
        base = [word() for _ in range(rnd.randint(30, 300))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = word().upper()
            texts.append(" ".join(w))
    texts += ["", " \n", "one", "ONE", "one two three four", "One  two\nthree four", "a b c d e", "b c d e a"]
    rnd.shuffle(texts)
    return [*enumerate(texts), (None, texts[0]), (None, None), (5000, None), (3, texts[3]), (3, texts[3])]


@pytest.mark.parametrize(("region", "groups", "copies"), [(64, 12, 14), (16, 3, 70), (3, 12, 14)])
def test_components_equal_brute_force(spark, monkeypatch, region, groups, copies):
    monkeypatch.setattr(forest, "REGION", region)
    for name, value in {"FANOUT": 2, "BLOCK": 8, "OUTSIDERS": 4}.items():
        monkeypatch.setattr(forest, name, value)
    monkeypatch.setattr(forest, "MAX_BROADCAST_KEYS", 0 if region < 64 else 1000)
    rows = _corpus(region, groups, copies)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, kept int")
    got = forest.near_duplicates(docs, 85).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute(rows, 85), key=key)
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in got)


def test_one_of_each_group_stays(spark):
    rows = _corpus(4, 4, 6)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, node string, kept int")
    out = forest.without_near_duplicates(docs, 80)
    assert out.columns == docs.columns
    expect = [d for d, _, c in brute(rows, 80) if d is None or d == c]
    key = lambda x: (x is None, x)
    assert sorted((r.doc_id for r in out.collect()), key=key) == sorted(expect, key=key)
    assert forest.without_near_duplicates(docs.limit(0)).count() == 0


def test_long_text_and_lonely_rows(spark):
    long = " ".join(f"w{i}" for i in range(150_000))
    docs = spark.createDataFrame([(1, long), (2, long + " end"), (3, "all alone here by itself now")], "doc_id long, text string")
    got = {r.doc_id: r for r in forest.near_duplicates(docs).collect()}
    assert got[2].component_id == 1 and got[1].n_shingles == 149_996 and got[3].kept
