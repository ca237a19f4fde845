"""Spelling variants against a plain Python version, and on odd inputs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from cadence.llm import variants

LETTERS = "abcé"


def brute_near(word, words):
    near = set()
    for i in range(len(word) + 1):
        near |= {word[:i] + c + word[i:] for c in LETTERS}
        if i < len(word):
            near |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in LETTERS}
    return (near - {word}) & words.keys()


def brute(words):
    near = {w: brute_near(w, words) for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v), default=None) for w, x in near.items()}
    form = {w: b if b and words[b] >= 2 * words[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def test_forms_and_roots_equal_brute_force(spark):
    rnd = random.Random(4)
    words = {"".join(rnd.choice(LETTERS) for _ in range(rnd.randint(5, 8))): rnd.randint(3, 40) for _ in range(700)}
    words |= {"aaaaa": 3, "aaaaaa": 7, "aaaaaaa": 15, "aaaaaaaa": 31, "aaaaaaaaa": 62, "x" * 70: 4, "x" * 71: 9, "x" * 70 + "y": 9}
    expect = brute(words | {})
    long = {w for w in words if w[0] == "x"}
    got = variants.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert len(got) == len(words)
    assert {tuple(r) for r in got if r.word not in long} == {x for x in expect if x[0] not in long}
    # rests longer than the bit set of an edge; of equal counts the smaller form
    of = {r.word: r for r in got}
    assert of["x" * 70].form == "x" * 71 and of["x" * 70].n_near == 2 and of["x" * 71].n_near == 2 and of["x" * 71].form is None
    assert sum(r.root != r.form for r in got if r.form) > 3


def test_words_that_share_a_prefix_or_a_hash(spark, monkeypatch):
    """One node for all prefixes of a depth: rows only gain edges."""
    rnd = random.Random(8)
    words = {"inter" + "".join(rnd.choice(LETTERS) for _ in range(rnd.randint(0, 4))): rnd.randint(3, 40) for _ in range(150)}
    monkeypatch.setattr(variants, "_node", lambda prefix: variants.F.length(prefix) * 2 + variants.F.col("back").cast("int"))
    rows = variants.group_variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()
    assert {(r.word, r.form, r.n_near) for r in rows} == {(x[0], x[1], x[4]) for x in brute(words)}


def test_counting_and_slips(spark):
    rnd = random.Random(2)
    base = ["Straße", "ÉCOLE", "window", "Windows", "short", "tiny", "a×b÷c", "naïveté"]
    rows = [(d, " ".join(rnd.choice(base) for _ in range(30)) + "\n1x2") for d in range(60)]
    rows += [(None, "window window"), (61, None), (62, ""), (3, rows[3][1])]
    expect = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            expect[run] += 1
    expect = {w: n for w, n in expect.items() if len(w) >= 5 and n >= 3}
    docs = spark.createDataFrame([(d, t, 9, "x") for d, t in rows], "doc_id long, text string, n int, word string")
    assert {r.word: r.n for r in variants.count_words(docs).collect()} == expect
    assert any(w not in {"straße", "École".lower(), "window", "windows", "short", "a×b÷c", "naïveté"} for w in expect) or len(expect) >= 6
    whole = variants.count_words(docs, slip_every=None).collect()
    assert {r.word: r.n for r in whole}["window"] == sum((t or "").count("window") for _, t in rows)


def test_empty_nulls_and_repeated_words(spark):
    schema = "word string, n long, form string"
    assert variants.group_variants(spark.createDataFrame([], schema)).count() == 0
    assert variants.count_words(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [("hello", 3, "x"), ("hello", 3, "x"), ("hallo", 12, None), (None, 5, None), ("other", None, None)]
    got = variants.group_variants(spark.createDataFrame(rows, schema)).collect()
    assert {tuple(r) for r in got} == {("hello", "hallo", "hallo", 6, 1, 12), ("hallo", None, "hallo", 12, 1, None)}
