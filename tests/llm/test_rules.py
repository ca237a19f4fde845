"""Line-first rules: counts against brute force, verdicts, odd inputs."""

from __future__ import annotations

import collections
import random
import re

import pandas as pd

from cadence.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(t: str):
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    seen = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force():
    rnd = random.Random(8)
    pool = ["a", "bb", "é", "漢", "#", "x|", " ", "\n", "\t", "\x0b", " ", "\x1c", "word ", "\n\n", "$5 "]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 80))) for _ in range(1500)] + ["", "\n", "a b c d e " * 9]
    got, kept = rules.judged(texts)
    assert list(got[rules.COUNTS].itertuples(index=False, name=None)) == [brute(t) for t in texts]
    assert len(kept) == len(texts)


def test_lines_go_first_then_documents():
    good = "This is a plain sentence with more than ten words in it, as one would expect."
    other = "Another line of text follows here and it too has words enough to stay."
    menu, shout, cookie = "Home | News | Sport | Contact", "BUY!! NOW!! CHEAP!! THINGS!!", "Accept cookies to go on"
    got, kept = rules.judged([f"{menu}\n{good}\n{other}\n{cookie}", f"{good}\n" + f"{shout} {shout[:9]}\n" * 1 + menu * 4, good])
    assert kept[0] == [good, other] and got.kept.tolist() == [True, False, True]
    assert got.n_lines_failed.tolist()[0] == 2


def test_columns_nulls_long_texts_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    rows = [(1, None, 3), (2, "", 3), (3, "a b", 3), (3, "a b", 3), (None, long, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in rules.clean(docs).collect()}
    assert got[1].n_words == 0 and not got[1].kept and got[1].base_failed and got[2].clean_text == ""
    assert got[None].n_words == 200_000 and got[None].kept and got[None].clean_text == long
    assert rules.clean(docs).count() == 5 and rules.clean(docs.limit(0)).count() == 0
    assert isinstance(rules.judged([])[0], pd.DataFrame)
