"""Repeated passages of any number of lines, against a plain Python version."""

from __future__ import annotations

import random
import re

from cadence.llm import chunks

SPLIT = re.compile("(?<=\n)|(?<=[.,!?;] )|(?<=[。！？])")
SCHEMA = "doc_id long, text string"


def brute(docs, least=60):
    """A line goes if a stretch around it, of ``least`` characters, stands earlier."""
    split = {d: SPLIT.split(t) for d, t in docs}
    full = {d: [(i, p.strip(" \t\r\n")) for i, p in enumerate(ps) if p.strip(" \t\r\n")] for d, ps in split.items()}
    gone = set()
    for d, ls in full.items():
        for e in sorted(full):
            for shift in range(-len(full[e]), len(ls)):  # ls[k] beside full[e][k - shift]
                if e > d or (e == d and shift <= 0):
                    continue
                k = max(0, shift)
                while k < len(ls) and k - shift < len(full[e]):
                    end = k
                    while end < len(ls) and end - shift < len(full[e]) and ls[end][1] == full[e][end - shift][1]:
                        end += 1
                    if sum(len(x) for _, x in ls[k:end]) >= least:
                        gone |= {(d, i) for i in range(ls[k][0], ls[end - 1][0] + 1)}
                    k = max(end, k + 1)
    return {d: "".join(p for i, p in enumerate(ps) if (d, i) not in gone) for d, ps in split.items()}


def _passages(spark, docs):
    return {r.doc_id: r.text for r in chunks.dedup_passages(spark.createDataFrame(docs, SCHEMA)).collect()}


def test_equals_brute_force(spark, monkeypatch):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    line = lambda: " ".join(word() for _ in range(rnd.randint(1, 12))) + rnd.choice([". ", ", ", "! ", "? ", "; ", "\n", "\n\n", "。"])
    shared = ["".join(line() for _ in range(rnd.randint(1, 6))) for _ in range(12)] + ["x. " * 70, "Often here\n"]
    docs = []
    for d in range(50):
        parts = [line()]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared), *(line() for _ in range(rnd.randint(0, 3)))]
        docs.append((d, "".join(parts)))
    expect = brute(docs)
    assert sum(expect[d] != t for d, t in docs) > 20
    assert _passages(spark, docs) == expect
    monkeypatch.setattr(chunks, "MAX_BITS", 15)  # a crowded set of bits
    monkeypatch.setattr(chunks, "BITS_A_HASH", 1)
    monkeypatch.setattr(chunks, "DEAL", 2)
    assert _passages(spark, docs) == expect


def test_one_line_and_other_sentence_ends(spark):
    one = "This single sentence has more than sixty characters and stands in two documents.\n"
    other = "これは文です。" * 3 + "Is it so? It is so! It must be so; everybody in the whole town has said it before! "
    docs = [(2 * i + k, f"Own {i} {k}.\n{x}Last {i} {k}.") for i, x in enumerate([one, other]) for k in (0, 1)]
    got = _passages(spark, docs)
    assert got[1] == "Own 0 1.\nLast 0 1." and got[3] == "Own 1 1.\nLast 1 1."
    assert got[0] == docs[0][1] and got[2].startswith("Own 1 0.\n") and got[2].endswith(docs[2][1][-95:])


def test_later_versions_meet_each_other(spark):
    """Copies of an edited passage are compared with each other, not only with
    the first occurrence of a boundary."""
    rnd = random.Random(3)
    words = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    base = [words(6) + ".\n" for _ in range(9)]
    edit = [x if i % 3 else words(6) + ".\n" for i, x in enumerate(base)]
    docs = [(0, "".join(base)), *((d, f"{words(3)}\n" + "".join(edit) + words(3)) for d in range(1, 5))]
    got = _passages(spark, docs)
    assert all(got[d].split("\n") == [docs[d][1].split("\n")[0], docs[d][1].split("\n")[-1]] for d in range(2, 5))


def test_bit_set_holds_all_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("id", "xxhash64(id) as code")
    for power, most in ((15, 20_000), (20, 1200)):
        bits = chunks.bit_set(rows.where("id % 20 = 0"), power)
        left = {r.id for r in chunks.maybe_in(rows, bits, power).collect()}
        assert left >= set(range(0, 20_000, 20)) and len(left) < most
    assert chunks.maybe_in(rows, chunks.bit_set(rows.limit(0), 15), 15).count() == 0
