"""Line-chunk deduplication against a plain Python version."""

from __future__ import annotations

import hashlib
import random
import re

from cadence.llm import chunks, common


def brute(docs: list[tuple[int, str]], least_chars: int) -> dict[int, str]:
    """doc_id -> text without its repeated passages."""
    split = {d: [p for p in re.split(r"(?<=\n)|(?<=[.,] )", t)] for d, t in docs}
    lines = {d: [p.strip(" \t\r\n") for p in ps] for d, ps in split.items()}
    marks = []
    for d, ls in lines.items():
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in ls]
        r = [x if i == 0 else (h[i - 1] * 1000003 + x) % 2147483647 for i, x in enumerate(h)]
        at = [i for i in range(2, len(r) - 1) if r[i] < r[i - 1] and r[i] <= r[i + 1]]
        ends = [0, *at, len(ls)]
        marks += [(d, b, ends[k], ends[k + 2], (ls[b - 1], ls[b])) for k, b in enumerate(at)]
    first = {}
    for m in sorted(marks):
        first.setdefault(m[4], m)
    gone = set()
    for d, b, low, high, meet in marks:
        rd, rb, rlow, rhigh, _ = first[meet]
        if (rd, rb) == (d, b):
            continue
        up = down = 0
        while b - up - 1 >= low and rb - up - 1 >= rlow and lines[d][b - up - 1] == lines[rd][rb - up - 1]:
            up += 1
        while b + down < high and rb + down < rhigh and lines[d][b + down] == lines[rd][rb + down]:
            down += 1
        if sum(map(len, lines[d][b - up : b + down])) >= least_chars:
            gone |= {(d, i) for i in range(b - up, b + down)}
    return {d: "".join(p for i, p in enumerate(ps) if (d, i) not in gone) for d, ps in split.items()}


def _sentence(rnd):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 5))) for _ in range(rnd.randint(3, 9))).capitalize() + rnd.choice([". ", ".\n", "\n", ", and. "])


def _corpus(seed):
    rnd = random.Random(seed)
    shared = ["".join(_sentence(rnd) for _ in range(rnd.randint(3, 12))) for _ in range(6)]
    docs = []
    for d in range(60):
        parts = ["".join(_sentence(rnd) for _ in range(rnd.randint(0, 8)))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(shared), "".join(_sentence(rnd) for _ in range(rnd.randint(0, 8)))]
        docs.append((d, "".join(parts)))
    return docs, shared


def test_equals_brute_force(spark, monkeypatch):
    docs, _ = _corpus(1)
    expect = brute(docs, 60)
    assert sum(expect[d] != t for d, t in docs) > 20
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: r.text for r in chunks.dedup_lines(table).collect()} == expect
    monkeypatch.setattr(common, "MAX_PRUNING_KEYS", -1)  # the path without broadcasts
    monkeypatch.setattr(chunks, "DEAL", 2)
    assert {r.doc_id: r.text for r in chunks.dedup_lines(table).collect()} == expect


def test_a_passage_is_found_wherever_it_stands(spark):
    rnd = random.Random(9)
    passages = [" ".join(_sentence(rnd).strip().rstrip(".,") + "." for _ in range(9)) for _ in range(40)]
    docs = [(2 * i + k, f"Own start {i} {k} goes here. Then more {k} words. {p} And the end {k} is {i}.") for i, p in enumerate(passages) for k in (0, 1)]
    got = {r.doc_id: r.text for r in chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[2 * i] == docs[2 * i][1] for i in range(40))  # the first copy stays
    caught = sum(p[20:-20] not in got[2 * i + 1] for i, p in enumerate(passages))
    assert caught >= 38
    assert all(f"Own start {i} 1 goes here. " in got[2 * i + 1] for i in range(40))  # its surroundings stay


def test_defined_cases(spark):
    long = "".join(f"Line {i} of a long one.\n" for i in range(3000))
    body = "".join(f"Shared sentence number {i} is here. " for i in range(12))
    odd = "a\x01b. c\nd"
    rows = [
        (1, None, "x", 1), (2, "", "x", 1), (3, body, "x", 1), (4, body, None, 2), (4, body, None, 2), (None, body, "n", 3),
        (6, long, "x", 1), (7, long, "x", 1), (8, odd, "x", 1), (9, "One. Two.", "x", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ranges string, n_removed int")
    out = chunks.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "ranges", "n_lines", "n_removed"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[1].text is None and by[1].n_lines == 0 and by[2].text == "" and by[8].text == odd and by[9].text == "One. Two."
    assert by[None].text == body  # null ids come first
    assert by[6].text == long and by[7].n_removed >= 2990 and by[3].n_removed >= 10
    assert len({r.text for r in got if r.doc_id == 4}) == 1
    assert chunks.dedup_lines(docs.limit(0)).count() == 0
    assert chunks.dedup_lines(docs.where("doc_id = 9")).first().text == "One. Two."
