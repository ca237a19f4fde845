"""Packing: exact cover, full windows, the library's ids, balanced steps."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cadence.llm import packing
from cadence.llm.queries import VOCABULARY

tokenizers = pytest.importorskip("tokenizers")
ODD = [*"abzAZ09 \n\t'sΣς§İßéÉ漢字🙂ﬁ½²٣\x1c\x85\x00\x0b́\xa0 ", "é", "'re", "'S", "<|endoftext|>", "<|", "Word.", "été!?", "x×y", "ﬀ", "a$%", "B_-", "c|>", "é`~"]


@pytest.fixture(scope="module")
def lib():
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    t.no_truncation()
    t.no_padding()
    return t


def check(rows, texts, lib, window=4096):
    """``rows`` of distinct doc_ids cover each document's ids once and every sequence without a hole."""
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
    assert of.keys() == texts.keys()
    for d, own in of.items():
        ids, at = np.array([*lib.encode(texts[d] or "", add_special_tokens=False).ids, 2], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            assert r.ids is None or bytes(r.ids) == ids[at : at + r.length].tobytes()
            at += r.length
        assert at == len(ids)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= own[0].tier <= window and len({(r.tier, r.step) for r in own}) == 1
    return sequences


def test_ids_equal_the_library(lib, monkeypatch):
    rnd = random.Random(7)
    with open(VOCABULARY, encoding="utf-8") as f:
        own = packing.Encoder(f.read(), 2)
    texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 16))) for _ in range(3000)]
    texts += [" ".join(rnd.choice(["Été", "ÉTÉ.", "the", "The,", "mañana!!", "straße"]) for _ in range(50)) for _ in range(20)]
    for limit, split in ((10**6, 1 << 20), (60, 5)):  # and with much forgetting, in short parts
        monkeypatch.setattr(packing, "MAX_REMEMBERED", limit)
        monkeypatch.setattr(packing, "SPLIT_CHARS", split)
        for t in texts:
            assert own(t).tolist() == [*lib.encode(t, add_special_tokens=False).ids, 2], repr(t)


def test_covers_fills_and_balances(spark, lib):
    rnd = random.Random(3)
    words = ["the", "quick", "Brown", "fox.", "straße", "qzxv"]
    texts = {d: " ".join(rnd.choice(words) for _ in range(int(rnd.expovariate(1 / 700)))) for d in range(900)}
    texts |= {900: None, 901: "", 902: "fox " * 30_000, 903: "fox " * 4095, 904: "fox " * 511}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    rows = packing.pack(docs, VOCABULARY, step_tokens=1 << 15, group_tokens=60_000).collect()
    sequences = check(rows, texts, lib)
    open_ = [s for s in sequences.values() if sum(r.length for r in s) < s[0].tier]
    assert len(open_) <= 1  # one a group of the second packing
    needed = sum(-(-r.doc_tokens // 4096) for r in rows if r.start == 0)
    assert len(rows) < 1.6 * needed
    steps = {}
    for s in sequences.values():
        steps.setdefault(s[0].step, []).append(s[0].tier)
    for tier in packing.TIERS:
        counts = [x.count(tier) for x in steps.values()]
        assert max(counts) - min(counts) <= 1
    assert len(steps) == round(sum(r.length for r in rows) / (1 << 15))


def test_gaps_are_filled_from_shorter_tiers_first():
    p = packing.Packer()
    for owner, n in enumerate((3000, 3000, 700, 396, 300, 500, 296, 400)):
        p.add(owner, 0, n)
    left = p.pack()
    windows = {k: sorted((x[0], x[1], x[2]) for x in p.pieces if x[3] == k) for k in range(2)}
    assert p.sizes == [4096, 4096]
    # the first gap is met by whole pieces; of the second the end is cut from the shortest piece left
    assert [x[1:] for x in windows[0]] == [(0, 3000), (0, 700), (0, 396)]
    assert [x[1:] for x in windows[1]] == [(0, 3000), (0, 500), (0, 196), (0, 400)]
    assert sorted(x[:3] for x in left) == [(4, 0, 300), (6, 196, 100)]


def test_nulls_repeats_empty_table_and_names(spark, lib):
    rows = [(None, "one two", 1, "x"), (5, "same", 2, None), (5, "same", 2, None), (6, None, 3, "y")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, start int, tier string")
    got = packing.pack(docs, VOCABULARY, with_ids=False).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 3), (5, 2), (5, 2), (6, 1)]
    assert len({r.sequence_id for r in got}) == 1 and sorted(r.offset for r in got)[0] == 0 and all(r.ids is None for r in got)
    assert packing.pack(docs.limit(0), VOCABULARY).count() == 0
