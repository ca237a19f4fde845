"""BPE with forced boundaries against the library, and on odd inputs."""

from __future__ import annotations

import hashlib
import random

import pytest

from cadence.llm import bpe
from cadence.llm.queries import VOCABULARY

tokenizers = pytest.importorskip("tokenizers")
ODD = [*"abzAZ09 \n\t'sΣς§İßéÉ漢字🙂ﬁ½²٣\x1c\x85\x00\x0b", "é", "'re", "'S", "<|endoftext|>", "<|startoftext|>", "<|"]


@pytest.fixture(scope="module")
def both():
    lib = tokenizers.Tokenizer.from_file(VOCABULARY)
    lib.no_truncation()
    lib.no_padding()
    return bpe.Codec(bpe.load_vocabulary(VOCABULARY)), lib


def test_ids_and_decoding_equal_the_library(both):
    own, lib = both
    rnd = random.Random(5)
    for _ in range(4000):
        text = "".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 14)))
        ids = lib.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids, repr(text)
        assert own.decode(ids) == lib.decode(ids, skip_special_tokens=False), repr(text)


def test_cuts_are_certain(both):
    own, lib = both
    rnd = random.Random(6)
    cuts = 0
    for _ in range(500):
        word = "".join(rnd.choice("qxzjkvbé漢ßaeiou") for _ in range(rnd.randint(2, 14)))
        parts = own.cut(word.encode())
        cuts += len(parts) - 1
        assert b"".join(parts) == word.encode()
        whole = own.fragment(word.encode(), True)  # without any cut
        assert own.word(word) == whole
    assert cuts > 100


def test_blocks_of_texts_and_long_words(both, monkeypatch):
    _, lib = both
    monkeypatch.setattr(bpe, "MAX_WORDS", 40)  # generations turn over in each block
    monkeypatch.setattr(bpe, "TOGETHER", 300)
    own = bpe.Codec(bpe.load_vocabulary(VOCABULARY))
    assert own.rising
    rnd = random.Random(8)
    letters = "".join(rnd.choice("etaoinshrdlu") for _ in range(4000))
    texts = ["", None, "<|endoftext|>", "A<|startoftext|><|endoftext|>b", "a" * 4001, "ab" * 900, letters, "漢字" * 500]
    texts += [" ".join(rnd.choice(ODD) * rnd.randint(1, 3) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    want = [lib.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert bpe._encoded(own, texts) == want
    assert bpe._encoded(own, texts[::-1]) == want[::-1]
    assert len(own.words.new) + len(own.words.old) <= 400 and max(map(len, map(str, own.words.new))) <= bpe.LONGEST_WORD
    own.rising = False  # the way of vocabularies that may lower a rank by a merge
    own.words = bpe.Memory(own.learn)
    assert bpe._encoded(own, texts) == want


def test_columns_nulls_and_empty_table(spark, both):
    own, _ = both
    long = "Thé quick bröwn fox. " * 20_000
    rows = [(1, None, 7), (2, "", 8), (3, "a a", 9), (3, "a a", 9), (None, long, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")  # a clashing name
    got = bpe.digests(docs, VOCABULARY).collect()
    assert len(got) == 5
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 0 and by[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert by[None].n_tokens == len(own.encode(long))
    back = bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect()
    assert {r.decoded for r in back if r.doc_id == 3} == {"a</w> a</w>"} and {r.decoded for r in back if r.doc_id == 1} == {""}
    assert bpe.digests(docs.limit(0), VOCABULARY).count() == 0
    less = bpe.digests(docs, VOCABULARY, with_ids=True, without=("text", "doc_id", "absent"))
    assert less.columns == ["n_tokens", "ids_sha256", "decoded_sha256", "ids"] and sorted(less.toPandas().ids_sha256) == sorted(r.ids_sha256 for r in got)
