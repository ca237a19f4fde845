"""BPE encoding and decoding with forced boundaries.

A merge can only join bytes that stand next to each other inside some
vocabulary token. Two neighbouring bytes that never do are a *certain cut*: no
merge ever crosses it. Every pre-token is cut at all such places, the fragments
are encoded independently, and their ids are concatenated; the result equals
encoding the whole pre-token. The new words of a block of texts are cut and
encoded together, all their fragments side by side in one array, and remembered.

Null and empty texts give no tokens. Special-token strings inside a text become
their own ids, as the library does by default. Rows keep all their columns;
columns with the names of the results are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cadence.llm.common import blocks, with_arrays

END = "</w>"
#: Words that a worker remembers in each of two generations; longer ones are not.
MAX_WORDS = 60_000
LONGEST_WORD = 64
#: Characters of the texts that are encoded together.
TOGETHER = 1 << 17
NO_MERGE = 1 << 40
# Fixed values of the vocabulary's format: its pre-tokens, which hold no white space.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files:
    visible Latin-1 bytes stand for themselves, the rest follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """What the tasks need of a tokenizer file, read once on the driver."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {
        "name": path,
        "vocab": model["vocab"],
        "merges": pairs,
        "special": {t["content"]: t["id"] for t in spec["added_tokens"]},
    }


class Memory:
    """The ids of words, as ``learn`` gives them, remembered in two generations."""

    def __init__(self, learn: Callable[[list], list[tuple[int, ...]]]):
        self.learn, self.new, self.old = learn, {}, {}

    def find(self, words: list[str | int]) -> list[tuple[int, ...]]:
        found = list(map(self.new.get, words))
        absent = [k for k, ids in enumerate(found) if ids is None]
        if absent:
            known = {w: self.old.get(w) for w in dict.fromkeys(words[k] for k in absent)}
            unknown = [w for w, ids in known.items() if ids is None]
            known.update(zip(unknown, self.learn(unknown), strict=True))
            if len(self.new) + len(known) > MAX_WORDS:  # what is still in use comes back from the older ones
                self.old, self.new = self.new, {}
            self.new.update((w, ids) for w, ids in known.items() if isinstance(w, int) or len(w) <= LONGEST_WORD)
            for k in absent:
                found[k] = known[words[k]]
        return found


class Codec:
    """Encoder and decoder of one vocabulary; built once per Python worker."""

    def __init__(self, spec: dict):
        self.vocab: dict[str, int] = spec["vocab"]
        self.special: dict[str, int] = spec["special"]
        self.names = [str(i) for i in range(max([*self.vocab.values(), *self.special.values()]) + 1)]
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        # merges by the ids of their two sides, in order; the last entry is none
        sides = np.array([(self.vocab[x], self.vocab[y]) for x, y in spec["merges"]], np.int64).reshape(-1, 2)
        self.made = np.array([self.vocab[x + y] for x, y in spec["merges"]], np.int64)
        pairs, rank = sides[:, 0] << 20 | sides[:, 1], np.arange(len(sides))
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.pair_rank = np.append(pairs[order], 1 << 62), np.append(rank[order], NO_MERGE)
        born = np.full(max(self.vocab.values()) + 1, -1)
        np.maximum.at(born, self.made, rank)
        #: no merge makes a pair of a lower rank than its own
        self.rising = bool((born[sides] < rank[:, None]).all())
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.final = np.array([self.vocab[c + END] for c in letters], np.int64)
        value = {c: b for b, c in enumerate(letters)}
        #: joined[a, b]: byte b follows byte a inside some token
        self.joined = np.zeros((256, 256), bool)
        for token in self.vocab:
            raw = [value[c] for c in token.removesuffix(END)]
            self.joined[raw[:-1], raw[1:]] = True
        self.split = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.words = Memory(self.learn)

    def cut(self, raw: bytes) -> list[bytes]:
        """The fragments between certain cuts."""
        flat = np.frombuffer(raw, np.uint8)
        ends = [*(np.flatnonzero(~self.joined[flat[:-1], flat[1:]]) + 1).tolist(), len(raw)]
        return [raw[s:e] for s, e in zip([0, *ends], ends, strict=False)]

    def _rank(self, ids: np.ndarray, group: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The ranks of the pairs that begin at these places; fragments do not meet."""
        after = np.minimum(at + 1, len(ids) - 1)
        pair = ids[at] << 20 | ids[after]
        k = np.searchsorted(self.pairs, pair)
        return np.where((self.pairs[k] == pair) & (group[at] == group[after]) & (after > at), self.pair_rank[k], NO_MERGE)

    def merged(self, flat: np.ndarray, begin: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many fragments, and the bytes at which their tokens begin.
        ``begin``: a fragment begins here; ``last``: a pre-token ends here.

        Each round merges the lowest-ranked pair of every fragment that has one,
        wherever it stands in the fragment, from the left; if merges could make
        pairs of a lower rank than their own, only its first place.
        """
        ids = np.where(last, self.final[flat], self.inner[flat])
        at, group = np.arange(len(flat)), np.cumsum(begin)
        rank = self._rank(ids, group, at)
        ready = [(at[:0], ids[:0])]
        while len(ids):
            first = np.flatnonzero(np.diff(group, prepend=0))
            low = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(ids))))
            if not (more := low < NO_MERGE).all():
                ready.append((at[~more], ids[~more]))
                ids, at, group, rank, low = ids[more], at[more], group[more], rank[more], low[more]
            place = np.flatnonzero(rank == low)
            if self.rising:  # of equal pairs that overlap every second one
                run = np.flatnonzero(np.diff(place, prepend=-2) != 1)
                place = place[(np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))) % 2 == 0]
            else:
                place = place[np.diff(group[place], prepend=0) != 0]
            ids[place] = self.made[low[place]]
            stays = np.ones(len(ids), bool)
            stays[place + 1] = False
            ids, at, group, rank = ids[stays], at[stays], group[stays], rank[stays]
            place -= np.arange(len(place))
            fresh = np.concatenate((place, place[place > 0] - 1))
            rank[fresh] = self._rank(ids, group, fresh)
        at, ids = (np.concatenate(x) for x in zip(*ready, strict=True))
        order = np.argsort(at)
        return at[order], ids[order]

    def fragment(self, raw: bytes, last: bool) -> tuple[int, ...]:
        """Ids of one fragment; ``last``: the pre-token ends here."""
        place = np.arange(len(raw))
        ids = self.merged(np.frombuffer(raw, np.uint8), place == 0, (place == len(raw) - 1) & last)[1]
        return tuple(ids.tolist())

    def learn(self, words: list[str | int]) -> list[tuple[int, ...]]:
        """The ids of each word: all are cut at certain cuts, the fragments are
        encoded, and those of a word joined. Special tokens are ids already."""
        raws = [w.encode("utf-8", "surrogatepass") for w in words if isinstance(w, str)]
        flat = np.frombuffer(b"".join(raws), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        begin = np.ones(len(flat), bool)
        begin[1:] = last[:-1] | ~self.joined[flat[:-1], flat[1:]]
        at, ids = self.merged(flat, begin, last)
        cuts, ids = np.searchsorted(at, ends).tolist(), ids.tolist()
        own = (tuple(ids[s:e]) for s, e in zip([0, *cuts], cuts, strict=False))
        return [(w,) if isinstance(w, int) else next(own) for w in words]

    def word(self, word: str) -> tuple[int, ...]:
        return self.learn([word])[0]

    def normal(self, text: str) -> str:
        """Canonical composition, lower case letter by letter (the final form of
        sigma depends on context, so it is not used). White space only separates
        pre-tokens, so it stays as it is."""
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        return (text.replace("Σ", "σ") if "Σ" in text else text).lower()

    def pieces(self, text: str) -> Iterator[str | int]:
        """Pre-tokens in order; special tokens as their ids."""
        at = 0
        for m in self.split.finditer(text) if self.split and "<" in text else ():
            yield from WORDS.findall(self.normal(text[at : m.start()]))
            yield self.special[m[0]]
            at = m.end()
        yield from WORDS.findall(self.normal(text[at:]))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text; the words that are not remembered are learned at once."""
        pieces = [list(self.pieces(t)) for t in texts]
        ids = iter(self.words.find(list(itertools.chain.from_iterable(pieces))))
        return [list(itertools.chain.from_iterable(itertools.islice(ids, len(of)))) for of in pieces]

    def encode(self, text: str | None) -> list[int]:
        return self.encode_all([text or ""])[0]

    def decode(self, ids) -> str:
        """The file names no decoder: tokens stand with one space between."""
        return " ".join(map(self.tokens.__getitem__, ids))


_codecs: dict[str, Codec] = {}


def codec(shared) -> Codec:
    """The worker's codec of a broadcast vocabulary."""
    spec = shared.value
    if spec["name"] not in _codecs:
        _codecs.clear()
        _codecs[spec["name"]] = Codec(spec)
    return _codecs[spec["name"]]


def _shared(df: DataFrame, vocabulary: str):
    """A vocabulary file has a fixed size, whatever the corpus."""
    return df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))


def _lists(ids: list[list[int]]) -> pa.Array:
    at = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int32, count=int(at[-1]))
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat))


def _encoded(own: Codec, texts: list[str | None]) -> list[list[int]]:
    """The ids of the texts, a block of characters at a time."""
    texts = [t or "" for t in texts]
    return [ids for s, e in blocks(texts, TOGETHER) for ids in own.encode_all(texts[s:e])]


def encode(docs: DataFrame, vocabulary: str, text: str = "text", to: str = "ids") -> DataFrame:
    """All columns, and the token ids of the whole text as array<int>."""
    spec = _shared(docs, vocabulary)
    new = T.StructType([T.StructField(to, T.ArrayType(T.IntegerType()))])
    return with_arrays(docs, new, lambda texts: [_lists(_encoded(codec(spec), texts))], text)


def decode(docs: DataFrame, vocabulary: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """All columns, and the text of the ids (null ids: empty)."""
    spec = _shared(docs, vocabulary)
    new = T.StructType([T.StructField(to, T.StringType())])
    return with_arrays(docs, new, lambda lists: [pa.array([codec(spec).decode(x or ()) for x in lists], pa.string())], ids)


def digests(docs: DataFrame, vocabulary: str, with_ids: bool = False, without: tuple[str, ...] = ()) -> DataFrame:
    """All columns but ``without``; n_tokens and digests of the ids and of the
    text decoded from them, and the ids themselves if wanted."""
    spec = _shared(docs, vocabulary)
    new = T.StructType([
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ])
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def make(texts: list[str | None]) -> list[pa.Array]:
        own = codec(spec)
        count, by_ids, by_text, lists = [], [], [], []
        for ids in _encoded(own, texts):
            count.append(len(ids))
            by_ids.append(sha(" ".join(map(own.names.__getitem__, ids))))
            by_text.append(sha(own.decode(ids)))
            if with_ids:
                lists.append(ids)
        out = [pa.array(count, pa.int64()), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())]
        return [*out, _lists(lists)] if with_ids else out

    keep = [c for c in docs.columns if c not in {*new.names, *without}]
    return with_arrays(docs, new, make, "text", keep)
