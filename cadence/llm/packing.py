"""Hierarchical multi-length packing of documents into training sequences.

Every document is its token ids and one end id. Documents are routed to tiers
of context sizes (512 to 4096): of a longer one, full windows of the largest
size go first and the rest is routed; a piece belongs to the smallest tier that
holds it. Each tier is packed, the largest first: a window opens with the
longest piece of its tier, and its gap is filled from the shorter tiers, each
time with the longest piece that fits; where nothing fits any more, the
shortest piece left is cut so that the window is full. So all windows are
full and need no padding, and few documents are cut beyond their length.

Packing takes place where the documents are read: a task packs about
``GROUP_TOKENS`` tokens at a time, so nothing is shuffled and what a task holds
is bounded. The one window of each such group that stays open (all pieces are
used) is handed on, with its ids, to a second packing of the open windows of
many groups; only there a sequence with a gap may remain, one a group.

The sequences are then dealt over step groups (optimiser steps) of about
``step_tokens`` tokens: each tier's sequences, in an order by hash, are spread
evenly, so every step has the same share of every tier, to one sequence. Ranks
are made from counts by hash bucket, so no tier is sorted in one task.

The tokenizer's pre-tokens never cross white space, so a text is encoded in
pieces between spaces, by the library, and pieces are remembered per worker.
Null and empty texts are one end id. Rows are independent: repeated rows and
doc_ids (also null) are packed as documents of their own. The pieces written
are read again by all that follows, so a lost executor repacks nothing that was
used already. Columns beside doc_id and text are ignored. Needs the tokenizers
package on the executors; the vocabulary is read on the driver and broadcast.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.bpe import byte_letters
from cadence.llm.common import saved, workdir

TIERS = (512, 1024, 2048, 4096)
GROUP_TOKENS = 1 << 21
STEP_TOKENS = 1 << 18
#: Pieces of text that a worker remembers, and characters that are split at a time.
MAX_REMEMBERED = 1_000_000
SPLIT_CHARS = 1 << 20
#: Sequences of one tier that one task ranks.
BUCKET = 100_000
#: Ids of sequences of the second packing start here.
SECOND = 1 << 62
#: White space that only some call so; texts with it are split at the plain rest only.
_ODD_SPACE = re.compile("[" + "".join(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \t\n\r") + "]")
_SPACE = re.compile("[ \t\n\r]+")
#: A word of letters whose lower case and composition are plain, and marks that are a pre-token of their own
#: (no apostrophe, which may begin one with letters, and no <, which may begin a special token).
_WORD = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=-@\\[-`{-~]*)")


class Encoder:
    """Token ids of whole texts. The ids of each piece between spaces are
    remembered; a word of Latin letters goes to the library's BPE model, and a
    piece made of one and punctuation is joined from both. All other pieces go
    through the whole library."""

    def __init__(self, spec: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.letters = dict(enumerate(byte_letters()))
        self.end = np.array([end_id], np.uint32)
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {"": 0}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1 << 15, np.int64)  # where the ids of a slot begin in flat; one more: where they end
        self.uses = np.zeros(1 << 15, np.int32)

    def forget_rare(self) -> None:
        """Forgets the pieces of one use, or half of all if few are of one."""
        names, n = list(self.slot), len(self.slot)
        uses = self.uses[:n].copy()
        uses[0] = np.iinfo(np.int32).max
        keep = np.flatnonzero(uses > 1)
        if len(keep) > n // 2:
            keep = np.sort(np.argsort(-uses, kind="stable")[: n // 2])
        keep, ids, sizes = keep[1:], self._joined(keep), np.diff(self.at[: n + 1])[keep[1:]]
        self.forget()
        self._keep([names[k] for k in keep], ids, sizes)

    def _keep(self, names: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        first, used = len(self.slot), int(self.at[len(self.slot)])
        while used + len(ids) > len(self.flat):
            self.flat = np.concatenate((self.flat, np.zeros_like(self.flat)))
        while first + len(names) >= len(self.at):
            self.at = np.concatenate((self.at, np.zeros_like(self.at)))
            self.uses = np.concatenate((self.uses, np.zeros_like(self.uses)))
        self.flat[used : used + len(ids)] = ids
        self.at[first + 1 : first + 1 + len(names)] = used + np.cumsum(sizes)
        self.slot.update(zip(names, range(first, first + len(names)), strict=True))

    def _joined(self, slots: np.ndarray) -> np.ndarray:
        """The ids of these slots, one after the other."""
        begin, size = self.at[slots], self.at[slots + 1] - self.at[slots]
        shift = np.repeat(begin - (np.cumsum(size) - size), size)
        return self.flat[shift + np.arange(len(shift))]

    def _learn(self, new: list[str]) -> None:
        made, words, rest = [], {}, {}
        for piece in new:
            if m := _WORD.fullmatch(piece):
                word, mark = m[1].lower(), m[2]
                words[word] = None
                if mark:
                    rest[mark] = None
                if word != piece:
                    made.append((piece, word, mark))
            else:
                rest[piece] = None
        slot, letters = self.slot, self.letters
        words = [w for w in words if w not in slot]
        rest = [x for x in rest if x not in slot]
        ids = [[t.id for t in self.model.tokenize(w.encode().decode("latin-1").translate(letters))] for w in words]
        if rest:
            ids += [e.ids for e in self.library.encode_batch_fast(rest, add_special_tokens=False)]
        self._keep(words + rest, np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.array([len(x) for x in ids], np.int64))
        if made:
            both = np.array([(slot[w], slot[x]) for _, w, x in made]).ravel()
            sizes = (self.at[both + 1] - self.at[both]).reshape(-1, 2).sum(axis=1)
            self._keep([piece for piece, _, _ in made], self._joined(both), sizes)

    def split(self, text: str) -> Iterator[list[str]]:
        plain = _ODD_SPACE.search(text) is None
        begin = 0
        while begin < len(text):
            found = _SPACE.search(text, begin + SPLIT_CHARS) if len(text) - begin > SPLIT_CHARS else None
            end = found.start() if found else len(text)
            part = text[begin:end]
            yield part.split() if plain else [x for x in _SPACE.split(part) if x]
            begin = end

    def __call__(self, text: str | None) -> np.ndarray:
        """Ids as unsigned 32-bit integers, the end id after them."""
        out = []
        for parts in self.split(text or ""):
            if len(self.slot) + len(parts) > MAX_REMEMBERED:
                self.forget_rare()
            if len(self.slot) + len(parts) > MAX_REMEMBERED:
                self.forget()
            slots = np.fromiter(map(self.slot.get, parts, itertools.repeat(-1)), np.int64, len(parts))
            if len(new := np.flatnonzero(slots < 0)):
                names = [parts[k] for k in new]
                self._learn(list(dict.fromkeys(names)))
                slots[new] = [self.slot[x] for x in names]
            self.uses[slots] += 1
            out.append(self._joined(slots))
        return np.concatenate([*out, self.end])


class Packer:
    """Packs the pieces (owner, start, length) of one group."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers, reverse=True)
        self.waiting: dict[int, list[tuple[int, int]]] = {}
        self.lengths = 0  # bit k: a piece of length k waits
        #: (owner, start, length, sequence, offset)
        self.pieces: list[tuple[int, int, int, int, int]] = []
        self.sizes: list[int] = []  # by sequence, the tier

    def add(self, owner: int, start: int, length: int) -> None:
        """A piece; full windows of the largest tier are sequences at once."""
        most = self.tiers[0]
        while length >= most:
            self.pieces.append((owner, start, most, len(self.sizes), 0))
            self.sizes.append(most)
            start, length = start + most, length - most
        if length:
            self.waiting.setdefault(length, []).append((owner, start))
            self.lengths |= 1 << length

    def _take(self, length: int) -> tuple[int, int]:
        rows = self.waiting[length]
        row = rows.pop()
        if not rows:
            del self.waiting[length]
            self.lengths ^= 1 << length
        return row

    def _longest(self, most: int) -> int:
        return max(0, (self.lengths & ((1 << (most + 1)) - 1)).bit_length() - 1)

    def _shortest(self, above: int) -> int:
        over = self.lengths >> (above + 1)
        return (over & -over).bit_length() + above if over else 0

    def pack(self) -> list[tuple[int, int, int, int, int]]:
        """Packs all that waits; the pieces of the window that stays open, if any."""
        for k, tier in enumerate(self.tiers):
            least = self.tiers[k + 1] if k + 1 < len(self.tiers) else 0
            while (length := self._longest(tier)) > least:
                own, gap = [], tier
                while gap:
                    if length:
                        own.append((*self._take(length), length))
                        gap -= length
                    elif longer := self._shortest(gap):
                        owner, start = self._take(longer)
                        own.append((owner, start, gap))
                        self.add(owner, start + gap, longer - gap)
                        gap = 0
                    else:
                        break
                    length = self._longest(gap)
                offset, sequence = 0, len(self.sizes)
                placed = []
                for owner, start, size in own:
                    placed.append((owner, start, size, sequence, offset))
                    offset += size
                if gap:
                    return placed
                self.pieces += placed
                self.sizes.append(tier)
        return []


_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """The worker's encoder of a broadcast vocabulary."""
    spec, end_id = shared.value
    key = hash((spec, end_id))
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec, end_id)
    return _encoders[key]


_PIECE = [
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    T.StructField("tier", T.IntegerType()), T.StructField("ids", T.BinaryType()),
]


def _columns(pieces, starts, tokens, of, tiers, first: int, with_ids: bool) -> dict:
    """The columns of placed pieces; ``of(owner)``: its ids, from ``starts[owner]`` of its document on."""
    cut = [of(p[0])[p[1] : p[1] + p[2]].astype("<u4").tobytes() for p in pieces]
    return {
        "start": [starts[p[0]] + p[1] for p in pieces], "length": [p[2] for p in pieces], "ids_crc32": [zlib.crc32(x) for x in cut],
        "doc_tokens": [tokens[p[0]] for p in pieces], "sequence_id": [None if tiers is None else first + p[3] for p in pieces],
        "offset": [p[4] for p in pieces], "tier": [None if tiers is None else tiers[p[3]] for p in pieces],
        "ids": cut if with_ids or tiers is None else [None] * len(pieces),
    }


def _first(docs: DataFrame, shared, tiers, group_tokens: int, with_ids: bool) -> DataFrame:
    """The packing of each task's groups. Pieces of open windows have no
    sequence_id and a ``place`` by which the second packing orders them."""
    schema = T.StructType([docs.schema["doc_id"], *_PIECE, T.StructField("place", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = _encoder(shared), TaskContext.get().partitionId()
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        size, first, group, kind = 0, task << 32, 0, None

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal first, group, size
            packer = Packer(tiers)
            for owner, x in enumerate(ids):
                packer.add(owner, 0, len(x))
            left = packer.pack()
            tokens = [len(x) for x in ids]
            doc_ids, starts = pa.concat_arrays(names), [0] * len(ids)
            for pieces, sizes in ((packer.pieces, packer.sizes), (left, None)):
                for k in range(0, len(pieces), 4096):
                    part = pieces[k : k + 4096]
                    made = _columns(part, starts, tokens, ids.__getitem__, sizes, first, with_ids)
                    arrays = [pa.array(made[f.name], kind[f.name]) for f in _PIECE]
                    place = pa.array([(task << 32) + group] * len(part), pa.int64())
                    yield pa.RecordBatch.from_arrays([doc_ids.take(pa.array([p[0] for p in part])), *arrays, place], names=schema.names)
            first, group, size = first + len(packer.sizes), group + 1, 0
            ids.clear()
            names.clear()

        kind = {f.name: pa.int64() for f in _PIECE} | {"tier": pa.int32(), "ids": pa.binary()}
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                names.append(part.column(0))
                for text in part.column(1).to_pylist():
                    ids.append(encode(text))
                    size += len(ids[-1])
                if size >= group_tokens:
                    yield from packed()
        if ids:
            yield from packed()

    return docs.mapInArrow(run, schema)


def _second(left: DataFrame, n_groups: int, tiers, with_ids: bool) -> DataFrame:
    """The open windows of many groups packed again; what then stays open is a sequence with a gap."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "offset"]).reset_index(drop=True)
        of = [np.frombuffer(x, "<u4") for x in rows.ids]
        packer = Packer(tiers)
        for owner, x in enumerate(of):
            packer.add(owner, 0, len(x))
        pieces = packer.pack()
        if pieces:
            most = min(t for t in packer.tiers if t >= sum(p[2] for p in pieces))
            packer.pieces += pieces
            packer.sizes.append(most)
        made = _columns(packer.pieces, rows.start.tolist(), rows.doc_tokens.tolist(), of.__getitem__, packer.sizes, SECOND + (key[0] << 32), with_ids)
        owners = [p[0] for p in packer.pieces]
        return pd.DataFrame({"doc_id": rows.doc_id.take(owners).to_numpy(), **made})

    schema = T.StructType([left.schema["doc_id"], *_PIECE])
    return left.withColumn("group", F.pmod(F.xxhash64("place"), F.lit(n_groups))).groupBy("group").applyInPandas(run, schema)


def _steps(pieces: DataFrame, folder: str, step_tokens: int) -> DataFrame:
    """(sequence_id, step): every tier spread evenly over the steps."""
    mixed = F.xxhash64("sequence_id")
    sequences = saved(pieces.groupBy("sequence_id").agg(F.first("tier").alias("tier"), F.sum("length").alias("tokens")), f"{folder}/sequences")
    n, tokens = sequences.agg(F.count(F.lit(1)), F.coalesce(F.sum("tokens"), F.lit(0))).first()
    n_buckets, n_steps = max(1, -(-n // BUCKET)), max(1, round(tokens / step_tokens))
    sequences = sequences.withColumn("bucket", F.pmod(mixed, F.lit(n_buckets)))
    counts = sequences.groupBy("tier", "bucket").agg(F.count(F.lit(1)).alias("k"))
    tier = Window.partitionBy("tier")  # a row per bucket
    counts = counts.select(
        "tier", "bucket", (F.sum("k").over(tier.orderBy("bucket")) - F.col("k")).alias("before"), F.sum("k").over(tier).alias("all")
    )
    inside = F.row_number().over(Window.partitionBy("tier", "bucket").orderBy(mixed, "sequence_id")) - 1
    step = F.floor((F.col("before") + F.col("inside")) * n_steps / F.col("all"))
    return sequences.withColumn("inside", inside).join(F.broadcast(counts), ["tier", "bucket"]).select("sequence_id", step.cast("long").alias("step"))


def pack(
    docs: DataFrame, vocabulary: str, end_id: int = 2, tiers: tuple[int, ...] = TIERS, with_ids: bool = True,
    step_tokens: int = STEP_TOKENS, group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start and length in its document's ids,
    ids_crc32 (of the ids as little-endian unsigned 32-bit integers), doc_tokens
    (with the end id), sequence_id, offset there, tier (the context size of the
    sequence), step, and the ids in that binary form if wanted (else null)."""
    spark, folder = docs.sparkSession, workdir(docs.sparkSession)
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast((f.read(), end_id))
    first = saved(_first(docs.select("doc_id", "text"), shared, tiers, group_tokens, with_ids), f"{folder}/first")
    left = first.where("sequence_id is null")
    n_groups = max(1, -(-(left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) // group_tokens))
    second = saved(_second(left, n_groups, tiers, with_ids), f"{folder}/second")
    pieces = first.where("sequence_id is not null").drop("place").unionByName(second)
    return pieces.join(_steps(pieces, folder, step_tokens), "sequence_id").select(
        "doc_id", *[f.name for f in _PIECE if f.name != "ids"], "step", "ids"
    )
