"""Shared helpers of the training-data operators: the shared scratch folder,
bounded labelled samples, and vectorised text hashing inside tasks.

Text hashing works on code points with ``numpy``; every function takes a block
of texts whose total length is bounded by :func:`blocks` (one longer text forms
a block of its own), so the memory of a task does not depend on batch sizes.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.session import scratch_dir

BLOCK_CHARS = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


# ---------------------------------------------------------------- Spark side


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workdir(spark: SparkSession) -> str:
    """A fresh folder below the shared scratch folder (``spark.checkpoint.dir``)."""
    return f"{scratch_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage,
    survives the loss of any executor."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


#: Keys of documents that may be broadcast to prune a scan (8 bytes each); beyond, the same rows are found by a shuffled join.
MAX_PRUNING_KEYS = 2_000_000


#: The operators' own columns beside those of an input begin with ``_llm_``.
KEY = "_llm_key"


def pruned(docs: DataFrame, keys: DataFrame, n_keys: int, how: str) -> DataFrame:
    """Semi or anti join of docs on the row key with a set of known size."""
    return docs.join(F.broadcast(keys) if n_keys <= MAX_PRUNING_KEYS else keys, KEY, how)


def in_fold(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id as text, modulo ``mod``, equals ``rest`` (null id: no)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(mod)) == rest, F.lit(False))


def bounded_sample(rows: DataFrame, key: str, most: int) -> DataFrame:
    """About ``most`` rows (all, if there are fewer), chosen by a hash of
    ``key``: a fraction derived from one count, so no task or driver ever
    gathers more, at any input size."""
    n = rows.count()
    if n <= most:
        return rows
    share = int(most / n * (1 << 30))
    return rows.where(F.pmod(F.xxhash64(F.col(key), F.lit(17)), F.lit(1 << 30)) < share)


def labelled_texts(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int, max_chars: int
) -> tuple[list[str], np.ndarray]:
    """A bounded training sample: whole texts of at most ``max_chars``.

    ``labels`` has doc_id and ``label``; ``train`` is a condition on doc_id.
    Repeated label rows count once; null labels are left out. The sampled
    labels are at most about ``most`` rows (a bound, not data size), so they
    may be broadcast to the scan of the texts. Of a repeated doc_id the least
    text is taken before anything is collected.
    """
    lab = (
        labels.select("doc_id", F.col(label).alias("_y"))
        .where(F.col("_y").isNotNull() & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id").agg(F.max("_y").alias("_y"))
    )
    picked = bounded_sample(lab, "doc_id", most)
    got = (
        docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
        .join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("_y").alias("_y"))
        .toPandas().sort_values("doc_id")
    )
    return got.text.tolist(), got._y.to_numpy()


ROWS = 256


def with_arrays(
    docs: DataFrame, new: T.StructType, make: Callable[[list], list[pa.Array]], column: str, keep: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of docs (None: all that ``new`` does not replace) and
    the ``new`` ones, made from the values of ``column`` a few rows at a time:
    what a task holds does not depend on batch sizes."""
    keep = [c for c in docs.columns if c not in new.names] if keep is None else keep
    docs = docs.select(*dict.fromkeys([*keep, column]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                arrays = make(part.column(column).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), *arrays], names=[*keep, *new.names])

    return docs.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *new.fields]))


# ---------------------------------------------------------------- task side


def blocks(texts: Sequence[str], most: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` characters in all (or a single text)."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def code_points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line feed after each, and the offset at
    which each text begins (with one more at the end)."""
    flat = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) <= n:
        with np.errstate(over="ignore"):
            steps = np.full(max(n, BLOCK_CHARS * 2) + 1, base, dtype=np.uint64)
            steps[0] = 1
            have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[: n + 1]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that every bit of the result is usable."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class SpanHasher:
    """64-bit hashes of any spans of one code-point array, by prefix sums of a
    polynomial modulo 2**64 whose base is odd (so it has an inverse)."""

    def __init__(self, flat: np.ndarray):
        n = len(flat)
        with np.errstate(over="ignore"):
            terms = (flat.astype(np.uint64) + np.uint64(0x1F3)) * _power(_BASE, n)[:n]
            self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))
        self.inverse = _power(_BASE_INV, n)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


_space = np.zeros(34, bool)
_space[[9, 10, 11, 12, 13, 32]] = True


def is_space(flat: np.ndarray) -> np.ndarray:
    """Space and the controls from 09 to 0D, no other character."""
    return _space[np.minimum(flat, 33)]


_letters: list[np.ndarray] = []


def is_letter(flat: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x20000)]))
    return _letters[0][np.minimum(flat, 0x1FFFF)]


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
