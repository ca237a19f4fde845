"""Ranked lexical search with presence-mask grouping.

Each item (a short text) asks for the documents that score highest on its
terms. One pass over the documents counts their terms and keeps, per document,
those that any item asks for (position in the items' term list, occurrences);
the corpus counts follow from that table. A second pass ranks it in blocks of
documents: a bitmap per term says which documents of the block hold it; read
across an item's terms, the bitmaps give every document its *mask* of matched
terms, and documents with equal masks are a group. The most that a mask can
score is the sum of its terms' best contributions in the block. Groups are
evaluated by descending maximum, until it is below the least of the scores kept
for the item: all other documents are safely left out (a group whose maximum
equals that score is still evaluated, for the tie goes by doc_id). The scores
kept by each task are merged.

What a task holds is bounded: a block of documents, the items' terms, and the
best rows of each item. Items are dealt over as many rounds as their terms need
(``MAX_TERMS``), each a pass over the documents, so nothing depends on their number.

A score is the sum, over the item's distinct terms, of
``w * ((1000000000 * tf) div (1000 * tf + 20 * m))`` with
``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and
``m = 50 + (50 * n * N) div L``: N documents have a term, L terms in all, n in
this document, df documents hold the term, tf times in this one. Integers have
64 bits; only the logarithm is taken in doubles.

Null and empty texts have no terms: such documents are not ranked, such items
return nothing. Rows of one item_id count as one item with the terms of all of
them; null is an item_id like others. Each row of docs is a document of its
own: rows with the same doc_id are ranked beside each other. Null doc_ids go last
among equal scores. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import saved, workdir

BEST = 50
#: Terms of the items that one round broadcasts.
MAX_TERMS = 200_000
#: Documents of a block, and entries (documents x asked terms) of its table of contributions.
BLOCK_ROWS = 2048
BLOCK_CELLS = 1 << 23
#: Documents of equal or lower masks that are evaluated at a time.
STEP = 64
_NO_ID = 1 << 63

# The ASCII characters that are part of terms, and their lower case.
_IN_TERM = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_FOLD = bytes(c if c >= 0x80 else ord(chr(c).lower()) if c in _IN_TERM else 0x20 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8: A-Z in lower case only."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term binary): the distinct terms of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                if found := sorted(set(terms(text))):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item.as_py()] * len(found), batch.schema.field(0).type), pa.array(found, pa.binary())], names=["item_id", "term"]
                    )

    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.BinaryType())])
    return items.select("item_id", "text").mapInArrow(run, schema).distinct()


def _asked(docs: DataFrame, codes) -> DataFrame:
    """doc_id, n (terms of the text, with repeats), and the asked terms found
    in it: ``at`` (their codes) and ``tf``. Documents without any term are left out."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n", T.LongType()),
        T.StructField("at", T.ArrayType(T.IntegerType())), T.StructField("tf", T.ArrayType(T.IntegerType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codes.value
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                n, ends, at, tf = [], [0], [], []
                for text in part.column(1).to_pylist():
                    found = terms(text)
                    n.append(len(found))
                    for term, k in Counter(found).items():
                        if (c := code.get(term)) is not None:
                            at.append(c)
                            tf.append(k)
                    ends.append(len(at))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (at, tf)]
                made = pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), *lists], names=schema.names)
                yield made.filter(pa.array(np.array(n) > 0))

    return docs.select("doc_id", "text").mapInArrow(run, schema)


class Ranker:
    """The best documents of each item, over the blocks that are added."""

    def __init__(self, wanted: list[np.ndarray], weight: np.ndarray, n_docs: int, n_terms: int, best: int):
        self.wanted, self.weight, self.n_docs, self.n_terms, self.best = wanted, weight, n_docs, n_terms, best
        #: by item, a heap of (score, -doc_id): the least on top
        self.kept: list[list[tuple[int, int]]] = [[] for _ in wanted]
        self.evaluated = 0

    def add(self, ids: np.ndarray, n: np.ndarray, ends: np.ndarray, at: np.ndarray, tf: np.ndarray) -> None:
        m = 50 + (50 * n * self.n_docs) // self.n_terms
        row = np.repeat(np.arange(len(n)), np.diff(ends))
        tf = tf.astype(np.int64)
        part = (1_000_000_000 * tf) // (1000 * tf + 20 * m[row])
        here, column = np.unique(at, return_inverse=True)
        table = np.zeros((len(n), len(here)), np.int32)
        table[row, column] = part
        bitmaps = np.packbits(table > 0, axis=0)  # by term: the documents that hold it
        most = table.max(axis=0, initial=0).astype(np.int64) * self.weight[here]
        for item, wanted in enumerate(self.wanted):
            where = np.searchsorted(here, wanted)
            where = where[(where < len(here)) & (here[np.minimum(where, len(here) - 1)] == wanted)] if len(here) else where[:0]
            if len(where):
                self._rank(item, ids, table, where, bitmaps[:, where], most[where], self.weight[here[where]])

    def _rank(self, item: int, ids, table, where, bitmaps, most, weight) -> None:
        """One item in one block: ``where`` are the columns of its terms."""
        held = np.unpackbits(bitmaps, axis=0, count=len(ids))
        packed = np.packbits(held, axis=1)  # by document: the mask of its terms
        words = np.zeros((len(ids), -(-packed.shape[1] // 8) * 8), np.uint8)
        words[:, : packed.shape[1]] = packed
        masks = words.view(np.uint64)
        order = np.lexsort(masks.T) if masks.shape[1] > 1 else np.argsort(masks[:, 0], kind="stable")
        sorted_ = masks[order]
        first = np.flatnonzero(np.concatenate(([True], (sorted_[1:] != sorted_[:-1]).any(axis=1))))
        highest = held[order[first]].astype(np.int64) @ most
        sizes = np.diff(np.append(first, len(ids)))
        heap, group = self.kept[item], np.argsort(-highest, kind="stable")
        group = group[highest[group] > 0]
        k = 0
        while k < len(group):
            least = heap[0][0] if len(heap) == self.best else 1
            if highest[group[k]] < least:
                return
            chosen, rows = [], 0
            while k < len(group) and rows < STEP and highest[group[k]] >= least:
                chosen.append(order[first[group[k]] : first[group[k]] + sizes[group[k]]])
                rows += sizes[group[k]]
                k += 1
            docs = np.concatenate(chosen)
            self.evaluated += len(docs)
            scores = table[np.ix_(docs, where)].astype(np.int64) @ weight
            if len(heap) == self.best:
                docs, scores = docs[scores >= least], scores[scores >= least]
            for score, doc in zip(scores.tolist(), ids[docs].tolist(), strict=True):
                if score <= 0:
                    continue
                if len(heap) < self.best:
                    heapq.heappush(heap, (score, -doc))
                elif (score, -doc) > heap[0]:
                    heapq.heapreplace(heap, (score, -doc))


def _best_of_task(asked: DataFrame, shared, best: int) -> DataFrame:
    """(item int, doc_id, score): the best of each item among a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, weight, n_docs, n_terms = shared.value
        ranker = Ranker(wanted, weight, n_docs, n_terms, best)
        rows = max(1, min(BLOCK_ROWS, BLOCK_CELLS // max(1, len(weight))))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                ids, n, at, tf = (batch.slice(start, rows).column(i) for i in range(4))
                ids = np.array([_NO_ID if x is None else x for x in ids.to_pylist()], object if ids.null_count else np.int64)
                ends = np.concatenate(([0], np.cumsum(at.value_lengths().to_numpy(zero_copy_only=False))))
                ranker.add(ids, n.to_numpy(), ends, at.flatten().to_numpy(), tf.flatten().to_numpy())
        for item, heap in enumerate(ranker.kept):
            if heap:
                found = [None if -d == _NO_ID else -d for _, d in heap]
                arrays = [pa.array([item] * len(heap), pa.int32()), pa.array(found, pa.int64()), pa.array([s for s, _ in heap], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    return asked.select("doc_id", "n", "at", "tf").mapInArrow(run, "item int, doc_id long, score long")


def _round(docs: DataFrame, pairs: DataFrame, id_type: T.DataType, best: int, folder: str) -> DataFrame:
    """One round: ``pairs`` (item_id, term) has about ``MAX_TERMS`` rows at most."""
    spark = docs.sparkSession
    rows = pairs.collect()
    codes = {t: i for i, t in enumerate(sorted({bytes(r.term) for r in rows}))}
    by_item: dict = {}
    for r in rows:
        by_item.setdefault(r.item_id, []).append(codes[bytes(r.term)])
    names = list(by_item)
    asked = saved(_asked(docs, spark.sparkContext.broadcast(codes)), f"{folder}/asked")
    n_docs, n_terms = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(codes), np.int64)
    for r in asked.select(F.explode("at").alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("df")).collect():  # a row per asked term
        df[r["at"]] = r["df"]
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    shared = spark.sparkContext.broadcast(([np.array(sorted(by_item[x]), np.int64) for x in names], weight, n_docs, n_terms))
    found = saved(_best_of_task(asked, shared, best), f"{folder}/found")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    ids = spark.createDataFrame(list(enumerate(names)), T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", id_type)]))
    return ranked.join(F.broadcast(ids), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents (doc_id long,
    text) of each item (item_id, text) with a score above 0."""
    spark, folder = docs.sparkSession, workdir(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pairs = saved(item_terms(items), f"{folder}/items")
    rounds = max(1, math.ceil(pairs.count() / MAX_TERMS))
    out = None
    for k in range(rounds):
        own = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == k) if rounds > 1 else pairs
        ranked = _round(docs, own, items.schema["item_id"].dataType, best, f"{folder}/round-{k}")
        out = ranked if out is None else out.unionByName(ranked)
    return out
