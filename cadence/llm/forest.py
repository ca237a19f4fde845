"""Near-duplicate documents by an LSH forest.

A document's set is its distinct shingles of five words (fewer words: the whole
sequence as one). Its signature has ``TREES * STEP`` minimum hashes; tree t
reads it from position ``t * STEP``, round and round, which gives that many
sorted orders. Documents that share a prefix in an order are neighbours there.

*Adaptive depth*: a region (documents with a common prefix) of at most
``REGION`` documents is searched whole; a denser one is linked to its first
document and split by a longer prefix, down to the whole signature. That
connects most of a dense group at about one comparison a document. What it may
miss is then looked for: in every dense region of the first depth, the nodes
outside its largest component are compared with the whole region, in blocks. So
no candidate is dropped for the size of its region.

Copies (equal sets) are one node from the start. Candidates must agree in size
and in a one-byte sketch of the signature, then links are confirmed on full
sets of 64-bit shingle hashes: first a spanning set of candidates, then, once
that is connected, all candidates between different components.

Every step that could meet a hot key counts first (partial sums before the
shuffle) and deals its rows over as many tasks as they need: regions by longer
prefixes or blocks, comparisons by ``FANOUT`` partners. All intermediate tables
are in the shared folder.

Null text, or one without words: an empty set, linked with nothing. A null
doc_id is linked with nothing (component null, kept). Rows that are equal in
doc_id and text are one document; ties go to the smallest doc_id.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.llm.common import SpanHasher, blocks, code_points, is_space, mixed, saved, spans, with_arrays, workdir

SHINGLE = 5
TREES, STEP = 20, 4
HASHES = TREES * STEP
DEPTHS = (4, 8, 16, 32, HASHES)
REGION = 64
FANOUT = 128
BLOCK, OUTSIDERS = 128, 128  # nodes, and nodes outside the main component, that meet in one task
SLACK = 0.15  # a sketch may fall short of the wanted similarity by this much (3.7 standard deviations)
MAX_BROADCAST_KEYS = 1_000_000

_seed = mixed(np.arange(1, 2 * HASHES + 1, dtype=np.uint64))
_times, _plus = _seed[:HASHES] | np.uint64(1), _seed[HASHES:]


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block."""
    flat, at = code_points(texts)
    flat = np.where((flat >= 65) & (flat <= 90), flat + 32, flat).astype(np.uint32)
    begin, end = spans(~is_space(flat))
    word = SpanHasher(flat)(begin, end)
    limit = np.searchsorted(begin, at)
    code = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            code = mixed(code * np.uint64(0x9E3779B97F4A7C15) + word[k : k + len(code)])
    out = []
    for s, e in zip(limit[:-1].tolist(), limit[1:].tolist(), strict=True):
        if e - s >= SHINGLE:
            out.append(np.unique(code[s : e - SHINGLE + 1]))
        elif e > s:
            whole = np.zeros(1, np.uint64)
            with np.errstate(over="ignore"):
                for w in word[s:e]:
                    whole = mixed(whole * np.uint64(0x9E3779B97F4A7C15) + w)
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Minimum hashes (uint32, big-endian bytes sort like numbers) of non-empty sets."""
    flat = np.concatenate(sets)
    at = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out = np.empty((len(sets), HASHES), dtype=">u4")
    with np.errstate(over="ignore"):
        for k in range(HASHES):
            out[:, k] = np.minimum.reduceat((flat * _times[k] + _plus[k]) >> np.uint64(32), at)
    return out


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, _llm_text, n_shingles, node (a hash of the set; null: empty), sig."""

    def make(texts: list[str | None]) -> list[pa.Array]:
        texts = [t or "" for t in texts]
        count, node, sig = [], [], []
        for s, e in blocks(texts):
            sets = shingle_sets(texts[s:e])
            full = [x for x in sets if len(x)]
            rows = iter(signatures(full) if full else ())
            for x in sets:
                count.append(len(x))
                sig.append(next(rows).tobytes() if len(x) else None)
                node.append(int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "big", signed=True) if len(x) else None)
        return [pa.array(count, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())]

    new = T.StructType([
        T.StructField("n_shingles", T.LongType()), T.StructField("node", T.LongType()), T.StructField("sig", T.BinaryType()),
    ])
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("_llm_text"))
    return with_arrays(keyed, new, make, "text", ["doc_id", "_llm_text"])


# ------------------------------------------------------------- candidates


def _prefix(depth: int) -> Column:
    """The key of a document's region in tree t: a hash of the prefix."""
    turned = F.substr(F.concat("sig", "sig"), F.col("t") * (4 * STEP) + 1, F.lit(4 * depth))
    return F.xxhash64("t", turned)


def regions(nodes: DataFrame, folder: str) -> tuple[list[DataFrame], list[DataFrame]]:
    """Per depth: (region, t, node) of the regions of 2 to REGION nodes, and
    (region, t, node, hub) of the denser ones, which go on to the next depth."""
    rows = nodes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t"))
    small, dense = [], []
    for depth in DEPTHS:
        keyed = rows.select("node", "t", _prefix(depth).alias("region"))
        sizes = keyed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
        found = saved(keyed.join(saved(sizes, f"{folder}/sizes{depth}"), "region"), f"{folder}/depth{depth}")
        small.append(found.where(F.col("n") <= REGION).select("region", "t", "node"))
        dense.append(found.where(F.col("n") > REGION).select("region", "t", "node", "hub"))
        if dense[-1].isEmpty():
            break
        rows = dense[-1].select("node", "t").join(nodes.select("node", "sig"), "node")
    return small, dense


def sketch() -> Column:
    """The last byte of every minimum hash."""
    return F.concat(*[F.substring("sig", 4 * k + 4, 1) for k in range(HASHES)])


def _likely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Sketch similarity, and whether the pair may be similar enough."""
    same = (a == b).mean(-1)
    return same, (same >= percent / 100 - SLACK) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))


def _grouped(parts: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames that never break a run of equal keys, from sorted rows."""
    rest = None
    for part in parts:
        if rest is not None:
            part = pd.concat([rest, part], ignore_index=True)
        if not len(part):
            continue
        k = part[key].to_numpy()
        other = np.flatnonzero(k != k[-1])
        cut = int(other[-1]) + 1 if len(other) else 0
        if cut:
            yield part.iloc[:cut]
        rest = part.iloc[cut:]
    if rest is not None and len(rest):
        yield rest


def _marks(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, HASHES)


def spanning_pairs(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b), a < b: of the likely pairs of a region, as many as connect them,
    most alike first. rows: region, node, size, sketch; at most REGION a region."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in _grouped(parts, "region"):
            region, node, size = (part[c].to_numpy() for c in ("region", "node", "size"))
            marks = _marks(part.sketch)
            edge = np.flatnonzero(np.diff(region)) + 1
            got = []
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(region)], strict=True):
                i, j = np.triu_indices(e - s, 1)
                i, j = i + s, j + s
                alike, ok = _likely(marks[i], marks[j], size[i], size[j], percent)
                i, j, alike = i[ok], j[ok], alike[ok]
                top: dict[int, int] = {}
                for k in np.lexsort((np.maximum(node[i], node[j]), np.minimum(node[i], node[j]), -alike)):
                    a, b = i[k], j[k]
                    while a in top:
                        a = top[a]
                    while b in top:
                        b = top[b]
                    if a != b:
                        top[a] = b
                        got.append((node[i[k]], node[j[k]]))
            pairs = np.array(got, dtype=np.int64).reshape(-1, 2)
            yield pd.DataFrame({"a": pairs.min(1), "b": pairs.max(1)})

    dealt = rows.select("region", "node", "size", "sketch").repartition("region").sortWithinPartitions("region")
    return dealt.mapInPandas(run, "a long, b long").distinct()


def star_pairs(stars: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """(node, hub, alike): the likely ones of (node, hub)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            x, y = _marks(p.sketch), _marks(p.hub_sketch)
            alike, ok = _likely(x, y, p["size"].to_numpy(), p.hub_size.to_numpy(), percent)
            yield pd.DataFrame({"node": p.node[ok], "hub": p.hub[ok], "alike": alike[ok]})

    hubs = known.select(F.col("node").alias("hub"), F.col("size").alias("hub_size"), F.col("sketch").alias("hub_sketch"))
    one = stars.join(known.select("node", "size", "sketch"), "node")
    return one.join(hubs, "hub").select("node", "hub", "size", "hub_size", "sketch", "hub_sketch").mapInPandas(
        run, "node long, hub long, alike double"
    )


def dealt_regions(small: DataFrame, dense: DataFrame, folder: str) -> DataFrame:
    """key, t, node, size, comp, role, main: who meets whom in a task.

    A node of role 1 is compared with all of role 0 under its key. In a small
    region all nodes are both; in a dense one, ``main`` is the largest
    component, its blocks have role 0 and the nodes outside of it role 1."""
    columns = ["key", "t", "node", "size", "comp", "role", "crowded", "main"]
    tally = dense.groupBy("region", "comp").agg(F.count(F.lit(1)).alias("c"))
    tally = saved(
        tally.groupBy("region").agg(
            F.sum("c").alias("n"), F.max("c").alias("most"), F.max_by("comp", F.struct("c", "comp")).alias("main")
        ).where("most < n"),
        f"{folder}/dense",
    )
    deal = lambda of, seed, size: F.pmod(F.xxhash64("node", F.lit(seed)), F.ceil(F.col(of) / size))
    every = lambda of, size: F.explode(F.sequence(F.lit(0), (F.ceil(F.col(of) / size) - 1).cast("int")))
    met = dense.join(tally, "region").withColumn("r", F.col("n") - F.col("most"))
    held = met.withColumn("p", every("r", OUTSIDERS)).withColumn("q", deal("n", 1, BLOCK)).withColumn("role", F.lit(0))
    outside = met.where("comp <> main").withColumn("q", every("n", BLOCK)).withColumn("p", deal("r", 2, OUTSIDERS)).withColumn("role", F.lit(1))
    far = held.unionByName(outside).withColumn("key", F.xxhash64("region", F.col("p").cast("long"), F.col("q").cast("long")))
    mixed_up = small.groupBy("region").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x < y").select("region")
    near = small.join(saved(mixed_up, f"{folder}/mixed"), "region").withColumn("key", F.col("region"))
    near = near.withColumn("role", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("main", F.lit(0).cast("long"))
    far, near = far.withColumn("crowded", F.lit(True)), near.withColumn("crowded", F.lit(False))
    return far.select(columns).unionByName(near.select(columns))


def crossing(rows: DataFrame, percent: int) -> DataFrame:
    """(key, x, ys): likely partners of x in other components. rows: see
    :func:`dealt_regions`, with sig for the sketch. A pair is reported in the
    first tree that has it: where the whole first-depth prefix is the same."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, None
        for part in parts:
            key, role, node, size, comp, t = (part[c].to_numpy() for c in ("key", "role", "node", "size", "comp", "t"))
            main, crowded = part.main.to_numpy(), part.crowded.to_numpy()
            sigs = np.frombuffer(b"".join(part.sig), np.uint8).reshape(-1, HASHES, 4)
            marks, trunk = np.ascontiguousarray(sigs[:, :, 3]), sigs.reshape(-1, TREES, 4 * STEP)
            edge = np.flatnonzero((np.diff(key) != 0) | (np.diff(role) != 0)) + 1
            got = []
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), len(key)], strict=True):
                own = (node[s:e], size[s:e], comp[s:e], marks[s:e], trunk[s:e])
                if role[s] == 0:
                    same = now == key[s] and held is not None
                    held = tuple(np.concatenate(x) for x in zip(held, own, strict=True)) if same else own
                    now = key[s]
                    continue
                for a in range(s, e, 64):
                    b = min(a + 64, e)
                    same = marks[a:b, None] == held[3][None]
                    ok = same.mean(-1) >= percent / 100 - SLACK
                    less, more = np.minimum(size[a:b, None], held[1]), np.maximum(size[a:b, None], held[1])
                    ok &= (100 * less >= percent * more) & (comp[a:b, None] != held[2])
                    ok &= (crowded[a:b, None] & (held[2] == main[a:b, None])) | (node[a:b, None] < held[0])
                    i, j = np.nonzero(ok)
                    trees = (trunk[a:b][i] == held[4][j]).all(-1)
                    new = trees.argmax(1) == t[a:b][i]
                    i, j = i[new], j[new]
                    for k in np.unique(i):
                        got.append((key[a], node[a + k], held[0][j[i == k]]))
            yield pd.DataFrame(got, columns=["key", "x", "ys"])

    return rows.repartition("key").sortWithinPartitions("key", "role").mapInPandas(run, "key long, x long, ys array<long>")


# ----------------------------------------------------------- confirmation


def dealt_pairs(pairs: DataFrame, folder: str) -> DataFrame:
    """(key, a, x, ys) of pairs (a, b): a's partners dealt over several tasks."""
    load = saved(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")), f"{folder}/load")
    deal = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / FANOUT))
    dealt = pairs.join(load, "a").select(F.xxhash64("a", deal.cast("long")).alias("key"), "a", F.col("b").alias("x"))
    return saved(dealt.withColumn("ys", F.array("a")), f"{folder}/dealt")


def confirmed(rows: DataFrame, held: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of (key, x, ys) whose full sets are similar enough.

    held: (key, y), all ys of a key: a hub, a region or a block, so they are
    bounded and kept as sets, and the texts of the xs stream past them.
    texts: node, text."""
    held = held.join(texts, held["y"] == texts["node"]).select("key", F.lit(0).alias("role"), "node", F.lit(None).cast("array<long>").alias("ys"), "text")
    passing = rows.join(texts, rows["x"] == texts["node"]).select("key", F.lit(1).alias("role"), "node", "ys", "text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, sets = None, {}
        for p in parts:
            out, rows = [], p.text.tolist()
            key, role, node, ys = p.key.tolist(), p.role.tolist(), p.node.tolist(), p.ys.tolist()
            for s, e in blocks(rows):
                for i, x in enumerate(shingle_sets(rows[s:e]), s):
                    if key[i] != now:
                        now, sets = key[i], {}
                    if role[i] == 0:
                        sets[node[i]] = x
                        continue
                    for y in ys[i]:
                        own = sets[y]
                        if 100 * min(len(own), len(x)) < percent * max(len(own), len(x)):
                            continue
                        both = len(np.intersect1d(own, x, assume_unique=True))
                        if 100 * both >= percent * (len(own) + len(x) - both):
                            out.append((min(y, node[i]), max(y, node[i])))
            yield pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return held.unionAll(passing).repartition("key").sortWithinPartitions("key", "role").mapInPandas(run, "a long, b long")


def components(edges: DataFrame, folder: str) -> DataFrame:
    """node, comp (the least node of its component) for all nodes of edges
    (a, b), by alternating stars: every round links neighbours to the least
    node around, until nothing changes."""
    now = saved(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{folder}/cc0")
    total = lambda e: tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    seen, k = total(now), 0
    while seen[0]:
        k += 1
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{folder}/cc{k}m")
        large = saved(
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(),
            f"{folder}/cc{k}l",
        )
        # every v < u now: all smaller neighbours of u, and u itself, go to the least
        low = saved(large.groupBy("u").agg(F.min("v").alias("m")), f"{folder}/cc{k}s")
        now = saved(
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            f"{folder}/cc{k}",
        )
        after = total(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))


# ---------------------------------------------------------------- operator


def linked(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, _llm_text, n_shingles, component_id for every row of docs.

    Two documents are linked when 100 * intersection >= percent * union."""
    folder = workdir(docs.sparkSession)
    sigs = saved(signed(docs), f"{folder}/signed")
    nodes = saved(
        sigs.where("node is not null and doc_id is not null").groupBy("node").agg(
            F.min(F.struct("doc_id", "_llm_text")).alias("first"), F.count(F.lit(1)).alias("n_docs"),
            F.min("n_shingles").alias("size"), F.min("sig").alias("sig"),
        ),
        f"{folder}/nodes",
    )
    known = nodes.select("node", "size", sketch().alias("sketch"))
    small, dense = regions(nodes, folder)
    union = lambda frames: functools.reduce(DataFrame.unionAll, frames)
    inside = saved(union([x.withColumn("depth", F.lit(k)) for k, x in enumerate(small)]).join(known, "node"), f"{folder}/regions")
    crowd = saved(dense[0].drop("hub").join(known, "node"), f"{folder}/crowds")
    stars = saved(union(dense).where("node <> hub").select("node", "hub").distinct(), f"{folder}/stars")
    likely = star_pairs(stars, known, percent)
    # a spanning set of every region, and each node's most alike hub
    best = likely.groupBy("node").agg(F.max(F.struct("alike", (-F.col("hub")).alias("h"))).alias("m"))
    best = best.select(F.least("node", -F.col("m.h")).alias("a"), F.greatest("node", -F.col("m.h")).alias("b"))
    first = saved(spanning_pairs(inside, percent).unionAll(best).distinct(), f"{folder}/pairs")
    need = inside.select("node").unionAll(crowd.select("node")).distinct()
    places = saved(need.join(nodes, "node").select("node", "first.doc_id", "first._llm_text"), f"{folder}/places")
    if places.count() <= MAX_BROADCAST_KEYS:
        places = F.broadcast(places)
    texts = saved(
        docs.where("text is not null").select("doc_id", "text", F.xxhash64("text").alias("_llm_text"))
        .join(places, ["doc_id", "_llm_text"]).select("node", "text"),
        f"{folder}/texts",
    )
    pairs = dealt_pairs(first, folder)
    held = pairs.select("key", F.col("a").alias("y")).distinct()
    links = saved(confirmed(pairs.drop("a"), held, texts, percent), f"{folder}/links")
    one = components(links, f"{folder}/first")
    # all other candidates between different components
    part_of = lambda rows: rows.join(one, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    meeting = dealt_regions(
        saved(part_of(inside.where("depth = 0").drop("depth")), f"{folder}/near"), saved(part_of(crowd), f"{folder}/far"), folder
    )
    across = saved(crossing(meeting.join(nodes.select("node", "sig"), "node"), percent), f"{folder}/crossing")
    held = meeting.where("role = 0").select("key", F.col("node").alias("y"))
    held = held.join(saved(across.select("key").distinct(), f"{folder}/keys"), "key", "left_semi")
    more = confirmed(across, held, texts, percent)
    label = lambda x: one.select(F.col("node").alias(x), F.col("comp").alias(f"{x}_comp"))
    more = more.join(label("a"), "a", "left").join(label("b"), "b", "left")
    more = saved(more.select(F.coalesce("a_comp", "a").alias("a"), F.coalesce("b_comp", "b").alias("b")).distinct(), f"{folder}/more")
    two = components(more, f"{folder}/second")
    two = two.select(F.col("node").alias("comp"), F.col("comp").alias("top"))
    members = nodes.select("node", F.col("first.doc_id").alias("doc_id"), "n_docs").join(one, "node", "left")
    members = members.withColumn("comp", F.coalesce("comp", "node")).join(two, "comp", "left")
    members = saved(members.select("node", "doc_id", "n_docs", F.coalesce("top", "comp").alias("top")), f"{folder}/members")
    ids = members.groupBy("top").agg(F.min("doc_id").alias("component_id"), F.sum("n_docs").alias("n")).where("n > 1")
    found = members.join(saved(ids, f"{folder}/ids"), "top").select("node", "component_id")
    out = sigs.drop("sig").join(found, "node", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "_llm_text", "n_shingles", own.alias("component_id"))


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (doc_id = component_id; a null
    doc_id is kept) for every row."""
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    return linked(docs, percent).withColumn("kept", kept).drop("_llm_text")


def without_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of docs that are the first of their component, all columns."""
    folder = workdir(docs.sparkSession)
    gone = linked(docs.select("doc_id", "text"), percent).where("doc_id <> component_id")
    gone = saved(gone.select("doc_id", F.col("_llm_text")).distinct(), f"{folder}/gone")
    keyed = docs.withColumn("_llm_text", F.xxhash64("text"))
    out = F.broadcast(gone) if gone.count() <= MAX_BROADCAST_KEYS else gone
    return keyed.join(out, ["doc_id", "_llm_text"], "left_anti").select(docs.columns)
