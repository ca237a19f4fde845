"""Reply trees formatted as conversations.

Messages form trees (``parent_id``); every root-to-leaf path is one possible
conversation. Paths are enumerated by iterative self-joins with doubling steps:
after round k a node knows its ancestor 2**k levels up, and a leaf knows its
2**k nearest ancestors, so a chain of n messages takes log2(n) rounds. Branches
are ranked by the sum of their message scores and each chosen path is formatted
as one text with turn marks and loss spans.

Defined cases: a missing parent, one outside the conversation, and one that does
not precede its child (``parent_id >= node_id``, which would allow cycles) make
a root. Null role, text or score: empty, empty, 0. Rows with equal (conv_id,
node_id): the first by role, then text, stays. A null conv_id is a conversation
of its own; rows without node_id are in no tree. Ties in rank: the smaller
leaf first. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import saved, workdir

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
LEARNED_ROLE = "assistant"
# Strings that chat templates in use treat as control strings.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

_control = re.compile("|".join(map(re.escape, CONTROL)))
_turns = re.compile(rf"{re.escape(TURN)}(.*?){re.escape(TEXT)}(.*?){re.escape(END)}\n", re.S)


def escaped(text: str) -> str:
    """Backslashes doubled, and one inside each control string."""
    return _control.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def formatted(roles: list[str], texts: list[str]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation as one text, and the spans (code points) that count
    for the loss: each assistant text."""
    out, spans, at = [], [], 0
    for role, text in zip(roles, texts, strict=True):
        head, body = f"{TURN}{escaped(role)}{TEXT}", escaped(text)
        if role == LEARNED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def parsed(conversation: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted conversation."""
    return [(unescaped(r), unescaped(t)) for r, t in _turns.findall(conversation)]


def _same(a: DataFrame, x: str, b: DataFrame, y: str) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"]) & (a[x] == b[y])


def tree_nodes(messages: DataFrame) -> DataFrame:
    """conv_id, node_id, parent_id (null: root), role, text, score."""
    first = Window.partitionBy("conv_id", "node_id").orderBy("_r", "_t")
    score = F.col("score").cast("double") if "score" in messages.columns else F.lit(0.0)
    return (
        messages.where(F.col("node_id").isNotNull())
        .select(
            "conv_id", F.col("node_id").cast("long").alias("node_id"),
            F.when(F.col("parent_id") < F.col("node_id"), F.col("parent_id").cast("long")).alias("parent_id"),
            F.coalesce("role", F.lit("")).alias("_r"), F.coalesce("text", F.lit("")).alias("_t"),
            F.coalesce(score, F.lit(0.0)).alias("score"),
        )
        .withColumn("_n", F.row_number().over(first)).where("_n = 1")
        .select("conv_id", "node_id", "parent_id", F.col("_r").alias("role"), F.col("_t").alias("text"), "score")
    )


def paths(nodes: DataFrame, folder: str) -> DataFrame:
    """conv_id, leaf, node_id, up: every node of every root-to-leaf path, and
    its distance from the leaf."""
    spark = nodes.sparkSession
    ids = nodes.select("conv_id", "node_id")
    links = nodes.where("parent_id is not null").select("conv_id", F.col("node_id").alias("child"), "parent_id")
    jump = saved(  # child -> its ancestor 2**k levels up
        links.join(ids, _same(links, "parent_id", ids, "node_id"), "left_semi")
        .select("conv_id", "child", F.col("parent_id").alias("anc")),
        f"{folder}/jump0",
    )
    inner = jump.select("conv_id", "anc").distinct()
    leaves = ids.join(inner, _same(ids, "node_id", inner, "anc"), "left_anti")
    parts = [f"{folder}/paths0"]
    known = saved(leaves.select("conv_id", F.col("node_id").alias("leaf"), "node_id", F.lit(0).alias("up")), parts[0])
    k = 0
    while not jump.isEmpty():
        more = (
            known.join(jump, _same(known, "node_id", jump, "child"))
            .select(known["conv_id"], "leaf", jump["anc"].alias("node_id"), (F.col("up") + (1 << k)).cast("int").alias("up"))
        )
        parts.append(f"{folder}/paths{k + 1}")
        saved(more, parts[-1])
        known = spark.read.schema(known.schema).parquet(*parts)
        a, b = jump.alias("a"), jump.alias("b")
        twice = a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.anc") == F.col("b.child")))
        k += 1
        jump = saved(twice.select("a.conv_id", "a.child", "b.anc"), f"{folder}/jump{k}")
    return known


def format_trees(messages: DataFrame, top: int | None = None) -> DataFrame:
    """One row per chosen path: conv_id, leaf, rank, score, n_turns,
    conversation, loss_spans (array of begin, end). ``top``: paths to keep per
    conversation, best first (None: all)."""
    folder = workdir(messages.sparkSession)
    nodes = saved(tree_nodes(messages), f"{folder}/nodes")
    steps = paths(nodes, folder)
    full = (
        steps.join(nodes, _same(steps, "node_id", nodes, "node_id"))
        .select(steps["conv_id"], "leaf", "up", "role", "text", "score")
        .groupBy("conv_id", "leaf")
        .agg(
            F.sum("score").alias("score"),
            F.sort_array(F.collect_list(F.struct("up", "role", "text")), asc=False).alias("turns"),
        )
    )
    if top is not None:
        best = Window.partitionBy("conv_id").orderBy(F.col("score").desc(), "leaf")
        full = full.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    else:
        full = full.withColumn("rank", F.lit(None).cast("int"))

    def render(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in parts:
            done = [formatted([t["role"] for t in x], [t["text"] for t in x]) for x in column]
            yield pd.DataFrame({
                "n_turns": [len(x) for x in column], "conversation": pd.Series([c for c, _ in done], dtype=object),
                "loss_spans": pd.Series([[{"begin": b, "end": e} for b, e in s] for _, s in done], dtype=object),
            })

    shape = F.pandas_udf(render, "n_turns long, conversation string, loss_spans array<struct<begin: int, end: int>>")
    return full.withColumn("c", shape("turns")).select("conv_id", "leaf", "rank", "score", "c.*")


def as_chains(conversations: DataFrame) -> DataFrame:
    """A table of turns as trees with one branch each: every row, in order of
    turn (nulls first, then role and text), answers the row before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select("conv_id", "turn", "role", "text").withColumn(
        "node_id", F.row_number().over(order).cast("long")
    ).withColumn("parent_id", F.nullif(F.col("node_id") - 1, F.lit(0)))


def read_back(chats: DataFrame) -> DataFrame:
    """What the formatted conversations say when they are parsed again."""

    def read(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        sha = lambda s: hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()
        for texts, marks in parts:
            rows = []
            for text, spans in zip(texts, marks, strict=True):
                turns = parsed(text)
                learned = "".join(unescaped(text[s["begin"] : s["end"]]) for s in spans)
                rows.append((len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned), len(text)))
            yield pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    kind = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return chats.withColumn("r", F.pandas_udf(read, kind)("conversation", "loss_spans")).select("conv_id", "r.*")
