"""Reply trees: paths against brute force, ranking, reversible formatting."""

from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from cadence.llm import chat

ODD = st.lists(st.sampled_from(["</s>", "[INST]", "[/INST]", "<|turn|>", "<|end|>\n", "\\", "\\\\", "<", "|", "<s>", "<<SYS>>", "é", "\n", " a"]), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant"]), ODD), ODD), max_size=6))
def test_formatting_is_reversible(turns):
    text, spans = chat.formatted([r for r, _ in turns], [t for _, t in turns])
    assert chat.parsed(text) == turns
    assert "".join(chat.unescaped(text[b:e]) for b, e in spans) == "".join(t for r, t in turns if r == "assistant")
    bare = text.replace(chat.TURN, "\0").replace(chat.TEXT, "\0").replace(chat.END, "\0")
    assert not any(c in bare for c in chat.CONTROL)


def test_paths_and_ranks_equal_brute_force(spark):
    rnd = random.Random(3)
    rows = []
    for conv in (1, 2, 3, None):
        for node in range(1, 25):
            parent = rnd.choice([None, 999, *range(1, node)]) if node > 1 else None
            if conv == 2:
                parent = node - 1 or None  # one long chain
            rows.append((conv, node, parent, "user", f"t{node}", float(rnd.randint(0, 3)), "x"))
    table = spark.createDataFrame(rows, "conv_id long, node_id long, parent_id long, role string, text string, score double, leaf string")
    expect = {}
    for conv in (1, 2, 3, None):
        own = {n: (p, s) for c, n, p, _, _, s, _ in rows if c == conv}
        inner = {p for p, _ in own.values() if p in own}
        for leaf in own.keys() - inner:
            path, at = [], leaf
            while at in own:
                path.append(at)
                at = own[at][0]
            expect[conv, leaf] = (path[::-1], sum(own[n][1] for n in path))
    got = chat.format_trees(table).collect()
    assert len(got) == len(expect)
    for r in got:
        path, score = expect[r.conv_id, r.leaf]
        assert [t for _, t in chat.parsed(r.conversation)] == [f"t{n}" for n in path] and r.score == score
    best = {(r.conv_id, r.rank): r.leaf for r in chat.format_trees(table, top=2).collect()}
    for conv in (1, 2, 3, None):
        order = sorted((-s, leaf) for (c, leaf), (_, s) in expect.items() if c == conv)
        assert [best.get((conv, k + 1)) for k in range(2)] == [x for _, x in order[:2]] + [None] * (2 - len(order[:2]))


def test_defined_cases(spark):
    schema = "conv_id long, node_id long, parent_id long, role string, text string"
    rows = [
        (1, 1, 2, "user", "cycle"), (1, 2, 1, None, None),  # 1 -> 2 would be a cycle: 1 is a root
        (2, 5, 5, "user", "self"), (3, 1, None, "b", "later"), (3, 1, None, "a", "first"), (4, None, None, "user", "nowhere"),
    ]
    got = {r.conv_id: chat.parsed(r.conversation) for r in chat.format_trees(spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: [("user", "cycle"), ("", "")], 2: [("user", "self")], 3: [("a", "first")]}
    assert chat.format_trees(spark.createDataFrame([], schema)).count() == 0


def test_chains_keep_every_row_in_turn_order(spark):
    rows = [(7, 2, "assistant", "c"), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, None, "user", "z"), (8, 0, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_trees(chat.as_chains(table))).collect()}
    assert got[7].n_turns == 4 and got[7].loss_chars == 1 and got[8].n_turns == 1 and got[8].loss_chars == 0
