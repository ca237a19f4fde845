"""Template decontamination: re-parameterised questions, slots, odd inputs."""

from __future__ import annotations

import random

from cadence.llm import templates

QUESTION = "Alice has 12 apples and gives 5 of her apples to Bob before lunch, how many apples does Alice still have?"
SCHEMA = "doc_id long, text string"
ITEMS = "item_id long, text string"


def _found(spark, docs, items, **kw):
    d = spark.createDataFrame(list(enumerate(docs)), SCHEMA)
    i = spark.createDataFrame(list(enumerate(items)), ITEMS)
    return {(r.doc_id, r.item_id): r for r in templates.contaminated(d, i, **kw).collect()}


def test_other_numbers_and_names_are_caught_if_consistent(spark):
    other = QUESTION.replace("Alice", "Maria").replace("Bob", "Tom").replace("12", "40").replace(" 5 ", " 7 ")
    mixed = QUESTION.replace("Alice", "Maria", 1)  # one of two mentions: no consistent replacement
    merged = QUESTION.replace("Alice", "Bob")  # two fillers share one
    docs = [f"Intro text. {QUESTION} Outro.", f"So {other} Yes.", mixed, merged, "Nothing of that kind is here, only some plain words for a while."]
    got = _found(spark, docs, [QUESTION])
    assert set(got) == {(0, 0), (1, 0)}
    assert got[0, 0].changed == 0 and got[1, 0].changed >= 4


def test_units_punctuation_and_spacing(spark):
    item = "a train travels 60 miles in two hours and then it stops for 10 minutes at the station"
    doc = "A note: a train travels 90 km in two hours,\n and then it stops   for 15 seconds at the station!"
    assert set(_found(spark, [doc], [item])) == {(0, 0)}


def test_short_items_and_both_join_paths(spark):
    rnd = random.Random(2)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    items = [" ".join(rnd.choice(words) for _ in range(n)) for n in (5, 6, 8, 20, 30, 45)] + ["One Two Three", "", None]
    docs = [" ".join(rnd.choice(words) for _ in range(40)) for _ in range(30)]
    for k, item in enumerate(items[:6]):
        w = docs[k].split()
        docs[k] = " ".join(w[:10] + item.split() + w[10:])
        docs[k + 10] = " ".join(w[:10] + item.split()[: len(item.split()) // 3] + w[10:])  # a third: not enough
    docs += ["", None, "wa" * 50_000, " ".join(docs[:6]) * 20]
    one = _found(spark, docs, items)
    assert {(k, k) for k in range(6)} <= set(one) and {(33, k) for k in range(6)} <= set(one)
    assert not any(d in range(12, 16) for d, _ in one)
    assert set(_found(spark, docs, items, most=0)) == set(one)


def test_stage_drops_only_contaminated_rows(spark):
    rows = [(1, f"x {QUESTION}", "s"), (1, f"x {QUESTION}", "s"), (None, f"y {QUESTION}", "s"), (2, None, "s"), (3, "", None), (4, "clean", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    items = spark.createDataFrame([(0, QUESTION), (0, QUESTION), (None, "clean"), (2, None)], ITEMS)
    out = templates.decontaminated(docs, items)
    assert out.columns == docs.columns and sorted((r.doc_id for r in out.collect())) == [2, 3, 4]
    assert templates.decontaminated(docs.limit(0), items).count() == 0
    assert templates.decontaminated(docs, items.limit(0)).count() == 6
