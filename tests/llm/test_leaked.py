"""The pipeline's decontamination: what the readings of leaked() add."""

from __future__ import annotations

from cadence.llm import templates
from tests.llm.test_templates import ITEMS, QUESTION, SCHEMA


def _leaked(spark, docs, items, **kw):
    d = spark.createDataFrame(list(enumerate(docs)), SCHEMA)
    i = spark.createDataFrame(list(enumerate(items)), ITEMS)
    return {(r.doc_id, r.item_id) for r in templates.leaked(d, i, **kw).collect()}


CLEAN = "Nothing of that kind is here, only some plain words for a while. Alice has 12 apples in another story."


def test_one_inconsistent_slot_costs_its_windows_only(spark):
    mixed = QUESTION.replace("Alice", "Maria", 1)
    equal = QUESTION.replace(" 5 ", " 12 ")  # two numbers become one value
    assert _leaked(spark, [mixed, equal, CLEAN], [QUESTION]) == {(0, 0), (1, 0)}


def test_another_case(spark):
    docs = [f"Intro. {QUESTION.upper()} Outro.", f"intro {QUESTION.lower()}", CLEAN, CLEAN.upper()]
    assert _leaked(spark, docs, [QUESTION]) == {(0, 0), (1, 0)}
    assert _leaked(spark, docs, [QUESTION], most=0) == {(0, 0), (1, 0)}


def test_a_value_is_one_slot(spark):
    item = "the shop in Paris sold 50 pens for 3 dollars and Bob paid 60 km of road with 7 coins on that day"
    other = "the shop in New York sold 1,250 pens for 3.5 dollars and Mary Ann paid 90km of road with 1/2 coins on that day"
    assert _leaked(spark, [f"So {other}.", f"so {item}.", CLEAN], [item]) == {(0, 0), (1, 0)}
    assert _leaked(spark, [f"So {item}."], [other]) == {(0, 0)}


def test_a_long_run_of_a_long_item(spark):
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    item = " ".join(words)
    docs = ["Own words here " + " ".join(words[40 : 40 + n]) + " and more own words" for n in (12, 13, 30)]
    assert _leaked(spark, docs, [item]) == {(1, 0), (2, 0)}
