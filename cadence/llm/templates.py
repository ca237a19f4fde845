"""Benchmark decontamination by templates (DataFrame functions only).

Texts become templates: their words (runs of letters and digits) with typed
placeholders for those that begin with a capital letter (names) or a digit
(numbers), and for unit words after a number. Every window of ``WINDOW`` template
words of the benchmark is looked up in all documents: its most literal run of
``ANCHOR`` words is hash-joined with all such runs, then the window is compared
word by word, so a question with other numbers, names or units still meets its
original. The slots of one alignment must be consistent: each original filler
has one replacement, and no two fillers share one. A document is contaminated by
an item when consistent windows cover ``COVER`` of the item's windows.

An item shorter than a window is one window of its own length; windows with
fewer than ``LITERALS`` literal words are not used (nor counted), so an item made of
placeholders only matches nothing. Null texts and null item ids match nothing.
Rows are identified by doc_id and text (equal rows give one result; a null
doc_id is a document like any other); items by item_id and text.

:func:`contaminated` is that method. :func:`leaked`, which the pipeline uses,
adds two readings of a text. In the first, a whole value is one slot: a number
with its points and commas, a name of several words, a number without the unit
written at it; other words are in lower case. In the second all words are
literal, in lower case, so a copy in another case meets its item. In both, an
inconsistent slot costs only the windows that hold it, and ``RUN`` words in a
row as they are in the item are a leak whatever the item's length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import let
from cadence.llm.common import KEY, pruned, saved, workdir

WINDOW, ANCHOR, LITERALS, COVER = 8, 4, 4, 0.5
#: Words in a row that are a leak by themselves, however long the item is.
RUN = 13
JOINT = "\x02"
NAME, NUMBER, UNIT = "<name>", "<num>", "<unit>"
#: Benchmark windows that may be broadcast (about 1 kB each at most); beyond, the hashes are joined by a shuffle.
MAX_BROADCAST_WINDOWS = 50_000
# Unit words.
UNITS = (
    "mm cm m km in ft yd mi inches feet yards miles meters metres kilometers kilometres centimeters g kg mg lb lbs oz "
    "grams kilograms pounds ounces ml l liters litres gallons cups s sec seconds min minutes h hours days weeks months "
    "years mph kph kmh percent dollars cents euros usd eur degrees"
).split()


def _plain(text: Column) -> Column:
    """The words, with one blank before each."""
    return F.concat(F.lit(" "), F.btrim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "), F.lit(" ")))


def _words(plain: Column) -> Column:
    """An array of the words (without the empty string before the first blank)."""
    return F.split(F.substring(plain, 2, 2**31 - 1), " ")


def raw_words(text: Column) -> Column:
    return _words(_plain(text))


def template_words(text: Column) -> Column:
    """The same words with placeholders; as many as :func:`raw_words`."""
    named = F.regexp_replace(_plain(text), r" \p{Lu}[^ ]*", f" {NAME}")
    measured = F.regexp_replace(named, f" [0-9][^ ]* (?:{'|'.join(UNITS)})(?![^ ])", f" {NUMBER} {UNIT}")
    return _words(F.regexp_replace(measured, " [0-9][^ ]*", f" {NUMBER}"))


def _joined(text: Column) -> Column:
    """The text with what is one value in one word: inner points, commas and
    slashes of a number, and (as they begin with a capital) names of several words."""
    number = F.regexp_replace(F.translate(text, JOINT, " "), r"(?<=[0-9])[.,/](?=[0-9])", JOINT)
    return F.regexp_replace(number, r"(?<![\p{L}\p{N}])(\p{Lu}[\p{L}\p{N}]*)[ \t\r\n]+(?=\p{Lu})", f"$1{JOINT}")


def _whole(text: Column) -> Column:
    """The words of :func:`_joined`, units split off their numbers, with one blank before each."""
    plain = F.concat(F.lit(" "), F.btrim(F.regexp_replace(_joined(text), rf"[^\p{{L}}\p{{N}}{JOINT}]+", " "), F.lit(" ")))
    return F.regexp_replace(plain, f"(?<= )([0-9][0-9{JOINT}]*)({'|'.join(UNITS)})(?![^ ])", "$1 $2")


def whole_words(text: Column) -> Column:
    return _words(_whole(text))


def whole_template(text: Column) -> Column:
    """As :func:`template_words` of :func:`whole_words`, other words in lower case."""
    named = F.regexp_replace(_whole(text), r" \p{Lu}[^ ]*", f" {NAME}")
    measured = F.regexp_replace(named, f" [0-9][^ ]* (?:{'|'.join(UNITS)})(?![^ ])", f" {NUMBER} {UNIT}")
    return _words(F.lower(F.regexp_replace(measured, " [0-9][^ ]*", f" {NUMBER}")))


def folded_words(text: Column) -> Column:
    """All words as they are, in lower case."""
    return _words(F.lower(_plain(text)))


#: How a text is read: the words said, and the template of as many words.
View = tuple[Callable[[Column], Column], Callable[[Column], Column]]
TYPED: View = (raw_words, template_words)
WHOLE: View = (whole_words, whole_template)
FOLDED: View = (folded_words, folded_words)


def anchor_codes(words: Column) -> Column:
    """A hash of each run of four words (none for shorter arrays), from hashes
    of two, so each word is read once."""
    pair = lambda a, step: F.when(
        F.size(a) > step,
        F.zip_with(F.slice(a, 1, F.size(a) - step), F.slice(a, step + 1, F.size(a) - step), lambda x, y: F.xxhash64(x, y)),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: let(pair(h, 1), lambda two: pair(two, 2)))


def literals(window: Column) -> Column:
    return F.size(F.filter(window, lambda w: ~w.isin(NAME, NUMBER, UNIT, "")))


def benchmark_windows(items: DataFrame, view: View = TYPED) -> DataFrame:
    """item_id, _item, item_pos, size, template, fillers, n_windows, offset
    (of the anchor in the window) and code (of the anchor)."""
    words = (
        items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
        .select("item_id", F.xxhash64("item_id", "text").alias("_item"), view[0](F.col("text")).alias("r"), view[1](F.col("text")).alias("t"))
    )
    size = F.least(F.size("t"), F.lit(WINDOW))
    each = (
        words.select("*", size.alias("size"), F.explode(F.sequence(F.lit(0), F.size("t") - size)).alias("item_pos"))
        .select("item_id", "_item", "item_pos", "size", F.expr("slice(t, item_pos + 1, size)").alias("template"), F.expr("slice(r, item_pos + 1, size)").alias("fillers"))
        .where(literals(F.col("template")) >= LITERALS)
    )
    counts = each.groupBy("_item").agg(F.count(F.lit(1)).alias("n_windows"))
    runs = F.transform(
        F.sequence(F.lit(0), F.col("size") - ANCHOR),
        lambda o: F.struct(literals(F.slice("template", o + 1, F.lit(ANCHOR))).alias("literal"), (-o).alias("o")),
    )
    return (
        each.join(counts, "_item").withColumn("offset", -F.array_max(runs)["o"])
        .withColumn("code", anchor_codes(F.col("template"))[F.col("offset")])
    )


def matches(docs: DataFrame, items: DataFrame, most: int = MAX_BROADCAST_WINDOWS, view: View = TYPED) -> DataFrame:
    """Word-for-word equal template windows: doc_id, _key, pos, item_id, _item,
    item_pos, n_windows, template, fillers (of the item), said (of the document)."""
    known = benchmark_windows(items, view)
    base = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias(KEY)).where("text is not null").select(
        "doc_id", KEY, "text", view[1](F.col("text")).alias("t")
    )
    coded = base.withColumn("c", anchor_codes(F.col("t")))
    if known.count() <= most:
        hit = coded.select("*", F.posexplode("c").alias("spot", "code")).join(F.broadcast(known), "code")
    else:  # hashes first; the words come back by the document's key
        spots = coded.select(KEY, F.posexplode("c").alias("spot", "code")).join(known, "code").distinct()
        hit = base.join(spots, KEY)
    return (
        hit.withColumn("pos", F.col("spot") - F.col("offset"))
        .where(F.expr("CASE WHEN pos >= 0 THEN slice(t, pos + 1, size) = template ELSE false END"))
        .withColumn("r", view[0](F.col("text"))).withColumn("said", F.expr("slice(r, pos + 1, size)"))
        .select("doc_id", KEY, "pos", "item_id", "_item", "item_pos", "n_windows", "template", "fillers", "said")
    )


def _slots() -> Column:
    return F.filter(
        F.arrays_zip("template", "fillers", "said"),
        lambda s: s["template"].isin(NAME, NUMBER, UNIT) | (s["template"] == ""),
    )


def contaminated(docs: DataFrame, items: DataFrame, cover: float = COVER, most: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """One row per contaminated (document, item): doc_id, item_id, _key,
    windows (matched in consistent alignments), n_windows, slots (distinct
    fillers in matched windows), changed (slots with another filler)."""
    aligned = (
        matches(docs, items, most).withColumn("slots", _slots())
        .groupBy("doc_id", KEY, "item_id", "_item", "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift"))
        .agg(F.collect_set("item_pos").alias("places"), F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"))
    )
    kind_of = lambda name: F.array_distinct(F.transform("slots", lambda s: F.struct(s["template"], s[name])))
    consistent = (F.size("slots") == F.size(kind_of("fillers"))) & (F.size("slots") == F.size(kind_of("said")))
    whole = aligned.where(consistent).groupBy("doc_id", KEY, "item_id", "_item", "n_windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("windows"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    return whole.where(F.col("windows") >= cover * F.col("n_windows")).select(
        "doc_id", "item_id", KEY, "windows", F.col("n_windows").cast("long"), F.size("slots").cast("long").alias("n_slots"),
        F.size(F.filter("slots", lambda s: s["fillers"] != s["said"])).cast("long").alias("changed"),
    )


def covered(docs: DataFrame, items: DataFrame, view: View, cover: float = COVER, most: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, item_id, _key of documents with ``cover`` of an item's windows,
    or a run of RUN words as they are in the view. A changed slot that is not
    consistent in its alignment costs the windows that hold it, not the others."""
    found = matches(docs, items, most, view).withColumn("slots", _slots())
    aligned = found.groupBy("doc_id", KEY, "item_id", "_item", "n_windows", (F.col("pos") - F.col("item_pos")).alias("shift")).agg(
        F.collect_set(F.struct("item_pos", F.size("template").alias("size"), "slots")).alias("w"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("all"),
    )
    changed = lambda s: s["fillers"] != s["said"]
    clash = lambda s, o: (o["template"] == s["template"]) & ((o["fillers"] == s["fillers"]) != (o["said"] == s["said"]))
    bad = F.filter("all", lambda s: changed(s) & F.exists("all", lambda o: clash(s, o)))
    places = aligned.withColumn("bad", bad).select(
        "doc_id", KEY, "item_id", "_item", "n_windows",
        F.transform(F.filter("w", lambda w: ~F.exists(w["slots"], lambda s: F.array_contains("bad", s))), lambda w: w["item_pos"]).alias("places"),
        F.transform(F.filter("w", lambda w: ~F.exists(w["slots"], changed) & (w["size"] == WINDOW)), lambda w: w["item_pos"]).alias("same"),
    )
    row = F.exists("same", lambda p: F.size(F.array_intersect("same", F.sequence(p, p + (RUN - WINDOW)))) == RUN - WINDOW + 1)
    return (
        places.withColumn("row", row).groupBy("doc_id", KEY, "item_id", "_item", "n_windows")
        .agg(F.size(F.array_distinct(F.flatten(F.collect_set("places")))).alias("windows"), F.max("row").alias("row"))
        .where((F.col("windows") >= cover * F.col("n_windows")) | F.col("row")).select("doc_id", "item_id", KEY)
    )


def leaked(docs: DataFrame, items: DataFrame, cover: float = COVER, most: int = MAX_BROADCAST_WINDOWS) -> DataFrame:
    """doc_id, item_id, _key of documents that an item contaminates in any
    reading: as :func:`contaminated`, with whole values as slots, or word by
    word in any case."""
    found = contaminated(docs, items, cover, most).select("doc_id", "item_id", KEY)
    for view in (WHOLE, FOLDED):
        found = found.unionAll(covered(docs, items, view, cover, most))
    return found.distinct()


def decontaminated(docs: DataFrame, items: DataFrame, cover: float = COVER) -> DataFrame:
    """The rows of docs that no item contaminates, all columns."""
    bad = saved(leaked(docs, items, cover).select(KEY).distinct(), f"{workdir(docs.sparkSession)}/bad")
    return pruned(docs.withColumn(KEY, F.xxhash64("doc_id", "text")), bad, bad.count(), "left_anti").drop(KEY)
