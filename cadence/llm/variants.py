"""Spelling variant grouping by a relational trie frontier (DataFrame functions).

Words are counted over all documents. All words form a trie, and all reversed
words a second one; a node is known by a hash of its direction and prefix, and
one row of the *edge table* holds a node's outgoing edges: the character, how
many words lie below, the rest of the word if it is one only, and the lengths
of the rests as a bit set. A state of the search is (word, position, node,
edits). The states without an edit need no join to advance: a word's own
prefixes are its path. Joining them with the edge table makes the states of one
edit: a character replaced by that of another edge, or left out. The frontier
of these is then joined with the edge table level by level: each state follows
the edge of its next character, and ends as soon as no edge is left, no word of
the right length lies below, or only one word lies below, with which the rest
is compared. Terminal one-edit states are the neighbours.

Two words that differ by one edit agree before or after it. So a word's second
half is edited in the trie of words and its first half in that of the reversed
words: edits are tried deep in a trie, where nodes have few edges. Leaving
out is tried, inserting is not (the longer word finds the pair), and a
replacement goes to greater characters only (the lesser word finds the pair).
A node has at most as many edges as there are characters, so no join multiplies
a group with itself, and however many words share a prefix, a skewed node is
split by the join like any other key. Nodes with equal hashes would share a
row; such a row only gains edges, and neighbours are looked up in the words.

Null texts have no words; null words and null counts are left out; of a
repeated word the counts are added. Ties in a form's count go to the
smaller word in code-point order. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import let
from cadence.llm.common import saved, workdir

# Fixed values of the words counted: their letters and the letters that are lower-cased.
NOT_LETTERS = "[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A form has at least so many times its variant's occurrences.
TIMES = 2
SLIP_EVERY = 97
#: Lengths of rests from this one on share the last bit of an edge's bit set.
LAST_BIT = 62


def count_words(
    docs: DataFrame, slip_every: int | None = SLIP_EVERY, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT
) -> DataFrame:
    """(word, n) over the whole texts of docs (doc_id, text): runs of letters,
    A-Z in lower case, that have ``least_length`` code points and ``least_count``
    occurrences.

    Where ``slip_every`` divides the crc32 h of ``<doc_id>:<run>`` (a null
    doc_id is the empty text), the run loses its code point h % length: a
    reproducible typing slip. None: runs count as they are.
    """
    runs = docs.where("text is not null").select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.split(F.translate("text", UPPER, LOWER), NOT_LETTERS)).alias("run"),
    )
    runs = runs.where(F.length("run") >= least_length)
    word = F.col("run")
    if slip_every is not None:
        code = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        runs = runs.withColumn("h", code)
        shorter = F.concat(word.substr(F.lit(1), at), word.substr(at + 2, F.length("run")))
        word = F.when(F.col("h") % slip_every == 0, shorter).otherwise(word)
    return (
        runs.select(word.alias("word")).where(F.length("word") >= least_length)
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)
    )


def _directions(words: DataFrame) -> DataFrame:
    """Each word in both tries: (back, s, size, at): s is reversed in the
    second one, and edits are tried from position ``at`` on."""
    size = F.length("word")
    half = F.floor(size / 2).cast("int")

    def way(back: bool, s: Column, at: Column) -> Column:
        return F.struct(F.lit(back).alias("back"), s.alias("s"), size.alias("size"), at.alias("at"))

    ways = F.array(way(False, F.col("word"), half), way(True, F.reverse("word"), size - half))
    return words.select(F.inline(ways))


def _node(prefix: Column) -> Column:
    return F.xxhash64("back", prefix)


def _from(s: Column, at: Column | int) -> Column:
    """The rest of s from position ``at`` (0: all)."""
    return s.substr(F.lit(at + 1) if isinstance(at, int) else at + 1, F.length(s))


def _char(s: Column, at: Column | int) -> Column:
    return s.substr(F.lit(at + 1) if isinstance(at, int) else at + 1, F.lit(1))


def edge_table(words: DataFrame, depth: int) -> DataFrame:
    """(node, edges) of both tries, for nodes of ``depth`` and deeper. An edge
    is (c, k, tail, sizes); c is empty where a word ends at the node."""
    s, d = F.col("s"), F.col("d")
    step = _directions(words).select("back", "s", F.explode(F.sequence(F.lit(depth), F.col("size"))).alias("d"))
    step = step.select(_node(s.substr(F.lit(1), d)).alias("node"), _char(s, d).alias("c"), _from(s, d + 1).alias("tail"))
    bit = F.expr(f"shiftleft(1L, least(length(tail), {LAST_BIT}))")
    each = step.groupBy("node", "c").agg(F.count(F.lit(1)).alias("k"), F.min("tail").alias("tail"), F.bit_or(bit).alias("sizes"))
    edge = F.struct("c", "k", F.when(F.col("k") == 1, F.col("tail")).alias("tail"), "sizes")
    return each.groupBy("node").agg(F.collect_list(edge).alias("edges"))


def _reaches(edge: Column, rest: Column) -> Column:
    """After this edge, ``rest`` may still lead to a word."""
    bit = F.call_function("shiftright", edge["sizes"], F.least(F.length(rest), F.lit(LAST_BIT))).bitwiseAND(F.lit(1)) == 1
    return F.when(edge["k"] == 1, edge["tail"] == rest).otherwise(bit)


def _ends(edge: Column, rest: Column) -> Column:
    """What reaches is a word already."""
    return (edge["k"] == 1) | (rest == "")


def _edited(edges: DataFrame, words: DataFrame) -> DataFrame:
    """The states of one edit, (back, s, v, d, done): the word s became v, of
    which d characters are matched; all of them, if done."""
    states = _directions(words).select("back", "s", F.explode(F.sequence(F.col("at"), F.col("size") - 1)).alias("p"))
    s, p = F.col("s"), F.col("p")
    joined = states.withColumn("node", _node(s.substr(F.lit(1), p))).join(edges, "node").select(
        "back", "s", "p", "edges", s.substr(F.lit(1), p).alias("head"), _char(s, p).alias("own"), _from(s, p + 1).alias("rest")
    )
    head, own, rest = F.col("head"), F.col("own"), F.col("rest")

    def state(v: Column, d: Column, done: Column) -> Column:
        return F.struct(v.alias("v"), d.cast("int").alias("d"), done.alias("done"))

    greater = F.filter("edges", lambda e: (e["c"] > own) & _reaches(e, rest))
    replaced = F.transform(greater, lambda e: state(F.concat(head, e["c"], rest), p + 1, _ends(e, rest)))
    tail = _from(rest, 1)
    on = F.filter("edges", lambda e: (e["c"] == _char(rest, 0)) & ((rest == "") | _reaches(e, tail)))
    # of equal characters in a row only the last one is left out
    left_out = F.transform(
        F.when(_char(rest, 0) != own, on).otherwise(F.filter("edges", lambda e: F.lit(False))),
        lambda e: state(F.concat(head, rest), F.least(p + 1, p + F.length(rest)), (rest == "") | _ends(e, tail)),
    )
    return joined.select("back", "s", F.explode(F.concat(replaced, left_out)).alias("x")).select("back", "s", "x.*")


def _advanced(edges: DataFrame, frontier: DataFrame) -> DataFrame:
    """The states one level deeper; those without an edge are gone."""
    v, d = F.col("v"), F.col("d")
    joined = frontier.withColumn("node", _node(v.substr(F.lit(1), d))).join(edges, "node")
    joined = joined.select("back", "s", "v", "d", "edges", _char(v, d).alias("own"), _from(v, d + 1).alias("rest"))
    on = F.filter("edges", lambda e: (e["c"] == F.col("own")) & _reaches(e, F.col("rest")))
    return joined.select("back", "s", "v", (d + 1).alias("d"), let(on, lambda e: _ends(e[0], F.col("rest"))).alias("done"), F.size(on).alias("size")).where(
        "size > 0"
    ).drop("size")


def near_words(words: DataFrame, least_length: int = LEAST_LENGTH) -> DataFrame:
    """Pairs (word, near), each in both orders: words (distinct, of
    ``least_length`` code points at least) that differ by one inserted, deleted
    or replaced code point."""
    folder = workdir(words.sparkSession)
    words = words.select("word")
    edges = saved(edge_table(words, least_length // 2), f"{folder}/edges")
    level, states = 0, saved(_edited(edges, words), f"{folder}/level-0")
    found = states.where("done")
    while not (frontier := states.where("not done")).isEmpty():
        level += 1
        states = saved(_advanced(edges, frontier), f"{folder}/level-{level}")
        found = found.unionByName(states.where("done"))
    turned = lambda c: F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))
    pair = F.struct(turned("s").alias("word"), turned("v").alias("near"))
    pairs = found.select(pair.alias("p")).select("p.*").distinct()
    pairs = pairs.join(words.withColumnRenamed("word", "near"), "near", "left_semi")
    both = F.array(F.struct("word", "near"), F.struct(F.col("near").alias("word"), F.col("word").alias("near")))
    return pairs.select(F.inline(both))


def _roots(up: DataFrame, folder: str) -> DataFrame:
    """(word, root) of the words that have a form: in each round every pointer
    jumps to where its target points. A form has ``TIMES`` the occurrences at
    least, so there are no circles and few rounds."""
    done, level = None, 0
    while True:
        every = up if done is None else done.unionByName(up)
        target = every.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = up.join(target, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNull().alias("last"))
        jumped = saved(jumped, f"{folder}/root-{level}")
        ended = jumped.where("last").select("word", "root")
        done = ended if done is None else done.unionByName(ended)
        up, level = jumped.where("not last").select("word", "root"), level + 1
        if up.isEmpty():
            return done


def group_variants(words: DataFrame, times: int = TIMES, least_length: int = LEAST_LENGTH) -> DataFrame:
    """For words (word, n): word, form, root, n, n_near, form_n.

    A word's form is its near word of largest n, if that has ``times`` its
    occurrences at least; its root is where the forms lead in the end.
    """
    folder = workdir(words.sparkSession)
    words = words.where("word is not null and n is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = saved(words, f"{folder}/words")
    pairs = near_words(words, least_length)
    others = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    best = pairs.join(others, "near").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("b")
    )
    joined = words.join(best, "word", "left")
    is_form = -F.col("b.n") >= times * F.col("n")
    judged = saved(
        joined.select(
            "word", F.when(is_form, F.col("b.word")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, -F.col("b.n")).alias("form_n"),
        ),
        f"{folder}/judged",
    )
    roots = _roots(judged.where("form is not null").select("word", F.col("form").alias("root")), folder)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
