"""Line deduplication by content-defined chunks (DataFrame functions only).

A text is read as lines: they end at a line feed, and inside a paragraph at the
end of a sentence or clause (``. `` and ``, ``). Rolling hashes over the hashes of neighbouring lines
choose the chunk boundaries: a boundary stands where the rolling hash is a local
minimum. That depends on four lines only, so a passage has the same boundaries
wherever it stands and whatever was inserted before it.

The two lines that meet at a boundary are looked up in the whole corpus. At
each boundary that occurs again, the chunks on both sides are compared, byte by
byte and outwards from the boundary, with those of its first occurrence (least
doc_id, then position): equal chunks, and the equal part of a chunk where the
passage ends inside it, are removed from all later occurrences, if they have
``least_chars`` characters at least. Each removed line still stands in an
earlier place, so the first copy of every passage stays.

Only boundary hashes of all documents are shuffled; texts are shuffled for
documents with a repeated boundary. A boundary's occurrences are counted before
they are compared, and dealt over as many tasks as they need. Null text: no lines, stays null. A row
is identified by doc_id and text; rows equal in both count as one occurrence
and both stay. Null doc_ids sort first. All columns are kept; columns named
n_lines or n_removed are replaced.

:func:`dedup_lines` is that method. It needs a boundary inside a passage and
compares with one partner. :func:`dedup_passages` needs neither: a line goes if
it lies in a stretch of ``least_chars`` characters or more that stands earlier
in the corpus, whatever its number of lines. It looks up the shortest runs of
lines with that many characters, one from every line on and one back from every
line: they cover each such stretch. Only hashes of runs are shuffled, first for
their counts, then those that occur again. Blank lines inside a run do not
count. Runs are equal when 128 bits of their hashes are.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.llm.common import KEY, pruned, saved, workdir

LEAST_CHARS = 60
CUT = "\x01"
#: Occurrences of a boundary that one task compares.
DEAL = 1000
ENDS = ("\n", ". ", ", ")
#: Line ends of :func:`dedup_passages`.
ALL_ENDS = (*ENDS, "! ", "? ", "; ", "\u3002", "\uff01", "\uff1f")
#: Bits of the set of repeated runs' hashes that is broadcast (as a power of two: 32 MB), and bits a hash.
MAX_BITS = 28
BITS_A_HASH = 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


def pieces(text: Column, ends: tuple[str, ...] = ENDS) -> Column:
    """The text in lines that still have their ends: joined, they are the text."""
    marked = text
    for end in ends:
        marked = F.replace(marked, F.lit(end), F.lit(end + CUT))
    after = "|".join(f"(?<={re.escape(end)})" for end in ends)
    return F.when(F.instr(text, CUT) == 0, F.split(marked, CUT)).otherwise(F.split(text, after))


def lines(text: Column, ends: tuple[str, ...] = ENDS) -> Column:
    return F.transform(pieces(text, ends), lambda p: F.btrim(p, F.lit(" \t\r\n")))


def row_key(docs: DataFrame) -> Column:
    return F.xxhash64("doc_id", "text")


def boundaries(own: Column) -> Column:
    """Array of (at, low, high, code): the line before which a chunk begins,
    the limits of the chunks on both sides, and a hash of the lines that meet."""
    codes = lambda ls: F.transform(ls, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 8), 16, 10).cast("long"))
    rolling = lambda h: F.transform(h, lambda x, i: F.when(i == 0, x).otherwise((h[i - 1] * 1000003 + x) % 2147483647))
    minima = lambda r: F.when(
        F.size(r) >= 4,
        F.filter(F.sequence(F.lit(2), F.size(r) - 2), lambda i: (r[i] < r[i - 1]) & (r[i] <= r[i + 1])),
    ).otherwise(F.array().cast("array<int>"))

    def described(at: Column, ls: Column) -> Column:
        return F.transform(
            at,
            lambda b, i: F.struct(
                b.alias("at"),
                F.when(i == 0, 0).otherwise(at[i - 1]).alias("low"),
                F.when(i == F.size(at) - 1, F.size(ls)).otherwise(at[F.least(i + 1, F.size(at) - 1)]).alias("high"),
                F.xxhash64(ls[b - 1], ls[b]).alias("code"),
            ),
        )

    return let(own, lambda ls: let(let(let(codes(ls), rolling), minima), lambda at: described(at, ls)))


def common_prefix(a: Column, b: Column) -> Column:
    """How many leading elements of two non-empty arrays are equal."""
    n = F.least(F.size(a), F.size(b))
    return let(
        F.transform(F.sequence(F.lit(0), n - 1), lambda i: a[i] == b[i]),
        lambda same: F.when(F.array_position(same, False) == 0, F.size(same)).otherwise(F.array_position(same, False).cast("int") - 1),
    )


def removals(docs: DataFrame, folder: str, least_chars: int) -> DataFrame:
    """The key and the ranges (array of begin, end: line numbers) to remove."""
    base = docs.select("doc_id", "text", row_key(docs).alias(KEY)).where("text is not null")
    marks = saved(base.select("doc_id", KEY, boundaries(lines(F.col("text"))).alias("b")), f"{folder}/marks")
    each = marks.select("doc_id", KEY, F.inline("b"))
    again = (
        each.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "at", KEY)).alias("f"))
        .where("n > 1").select("code", "n", F.col("f.at").alias("f_at"), F.col(f"f.{KEY}").alias("f_key"))
    )
    met = each.drop("doc_id").join(saved(again, f"{folder}/again"), "code")
    first = (F.col("at") == F.col("f_at")) & (F.col(KEY) == F.col("f_key"))
    found = saved(
        met.groupBy(KEY).agg(F.collect_set(F.struct("at", "low", "high", "code", "n", first.alias("first"))).alias("b")),
        f"{folder}/repeated",
    )
    here = pruned(base, found.select(KEY), found.count(), "left_semi").join(found, KEY)
    at = F.col("m.at")
    sides = (
        here.withColumn("l", lines(F.col("text")))
        .select(KEY, "l", F.explode("b").alias("m"))
        .select(
            KEY, at.alias("at"), "m.code", "m.n", "m.first",
            F.reverse(F.slice("l", F.col("m.low") + 1, at - F.col("m.low"))).alias("before"),
            F.slice("l", at + 1, F.col("m.high") - at).alias("after"),
        )
    )
    deals = F.ceil(F.col("n") / DEAL)
    firsts = sides.where("first").select(
        "code", F.struct("before", "after").alias("r"), F.explode(F.sequence(F.lit(0).cast("long"), deals - 1)).alias("deal")
    )
    later = sides.where("not first").withColumn("deal", F.pmod(F.xxhash64(KEY), deals))
    back, forth = common_prefix(F.col("before"), F.col("r.before")), common_prefix(F.col("after"), F.col("r.after"))
    size = lambda a, n: F.aggregate(F.slice(a, 1, n), F.lit(0), lambda s, x: s + F.length(x))
    return (
        later.join(firsts, ["code", "deal"])
        .withColumn("back", back).withColumn("forth", forth)
        # hashes of other lines may collide; those that meet must be equal
        .where((F.col("back") > 0) & (F.col("forth") > 0))
        .where(size("before", F.col("back")) + size("after", F.col("forth")) >= least_chars)
        .groupBy(KEY)
        .agg(F.collect_set(F.struct((F.col("at") - F.col("back")).alias("begin"), (F.col("at") + F.col("forth")).alias("end"))).alias("_llm_ranges"))
    )


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """All rows and columns of docs; text without its repeated passages,
    n_lines and n_removed (lines)."""
    folder = workdir(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    gone = saved(removals(docs, folder, least_chars), f"{folder}/ranges")
    cut = F.col("_llm_ranges")
    stays = lambda p: F.filter(p, lambda x, i: ~F.exists(cut, lambda q: (q["begin"] <= i) & (i < q["end"])))
    return _without(docs, gone, ENDS, stays)


def _without(docs: DataFrame, gone: DataFrame, ends: tuple[str, ...], stays: Callable[[Column], Column]) -> DataFrame:
    """docs without the ranges of ``gone``; ``stays`` gives the pieces that stay."""
    keyed = docs.withColumn(KEY, row_key(docs))
    n = gone.count()
    changed = (
        pruned(keyed, gone.select(KEY), n, "left_semi").join(gone, KEY)
        .withColumn("_llm_pieces", pieces(F.col("text"), ends)).withColumn("_llm_stay", stays(F.col("_llm_pieces")))
        .withColumn("text", F.array_join("_llm_stay", ""))
        .withColumn("n_lines", F.size("_llm_pieces")).withColumn("n_removed", F.size("_llm_pieces") - F.size("_llm_stay"))
    )
    same = pruned(keyed, gone.select(KEY), n, "left_anti").withColumn(
        "n_lines", F.coalesce(F.array_size(pieces(F.col("text"), ends)), F.lit(0))
    ).withColumn("n_removed", F.lit(0))
    columns = [*docs.columns, "n_lines", "n_removed"]
    return same.select(columns).unionByName(changed.select(columns))


def shortest(sizes: Column, least: int) -> Column:
    """For each element, how many from it on first reach ``least`` in sum; null: not up to the end."""
    last = lambda i: F.aggregate(
        F.slice(sizes, i + 1, F.lit(least)),
        F.struct(F.lit(0).alias("s"), F.lit(0).alias("k")),
        lambda a, x: F.when(a["s"] >= least, a).otherwise(F.struct((a["s"] + x).alias("s"), (a["k"] + 1).alias("k"))),
        lambda a: F.when(a["s"] >= least, a["k"]),
    )

    def reach(i: Column) -> Column:
        total, found = F.get(sizes, i), None
        for k in range(1, 7):
            found = F.when(total >= least, k) if found is None else found.when(total >= least, k)
            total = total + F.get(sizes, i + k)
        return found.when(F.size(sizes) - i > 6, last(i))

    return F.transform(sizes, lambda x, i: reach(i))  # sizes: read at every element, so a let() variable


def runs(own: Column, least: int, codes_only: bool = False) -> Column:
    """Array of (begin, end, code, proof), or of the codes: the shortest runs of
    lines with ``least`` characters, from every line on and back from every line."""

    def described(keep: Column, ls: Column, n: Column) -> Column:
        # begin and number of lines in one long: distinct hashes those, but compares structs pair by pair
        packed = lambda at, k: at.cast("long") * (least + 1) + k
        on = F.transform(shortest(n, least), lambda k, i: packed(i, k))
        back = F.transform(let(F.reverse(n), lambda r: shortest(r, least)), lambda k, i: packed(F.size(n) - i - k, k))
        each = F.transform(
            F.array_distinct(F.filter(F.concat(on, back), lambda r: r.isNotNull())),
            lambda r: F.struct(F.floor(r / (least + 1)).cast("int").alias("at"), (r % (least + 1)).cast("int").alias("k")),
        )

        def named(r: Column) -> Column:
            text = F.slice(ls, r["at"] + 1, r["k"])
            if codes_only:
                return F.xxhash64(text)
            return F.struct(
                keep[r["at"]].alias("begin"), (keep[r["at"] + r["k"] - 1] + 1).alias("end"),
                F.xxhash64(text).alias("code"), F.xxhash64(F.lit(1), text).alias("proof"),
            )

        return F.transform(each, named)

    full = lambda a: F.filter(F.transform(a, lambda x, i: F.struct(i.alias("i"), x.alias("l"))), lambda r: r["l"] != "")
    sized = lambda keep, ls: let(F.transform(ls, lambda x: F.length(x)), lambda n: described(keep, ls, n))
    split = lambda f: let(f["i"], lambda keep: let(f["l"], lambda ls: sized(keep, ls)))
    return let(own, lambda a: let(full(a), split))


def bit_set(codes: DataFrame, power: int) -> DataFrame:
    """The lowest ``power`` bits of all codes as a set of bits: (part, words),
    32,768 bits in each row."""
    at = F.pmod("code", F.lit(1 << power))
    word = F.shiftright(at, 6).bitwiseAND(F.lit(511)).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod(code, {1 << power}) & 63 as int))")
    words = codes.groupBy(F.shiftright(at, 15).alias("part"), word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    of = words.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("of"))
    every = F.transform(F.sequence(F.lit(0), F.lit(511)), lambda k: F.coalesce(F.col("of")[k], F.lit(0).cast("long")))
    return of.select("part", every.alias("words"))


def maybe_in(rows: DataFrame, bits: DataFrame, power: int) -> DataFrame:
    """The rows whose code is in the set, and a few others."""
    at = F.pmod(rows["code"], F.lit(1 << power))
    word = bits["words"][F.shiftright(at, 6).bitwiseAND(F.lit(511)).cast("int")]
    held = F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1
    return rows.join(F.broadcast(bits), (F.shiftright(at, 15) == bits["part"]) & held, "left_semi")


def repeated_lines(docs: DataFrame, folder: str, least_chars: int) -> DataFrame:
    """The key and the ranges (array of begin, end: line numbers; sorted and apart) to remove."""
    base = docs.select("doc_id", "text", row_key(docs).alias(KEY)).where("text is not null")
    own = lines(F.col("text"), ALL_ENDS)
    counts = base.select(F.explode(runs(own, least_chars, codes_only=True)).alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    again = saved(counts.where("n > 1"), f"{folder}/again")
    power = min(MAX_BITS, max(15, (BITS_A_HASH * again.count()).bit_length()))
    bits = saved(bit_set(again, power), f"{folder}/bits")
    base = base.select("doc_id", KEY, F.inline(runs(own, least_chars)))
    met = maybe_in(base, bits, power).join(again, "code")
    met = saved(met, f"{folder}/met")
    deals = F.ceil(F.col("n") / DEAL)
    first = (
        met.groupBy("code", "proof").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("own"), F.min(F.struct("doc_id", "begin", KEY)).alias("f"))
        .where("own > 1")
        .select("code", "proof", "f", F.explode(F.sequence(F.lit(0).cast("long"), deals - 1)).alias("deal"))
    )
    later = met.withColumn("deal", F.pmod(F.xxhash64(KEY, "begin"), deals)).join(first, ["code", "proof", "deal"])
    later = later.where((F.col("begin") != F.col("f.begin")) | (F.col(KEY) != F.col(f"f.{KEY}"))).select(KEY, "begin", "end").distinct()
    order = Window.partitionBy(KEY).orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col("begin") > before).cast("int"), F.lit(1))
    return (
        later.withColumn("opens", opens).withColumn("part", F.sum("opens").over(order))
        .groupBy(KEY, "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
        .groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_llm_ranges"))
    )


def dedup_passages(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """As :func:`dedup_lines`, without every repeated passage of whole lines
    that has ``least_chars`` characters, in all places but its first."""
    folder = workdir(docs.sparkSession)
    docs = docs.drop("n_lines", "n_removed")
    gone = saved(repeated_lines(docs, folder, least_chars), f"{folder}/ranges")
    cut = F.col("_llm_ranges")
    stays = lambda p: F.flatten(F.zip_with(
        F.concat(F.array(F.lit(0)), cut["end"]), F.concat(cut["begin"], F.array(F.size(p))), lambda a, b: F.slice(p, a + 1, b - a)
    ))
    return _without(docs, gone, ALL_ENDS, stays)
