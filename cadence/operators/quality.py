"""Quality gates and equivalence checks, each one aggregate job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.functions.timecols import odd_price, parse_utc
from cadence.schema import CORRUPT_COLUMN


def partition_quality(
    activity: DataFrame, date_col: str = "event_date", key_cols: Sequence[str] = ("user_id", "event_time_utc")
) -> DataFrame:
    """Gate for every date at once: rows, rows with a NULL key, ok flag, message.

    One grouped aggregate replaces a count job per date. A date with no rows
    cannot appear here; callers compare with the dates they expect
    (:func:`cadence.sinks.publish.gate`).
    """
    null_key = F.lit(False)
    for c in key_cols:
        null_key = null_key | F.col(c).isNull()
    q = activity.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.when(null_key, 1).otherwise(0)).cast("long").alias("null_key_rows")
    )
    ok = (F.col("rows") > 0) & (F.col("null_key_rows") == 0)
    msg = (
        F.when(F.col("rows") <= 0, F.lit("no rows"))
        .when(F.col("null_key_rows") > 0, F.concat(F.col("null_key_rows").cast("string"), F.lit(" rows without a key")))
        .otherwise(F.concat(F.col("rows").cast("string"), F.lit(" rows, all with a key")))
    )
    return q.select(date_col, "rows", "null_key_rows", ok.alias("ok"), msg.alias("message"))


def row_conservation(raw: DataFrame, output: DataFrame) -> DataFrame:
    """One row: input rows, output rows, ok = output <= input (no row explosion).

    Both counts come from one job over a union of the two plans."""
    tagged = raw.select(F.lit(1).alias("_in"), F.lit(0).alias("_out")).unionByName(
        output.select(F.lit(0).alias("_in"), F.lit(1).alias("_out"))
    )
    agg = tagged.agg(F.sum("_in").cast("long").alias("input_rows"), F.sum("_out").cast("long").alias("output_rows"))
    return agg.select(
        F.coalesce("input_rows", F.lit(0)).alias("input_rows"),
        F.coalesce("output_rows", F.lit(0)).alias("output_rows"),
        (F.coalesce("output_rows", F.lit(0)) <= F.coalesce("input_rows", F.lit(0))).alias("ok"),
    )


def multiset_diff(left: DataFrame, right: DataFrame, by: str = "event_date") -> DataFrame:
    """Two-way ``EXCEPT ALL`` counted per ``by``: rows on each side and rows only on each side.

    Every ``by`` value of either side gets a row (0 where equal)."""
    cols = left.columns
    sides = lambda l, r: (F.lit(l).alias("_l"), F.lit(r).alias("_r"))
    both = left.select(*cols, *sides(1, 0)).unionByName(right.select(*cols, *sides(0, 1)))
    each = both.groupBy(*cols).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    return (
        each.groupBy(by)
        .agg(
            F.sum("_l").alias("left_rows"),
            F.sum("_r").alias("right_rows"),
            F.sum(F.greatest(F.col("_l") - F.col("_r"), F.lit(0))).alias("only_left"),
            F.sum(F.greatest(F.col("_r") - F.col("_l"), F.lit(0))).alias("only_right"),
        )
        .orderBy(by)
    )


def with_reason(
    raw: DataFrame, time_col: str = "event_time", quarantine_null_keys: bool = False, parsed: Column | None = None
) -> DataFrame:
    """Add ``reason``: why a row cannot be used (NULL: it can).

    Checked in this order: a line that does not fit the schema (where the
    reader kept it), time text that is no time, a price that is no amount of
    money, and with ``quarantine_null_keys`` a NULL time or user. Without it
    rows with a NULL key stay in, and the gate fails their date.
    ``parsed``: the instant of ``time_col``, if ``raw`` has it as a column.
    """
    parsed = parse_utc(time_col) if parsed is None else parsed
    reason = F.when(F.col(time_col).isNotNull() & parsed.isNull(), F.lit("unparseable event_time"))
    if CORRUPT_COLUMN in raw.columns:
        reason = F.when(F.col(CORRUPT_COLUMN).isNotNull(), F.lit("unreadable line")).otherwise(reason)
    if "price" in raw.columns:
        reason = F.coalesce(reason, F.when(odd_price("price"), F.lit("price out of range")))
    if quarantine_null_keys:
        reason = F.coalesce(
            reason,
            F.when(F.col(time_col).isNull(), F.lit("null event_time")).when(F.col("user_id").isNull(), F.lit("null user_id")),
        )
    return raw.withColumn("reason", reason)


def split_valid_invalid(
    raw: DataFrame, time_col: str = "event_time", quarantine_null_keys: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Rows to transform vs quarantined rows with a ``reason``.

    See :func:`with_reason`; works on streams too.
    """
    tagged = with_reason(raw, time_col, quarantine_null_keys)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def quarantine_counts(raw: DataFrame, time_col: str = "event_time") -> DataFrame:
    """One row: total rows and rows per quarantine reason."""
    parsed = parse_utc(time_col)
    n = lambda cond: F.sum(F.when(cond, 1).otherwise(0)).cast("long")
    agg = raw.agg(
        F.count(F.lit(1)).alias("rows"),
        n(F.col(time_col).isNull()).alias("null_event_time"),
        n(F.col(time_col).isNotNull() & parsed.isNull()).alias("unparseable_event_time"),
        n(F.col(time_col).isNotNull() & parsed.isNotNull() & F.col("user_id").isNull()).alias("null_user_id"),
    )
    return agg.select(
        "rows",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("null_event_time", "unparseable_event_time", "null_user_id")],
        (F.col("rows") - F.coalesce("null_event_time", F.lit(0)) - F.coalesce("unparseable_event_time", F.lit(0))
         - F.coalesce("null_user_id", F.lit(0))).alias("valid_rows"),
    )
