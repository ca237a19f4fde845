"""Natural-key de-duplication and duplicate statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.schema import DEDUP_TIEBREAK, NATURAL_KEY


def _tiebreak_order(df: DataFrame, key: Sequence[str], tiebreak: Sequence[str]):
    present = [c for c in tiebreak if c in df.columns]
    if not present:
        # No listed tie-break column: order by every other column, so the kept
        # row is still a pure function of the input.
        present = [c for c in df.columns if c not in key]
    return [F.col(c).asc_nulls_last() for c in present] or [F.col(key[0])]


def dedup_events(
    df: DataFrame,
    key: Sequence[str] = NATURAL_KEY,
    tiebreak: Sequence[str] = DEDUP_TIEBREAK,
) -> DataFrame:
    """Keep one row per natural key: the first by ``tiebreak`` (asc, nulls last).

    Shape is ``row_number() = 1``: Catalyst turns it into a partial
    WindowGroupLimit *before* the shuffle, so a key repeated a billion
    times ships at most one row per map task.
    """
    w = Window.partitionBy(*key).orderBy(*_tiebreak_order(df, key, tiebreak))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def duplicate_rate(df: DataFrame, key: Sequence[str] = NATURAL_KEY) -> DataFrame:
    """One row: ``rows, exact_duplicates, key_duplicates`` and both rates.

    Exact copies share a key, so the count runs in two aggregation steps
    (full row, then key), each combining map-side; no distinct over a join.
    """
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_row.groupBy(*key).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"))
    return per_key.agg(
        F.sum("_n").alias("rows"),
        (F.sum("_n") - F.sum("_distinct")).alias("exact_duplicates"),
        (F.sum("_n") - F.count(F.lit(1))).alias("key_duplicates"),
    ).select(
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("exact_duplicates", F.lit(0)).alias("exact_duplicates"),
        F.coalesce("key_duplicates", F.lit(0)).alias("key_duplicates"),
        (F.col("exact_duplicates") / F.nullif(F.col("rows"), F.lit(0))).alias("exact_rate"),
        (F.col("key_duplicates") / F.nullif(F.col("rows"), F.lit(0))).alias("key_rate"),
    )
