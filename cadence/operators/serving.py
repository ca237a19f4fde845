"""Serving views: the figures a dashboard shows, computed on Spark.

All inputs here are marts (a few rows per day/week), so these are cheap;
they still run as Spark plans so nothing is pulled to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.timecols import safe_div
from cadence.operators import marts


def funnel_overall(activity: DataFrame) -> DataFrame:
    """Weekly funnel plus the overall view -> purchase rate."""
    f = marts.mart_funnel(activity)
    return f.withColumn("view_to_purchase", safe_div("users_purchase", "users_view")).orderBy("week_start")


def funnel_latest(activity: DataFrame) -> DataFrame:
    """The most recent week's funnel row (top-1 by week)."""
    return funnel_overall(activity).orderBy(F.desc("week_start")).limit(1)


def sessions_per_user(activity: DataFrame) -> DataFrame:
    w = marts.mart_wau(activity)
    return w.withColumn("sessions_per_user", safe_div("wau_sessions", "wau_users")).orderBy("week_start")


def dau_dense(activity: DataFrame) -> DataFrame:
    """DAU on the full date spine: days without activity show 0."""
    spine = marts.dim_date(activity).select("date_key", "date")
    dau = marts.mart_dau(activity)
    return (
        spine.join(dau, spine.date_key == dau.event_date, "left")
        .select(
            F.col("date_key").alias("event_date"),
            F.coalesce("dau_users", F.lit(0)).alias("dau_users"),
            F.coalesce("dau_sessions", F.lit(0)).alias("dau_sessions"),
        )
        .orderBy("event_date")
    )


def retention_matrix(retention: DataFrame) -> DataFrame:
    """One row per cohort: ``rates`` is an array whose element k is the rate k
    weeks after the cohort week (NULL if nobody came), up to the last week seen.

    An array holds as many offsets as the data have, and needs no job to find
    them, unlike columns. A cohort has one cell per week, so arrays stay small."""
    cells = retention.groupBy("cohort_week", "cohort_users").agg(
        F.map_from_entries(F.collect_list(F.struct("week_offset", "retention_rate"))).alias("_m"),
        F.max("week_offset").alias("_last"),
    )
    rates = F.transform(F.sequence(F.lit(0), F.col("_last")), lambda k: F.try_element_at(F.col("_m"), k))
    return cells.select("cohort_week", "cohort_users", rates.alias("rates")).orderBy("cohort_week")


def retention_cells(retention: DataFrame) -> DataFrame:
    """The matrix as one row per cohort and offset, absent cells included."""
    return retention_matrix(retention).select(
        "cohort_week", "cohort_users", F.posexplode("rates").alias("week_offset", "retention_rate")
    )


def payload_records(mart: DataFrame, table: str) -> DataFrame:
    """Mart rows as JSON records: dates as ``yyyy-MM-dd``, NULL/NaN kept as null."""
    cols = []
    for f in mart.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.isnan(c), F.lit(None)).otherwise(c)
        cols.append(c.alias(f.name))
    record = F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})
    return mart.select(F.lit(table).alias("table"), record.alias("record"))


def publish_payload(named_marts: dict[str, DataFrame]) -> DataFrame:
    """All marts as one ``(table, record)`` dataset, ready to write as JSON lines."""
    out = None
    for name, df in named_marts.items():
        part = payload_records(df, name)
        out = part if out is None else out.unionByName(part)
    return out
