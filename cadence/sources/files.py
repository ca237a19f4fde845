"""File sources: raw CSV, day folders with lookback, the silver table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cadence.schema import ACTIVITY, CORRUPT_COLUMN, RAW, SUCCESS_MARKER
from cadence.sinks import fs


def _paths(paths: str | Iterable[str]) -> list[str]:
    if isinstance(paths, str):
        return [p.strip() for p in paths.split(",") if p.strip()]
    return list(paths)


def read_events(spark: SparkSession, paths: str | Iterable[str], keep_corrupt: bool = False) -> DataFrame:
    """Raw CSV (header, forced schema, no inference); one or many paths/folders.

    ``keep_corrupt`` adds ``_corrupt_record`` holding the text of lines that do
    not fit the schema (PERMISSIVE mode), for quarantine instead of failure.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if keep_corrupt:
        schema = T.StructType(RAW.fields + [T.StructField(CORRUPT_COLUMN, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COLUMN).schema(schema)
    else:
        reader = reader.schema(RAW)
    return reader.csv(_paths(paths))


def day_paths(spark: SparkSession, root: str, run_date: str, lookback_days: int | None = 1) -> list[str]:
    """Existing ``root/event_date=D`` folders for D in [run_date - lookback, run_date],
    in order of date (``None``: all up to ``run_date``); one listing."""
    first = ""
    if lookback_days is not None:
        first = (dt.date.fromisoformat(run_date) - dt.timedelta(days=lookback_days)).isoformat()
    days = [n.split("=", 1)[1] for n in fs.list_dirs(spark, root) if n.startswith("event_date=")]
    return [f"{root}/event_date={d}" for d in sorted(days) if first <= d <= run_date]


def read_days(spark: SparkSession, root: str, run_date: str, lookback_days: int = 1) -> DataFrame:
    """Raw events of the day folder ``run_date`` plus ``lookback_days`` folders before it."""
    paths = day_paths(spark, root, run_date, lookback_days)
    if not paths:
        raise FileNotFoundError(f"no day folder for {run_date} under {root}")
    return read_events(spark, paths)


def read_activity(spark: SparkSession, root: str) -> DataFrame:
    """Silver scan with the declared schema (``event_date`` stays a string;
    ``_staging``/``_trash`` folders are skipped by Spark's listing)."""
    return spark.read.schema(ACTIVITY).parquet(root)


def committed_dates(spark: SparkSession, root: str) -> list[str]:
    """Dates whose folder holds the readiness marker."""
    markers = fs.glob(spark, f"{root}/event_date=*/{SUCCESS_MARKER}")
    return sorted(m.rsplit("/", 2)[-2].split("=", 1)[1] for m in markers)


def read_committed(spark: SparkSession, root: str, dates: Iterable[str] | None = None) -> DataFrame:
    """Silver rows of committed dates only (optionally a subset of dates)."""
    ready = committed_dates(spark, root)
    if dates is not None:
        wanted = set(dates)
        ready = [d for d in ready if d in wanted]
    if not ready:
        return spark.createDataFrame([], ACTIVITY)
    paths = [f"{root}/event_date={d}" for d in ready]
    return spark.read.schema(ACTIVITY).option("basePath", root).parquet(*paths)


def read_and_transform(
    spark: SparkSession, paths: str | Iterable[str], zone: str | None = None, gap_seconds: int | None = None
) -> DataFrame:
    """Raw CSV paths straight to silver rows (no publication)."""
    from cadence.plans.pipeline import transform

    kwargs = {k: v for k, v in (("zone", zone), ("gap_seconds", gap_seconds)) if v is not None}
    return transform(read_events(spark, paths), **kwargs)


def read_sample(spark: SparkSession, paths: str | Iterable[str], rows: int) -> DataFrame:
    """The first ``rows`` data lines of the input: a quick end-to-end sample.
    (A sampling operator: the limit is its purpose.)"""
    return read_events(spark, paths).limit(rows)


def sql_marts(
    spark: SparkSession, sql_dir: str, activity: DataFrame, names: Iterable[str], view: str = "activity"
) -> dict[str, DataFrame]:
    """Marts written as SQL files: ``<sql_dir>/<name>.sql`` run over ``activity``.

    The file text (a few hundred bytes) is read through Spark, so any file
    system works; the query itself is planned by Catalyst like the DataFrame
    marts."""
    activity.createOrReplaceTempView(view)
    out = {}
    for name in names:
        text = "\n".join(r.value for r in spark.read.text(f"{sql_dir}/{name}.sql").collect())
        out[name] = spark.sql(text.strip().rstrip(";"))
    return out
