"""Publication: day-partitioned silver with a gate, swap and readiness marker;
bronze day split; gold mart files and catalog tables.

Silver publication, for any number of dates, is:

1. one partitioned write of all dates into ``<base>/_staging/<run_id>/``
   (run-scoped, so concurrent or crashed runs never collide);
2. one grouped quality aggregate over the staged files, for every date,
   *before* anything is published - a failing date publishes nothing;
3. per date: move the old folder aside, move the staged one in, write the
   ``_SUCCESS`` marker, and only then drop the old folder.

A swap that fails at any step puts the old folder back. A copy is deleted only
when another one stands in its place with a marker; if even putting back fails,
or the driver dies in between, :func:`recover` finishes that later.

The staged files are a written table, so the gate and the swap never
recompute the transform (no in-memory cache to lose with an executor).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cadence.operators.quality import partition_quality
from cadence.schema import ACTIVITY, ACTIVITY_DATA, RAW_COLUMNS, SUCCESS_MARKER
from cadence.sinks import fs


class GateError(RuntimeError):
    pass


@dataclass(frozen=True)
class DateCheck:
    event_date: str
    rows: int
    null_key_rows: int
    ok: bool
    message: str


def _spread(df: DataFrame, date_col: str) -> DataFrame:
    """Cluster rows by date for the partitioned write (few files per date).

    ``REBALANCE`` lets AQE size the write tasks from the real shuffle
    output: a hot date is split over several tasks (several files) and small
    dates are coalesced, without a sampling pass or a random salt."""
    return df.hint("rebalance", date_col)


def gate(spark: SparkSession, staged: DataFrame, expected: Iterable[str] | None = None) -> list[DateCheck]:
    """Quality of every staged date in one aggregate; raise if any fails.

    The result has one row per date (a few thousand at most), so it is
    collected. ``expected`` dates missing from the data fail as empty."""
    rows = partition_quality(staged).collect()
    checks = {r.event_date: DateCheck(r.event_date, r.rows, r.null_key_rows, r.ok, r.message) for r in rows}
    for d in expected or ():
        checks.setdefault(d, DateCheck(d, 0, 0, False, "no rows"))
    out = [checks[d] for d in sorted(checks, key=lambda x: (x is None, x))]
    bad = [c for c in out if not c.ok or c.event_date is None]
    if bad:
        raise GateError("; ".join(f"{c.event_date}: {c.message}" for c in bad))
    return out


def publish_silver(
    spark: SparkSession,
    activity: DataFrame,
    base: str,
    dates: Sequence[str] | None = None,
    run_id: str | None = None,
    before_swap: Callable[[], None] | None = None,
) -> list[DateCheck]:
    """Write ``activity`` as ``base/event_date=D/`` folders, gated and swapped.

    ``dates``: the dates this run must publish (required non-empty); other
    dates in ``activity`` are published too. ``before_swap``: an extra check
    run after staging and gating; raising there publishes nothing.
    Returns the per-date checks.
    """
    run_id = run_id or uuid.uuid4().hex
    staging = f"{base}/_staging/{run_id}"
    trash = f"{base}/_trash/{run_id}"
    cols = [f.name for f in ACTIVITY.fields]
    (
        _spread(activity.select(*cols), "event_date")
        .write.mode("overwrite")
        .option("compression", "snappy")
        .partitionBy("event_date")
        .parquet(staging)
    )
    staged = spark.read.schema(ACTIVITY).parquet(staging)
    try:
        checks = gate(spark, staged, dates)
        if before_swap is not None:
            before_swap()
    except Exception:
        fs.delete(spark, staging)  # nothing was published, the input is untouched
        raise
    existing = set(fs.list_dirs(spark, base))  # one listing instead of a check per date
    fs.mkdirs(spark, trash)

    def one(c: DateCheck) -> Exception | None:
        name = f"event_date={c.event_date}"
        try:
            swap_in(spark, f"{staging}/{name}", f"{base}/{name}", f"{trash}/{name}", name in existing)
        except Exception as e:  # noqa: BLE001  every date is tried; the first failure is raised below
            return e
        return None

    # Dates are independent: swap them concurrently (a rename is a copy on
    # object stores, so a serial loop over many dates would dominate).
    with ThreadPoolExecutor(max_workers=min(16, max(1, len(checks)))) as pool:
        failed = {c.event_date: e for c, e in zip(checks, pool.map(one, checks), strict=True) if e is not None}
    if not fs.list_dirs(spark, trash):
        fs.delete(spark, trash)
    if failed:
        first = min(failed)
        raise PublishError(f"not published: {sorted(failed)}; their new rows stay in {staging}: {failed[first]}") from failed[first]
    fs.delete(spark, staging)
    return checks


class PublishError(RuntimeError):
    """Some dates keep their old copy; the others are published."""


def swap_in(spark: SparkSession, staged: str, final: str, aside: str, replaces: bool) -> None:
    """Put folder ``staged`` in the place of ``final``, or leave all as it was."""
    if replaces:
        fs.rename(spark, final, aside, make_parent=False)
    try:
        fs.rename(spark, staged, final, make_parent=False)
        fs.touch(spark, f"{final}/{SUCCESS_MARKER}")  # last: the folder is ready
    except Exception:
        _put_back(spark, staged, final, aside)
        raise
    if replaces:
        fs.delete(spark, aside)


def _put_back(spark: SparkSession, staged: str, final: str, aside: str) -> None:
    if fs.exists(spark, final):  # the new copy, without its marker
        fs.rename(spark, final, staged, make_parent=False)
    if fs.exists(spark, aside):
        fs.rename(spark, aside, final, make_parent=False)


def recover(spark: SparkSession, base: str) -> list[str]:
    """Finish what a dead run left: each folder that was moved aside goes back,
    unless a newer one with a marker stands in its place. Returns the names of
    folders put back. Only while no run publishes to ``base``."""
    back = []
    for run in fs.list_dirs(spark, f"{base}/_trash"):
        for name in fs.list_dirs(spark, f"{base}/_trash/{run}"):
            old, final = f"{base}/_trash/{run}/{name}", f"{base}/{name}"
            if not fs.exists(spark, f"{final}/{SUCCESS_MARKER}"):
                if fs.exists(spark, final):
                    fs.rename(spark, final, f"{base}/_staging/{run}/{name}")
                fs.rename(spark, old, final)
                back.append(name)
            else:
                fs.delete(spark, old)
        fs.delete(spark, f"{base}/_trash/{run}")
    return sorted(back)


def split_daily(raw_with_date: DataFrame, output: str) -> None:
    """Bronze: the raw columns as CSV under ``event_date=`` folders (overwrite)."""
    df = raw_with_date.select(*RAW_COLUMNS, "event_date")
    _spread(df, "event_date").write.partitionBy("event_date").option("header", True).mode(
        "overwrite"
    ).csv(output)


def write_mart(spark: SparkSession, mart: DataFrame, base: str, name: str, table_prefix: str = "gold_") -> int:
    """A mart as one ordered parquet file plus an unmanaged catalog table.

    Marts are aggregates (rows per day/week), so one file is right; the
    row count comes from the files just written, not a recomputation. The
    files are staged and swapped like a date, and the table stays in place
    (it is made anew only when its columns change)."""
    run, path, table = uuid.uuid4().hex, f"{base}/{name}", f"{table_prefix}{name}"
    staged = f"{base}/_staging/{run}/{name}"
    mart.coalesce(1).write.parquet(staged)
    rows = spark.read.parquet(staged)
    n, schema = rows.count(), rows.schema
    fs.mkdirs(spark, f"{base}/_trash/{run}")
    swap_in(spark, staged, path, f"{base}/_trash/{run}/{name}", fs.exists(spark, path))
    fs.delete(spark, f"{base}/_staging/{run}")
    fs.delete(spark, f"{base}/_trash/{run}")
    if spark.catalog.tableExists(table) and spark.table(table).schema != schema:
        spark.sql(f"DROP TABLE {table}")
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet")
    spark.catalog.refreshTable(table)
    return n


def write_payload(payload: DataFrame, path: str) -> None:
    """``(table, record)`` rows as JSON-lines text, one folder per table."""
    payload.repartition("table").write.mode("overwrite").partitionBy("table").text(path)


def ensure_activity_table(spark: SparkSession, base: str, name: str = "activity") -> None:
    """External partitioned parquet table over the silver folder."""
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ACTIVITY_DATA.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, event_date string) USING parquet "
        f"PARTITIONED BY (event_date) LOCATION '{base}'"
    )


def register_dates(spark: SparkSession, dates: Iterable[str], base: str, name: str = "activity") -> None:
    """Add the given date partitions (cheaper than a full repair with many dates)."""
    for d in dates:
        spark.sql(
            f"ALTER TABLE {name} ADD IF NOT EXISTS PARTITION (event_date='{d}') LOCATION '{base}/event_date={d}'"
        )


def repair_table(spark: SparkSession, name: str = "activity") -> None:
    spark.sql(f"MSCK REPAIR TABLE {name}")


def show_partitions(spark: SparkSession, name: str = "activity") -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {name}")
