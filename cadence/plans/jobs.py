"""User-facing jobs. The caller owns the session (UTC is checked, never set)."""

from __future__ import annotations

import datetime as dt
import math
import time
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cadence.functions.timecols import epoch_seconds, local_date_text, to_local_clock
from cadence.operators import marts as marts_mod
from cadence.operators.quality import multiset_diff
from cadence.operators.sessions import HOT_ROWS, last_sessions
from cadence.plans import intake
from cadence.plans.pipeline import transform
from cadence.schema import LOCAL_ZONE, SESSION_GAP_SECONDS
from cadence.session import ensure_utc, scratch_dir
from cadence.sinks import fs, publish
from cadence.sources.files import committed_dates, day_paths, read_committed, read_events

RUN_LOG = (
    "run_id string, mode string, run_date string, input_rows long, quarantined_rows long, duplicate_rows long, "
    "output_rows long, sessions long, dates int, started_at timestamp, duration_s double, status string"
)


@dataclass
class RunReport:
    """input_rows = quarantined_rows + duplicate_rows + output_rows."""

    mode: str
    input_rows: int
    quarantined_rows: int
    duplicate_rows: int
    output_rows: int
    sessions: int  # distinct session ids, estimated (HyperLogLog++)
    dates: list[str] = field(default_factory=list)
    checks: list[publish.DateCheck] = field(default_factory=list)
    republished: list[str] = field(default_factory=list)  # later dates whose sessions changed
    run_id: str = ""


class RowExplosionError(RuntimeError):
    pass


def _publish(spark, silver, output, dates, staged: intake.Intake, mode: str, run_id: str) -> RunReport:
    """Stage, gate, swap. Output rows and sessions are observed inside the
    staging write (no extra scan); more rows out than in publish nothing."""
    seen = Observation("output")
    silver = silver.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("session_id", 0.01).alias("sessions")
    )

    def no_explosion():
        if seen.get["rows"] > staged.valid_rows:
            raise RowExplosionError(f"{seen.get['rows']} rows came out of {staged.valid_rows}")

    checks = publish.publish_silver(spark, silver, output, dates, run_id, no_explosion)
    n = seen.get["rows"]
    return RunReport(
        mode, staged.input_rows, staged.quarantined_rows, staged.valid_rows - n, n, seen.get["sessions"],
        [c.event_date for c in checks], checks, run_id=run_id,
    )


def _quarantine(staged: intake.Intake, path: str) -> None:
    """Keep the rows that cannot be used, with their reasons."""
    if staged.quarantined_rows:
        staged.quarantined.write.mode("overwrite").parquet(path)


def _logged(spark: SparkSession, output: str, mode: str, run_date: str | None, job) -> RunReport:
    """Run ``job(run_id)`` and append one row to ``<output>/_runs``, also when it fails."""
    run_id, began, start = uuid.uuid4().hex, dt.datetime.now(dt.timezone.utc), time.perf_counter()
    report, status = None, "ok"
    try:
        report = job(run_id)
        return report
    except Exception as e:
        status = f"{type(e).__name__}: {str(e)[:300]}"
        raise
    finally:
        r = report or RunReport(mode, None, None, None, None, None)
        row = (
            run_id, mode, run_date, r.input_rows, r.quarantined_rows, r.duplicate_rows, r.output_rows, r.sessions,
            len(r.dates), began, time.perf_counter() - start, status,
        )
        spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").parquet(f"{output}/_runs")


def _register(spark: SparkSession, output: str, dates: Iterable[str], table: str | None) -> None:
    if table:
        publish.ensure_activity_table(spark, output, table)
        publish.register_dates(spark, dates, output, table)
        spark.catalog.refreshTable(table)


def run_log(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(f"{output}/_runs")


def run_backfill(
    spark: SparkSession,
    inputs: str | Iterable[str],
    output: str,
    zone: str = LOCAL_ZONE,
    gap_seconds: int = SESSION_GAP_SECONDS,
    quarantine_path: str | None = None,
    quarantine_null_keys: bool = False,
    hot_rows: int | None = HOT_ROWS,
    table: str | None = None,
) -> RunReport:
    """Whole input range -> every date published (gate before any swap).

    The text is read once. Lines that do not fit the schema, times that are
    no times and prices that are no money go to ``quarantine_path`` (default
    ``<output>/_quarantine/<run_id>``) with a reason. Rows with a NULL user or
    time fail the gate of their date - nothing is published - unless
    ``quarantine_null_keys``. ``table``: catalog table to keep in step."""
    ensure_utc(spark)

    def job(run_id: str) -> RunReport:
        folder = f"{scratch_dir(spark).rstrip('/')}/intake-{run_id}"
        raw = read_events(spark, inputs, keep_corrupt=True)
        try:
            staged = intake.stage(spark, intake.split(raw, quarantine_null_keys), folder)
            _quarantine(staged, quarantine_path or f"{output}/_quarantine/{run_id}")
            silver = transform(staged.valid, zone, gap_seconds, hot_rows=hot_rows)
            report = _publish(spark, silver, output, None, staged, "backfill", run_id)
        finally:
            fs.delete(spark, folder)
        _register(spark, output, report.dates, table)
        return report

    return _logged(spark, output, "backfill", None, job)


def seeds_from_published(spark: SparkSession, output: str, run_date: str, gap_seconds: int) -> DataFrame | None:
    """Per user: last published event second before ``run_date`` and its session start.

    Only dates within the gap can continue into ``run_date``: ceil(gap / 1 day)
    dates are read. The start is the suffix of the session id."""
    days = max(1, math.ceil(gap_seconds / 86400))
    d = dt.date.fromisoformat(run_date)
    wanted = [(d - dt.timedelta(days=k)).isoformat() for k in range(1, days + 1)]
    prev = read_committed(spark, output, wanted)
    if prev.isEmpty():
        return None
    start = F.substring_index("session_id", "_", -1).cast("long")
    return prev.where(F.col("event_time_utc").isNotNull()).groupBy("user_id").agg(
        F.max(epoch_seconds("event_time_utc")).alias("last_s"), F.max(start).alias("start_s")
    )


def run_incremental(
    spark: SparkSession,
    day_root: str,
    output: str,
    run_date: str,
    lookback_days: int = 1,
    seed: bool = True,
    zone: str = LOCAL_ZONE,
    gap_seconds: int = SESSION_GAP_SECONDS,
    quarantine_null_keys: bool = False,
    hot_rows: int | None = HOT_ROWS,
    table: str | None = None,
    cascade: bool = True,
) -> RunReport:
    """Publish one local date from the bronze day folders.

    ``seed=True`` (default) equals a backfill, whatever was published before:
    the sessions of the latest published earlier date go on, and day folders
    between that date and ``run_date`` (a hole, or all earlier ones on a first
    run) are read as context. In a daily routine that is one folder.
    ``cascade``: if the next date is published already (``run_date`` is run
    again, with late rows), it is recomputed, and so on until a date comes out
    as it was. ``seed=False``: the lookback mode (``lookback_days`` folders
    as context), exact only if no session chain is longer.

    Rows of the day folder are published, quarantined with a reason, dropped
    as duplicates, or fail the gate; rows of another local date are
    quarantined. ``table``: catalog table to keep in step.
    """
    ensure_utc(spark)
    if not run_date:
        raise ValueError("run_date is required for an incremental run")
    options = dict(zone=zone, gap_seconds=gap_seconds, quarantine_null_keys=quarantine_null_keys, hot_rows=hot_rows)

    def job(run_id: str) -> RunReport:
        report, _ = _one_date(spark, day_root, output, run_date, lookback_days if not seed else None, run_id, **options)
        later = committed_dates(spark, output)
        days = max(1, math.ceil(gap_seconds / 86400))
        now = run_date
        while cascade and seed:
            following = min((d for d in later if d > now), default=None)
            reach = (dt.date.fromisoformat(now) + dt.timedelta(days=days)).isoformat()
            if following is None or following > reach:
                break
            _, changed = _one_date(
                spark, day_root, output, following, None, f"{run_id}-{following}", only_changed=True, **options
            )
            if not changed:
                break
            report.republished.append(following)
            now = following
        _register(spark, output, [run_date, *report.republished], table)
        return report

    return _logged(spark, output, "incremental", run_date, job)


def _one_date(
    spark, day_root, output, run_date, lookback, run_id, zone, gap_seconds, quarantine_null_keys, hot_rows, only_changed=False
) -> tuple[RunReport | None, bool]:
    """Compute and publish one date; ``only_changed``: only if its rows differ
    from the published ones. Returns the report and whether it was published."""
    if lookback is None:
        before = max((d for d in committed_dates(spark, output) if d < run_date), default=None)
        paths = [p for p in day_paths(spark, day_root, run_date, None) if before is None or p[-10:] > before]
    else:
        paths = day_paths(spark, day_root, run_date, lookback)
    if not paths or not paths[-1].endswith(f"event_date={run_date}"):
        raise FileNotFoundError(f"no day folder for {run_date} under {day_root}")
    seeds = seeds_from_published(spark, output, paths[0][-10:], gap_seconds) if lookback is None else None
    folder = f"{scratch_dir(spark).rstrip('/')}/intake-{run_id}"
    local = local_date_text(to_local_clock("event_time_utc", zone))
    try:
        tagged = intake.split(
            read_events(spark, paths[-1], keep_corrupt=True), quarantine_null_keys, outside=local != F.lit(run_date)
        )
        staged = intake.stage(spark, tagged, f"{folder}/day")
        if not only_changed:
            _quarantine(staged, f"{output}/_quarantine/{run_id}")
        if len(paths) > 1:  # context only: its own runs report and quarantine it
            # staged with all columns: whether a line fits the schema shows only if all are read
            context = intake.split(read_events(spark, paths[:-1], keep_corrupt=True), True, keep=("event_time_utc",))
            context = intake.stage(spark, context, f"{folder}/context").valid.where(local < F.lit(run_date))
            seeds = last_sessions(context, gap_seconds, seeds=seeds)
        # Rows of another date are quarantined, so no date is filtered out of the
        # result: a filter would reach one session path's input and make its
        # shuffle another one. A row without a date stays, and fails the gate.
        silver = transform(staged.valid, zone, gap_seconds, seeds=seeds, hot_rows=hot_rows)
        if only_changed:
            old = read_committed(spark, output, [run_date])
            if multiset_diff(old, silver.select(*old.columns)).where("only_left + only_right > 0").isEmpty():
                return None, False
        return _publish(spark, silver, output, [run_date], staged, "incremental", run_id), True
    finally:
        fs.delete(spark, folder)


def split_daily(
    spark: SparkSession, inputs: str | Iterable[str], output: str, zone: str = LOCAL_ZONE, quarantine_path: str | None = None
) -> intake.Intake:
    """Bronze split: raw CSV -> ``event_date=`` CSV folders, raw columns only.

    Lines without a readable time have no day; they, and all other unusable
    ones, go to ``quarantine_path`` (default ``<output>/_quarantine``) with a
    reason. Rows with a NULL time count as such here; NULL users stay in."""
    folder = f"{scratch_dir(spark).rstrip('/')}/intake-{uuid.uuid4().hex}"
    no_time = F.col("event_time").isNull()
    tagged = intake.split(read_events(spark, inputs, keep_corrupt=True), keep=("event_time_utc",))
    tagged = tagged.withColumns(
        {
            "reason": F.coalesce("reason", F.when(no_time, F.lit("null event_time"))),
            "event_date": local_date_text(to_local_clock("event_time_utc", zone)),
        }
    ).drop("event_time_utc")
    staged = intake.stage(spark, tagged, folder)
    publish.split_daily(staged.valid, output)
    _quarantine(staged, quarantine_path or f"{output}/_quarantine")
    fs.delete(spark, folder)
    return staged


def stage_grain(spark: SparkSession, activity: DataFrame, run_id: str | None = None) -> DataFrame:
    """Write the mart grain to the shared scratch folder and read it back.

    The written table cuts the lineage: every mart reads the (much smaller)
    grain files, silver is scanned and shuffled once, and a lost executor
    costs a re-read of files, not a re-run of the silver scan."""
    path = f"{scratch_dir(spark).rstrip('/')}/grain-{run_id or uuid.uuid4().hex}"
    marts_mod.activity_grain(activity).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_marts(
    spark: SparkSession, silver_root: str, output: str, names: Sequence[str] | None = None
) -> dict[str, int]:
    """Gold marts from committed silver dates only; returns rows per mart."""
    run_id = uuid.uuid4().hex
    grain = stage_grain(spark, read_committed(spark, silver_root), run_id)
    try:
        out = {}
        for name in names or list(marts_mod.MARTS):
            out[name] = publish.write_mart(spark, marts_mod.MARTS[name](grain), output, name)
        return out
    finally:
        fs.delete(spark, f"{scratch_dir(spark).rstrip('/')}/grain-{run_id}")


def wau_report(spark: SparkSession, silver_root: str) -> tuple[DataFrame, DataFrame]:
    activity = read_committed(spark, silver_root)
    return marts_mod.wau_users(activity), marts_mod.wau_sessions(activity)
