"""Silver transform: dedup -> local time -> sessions (order fixed)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.functions.timecols import parse_utc, with_local_time
from cadence.operators.dedup import dedup_events
from cadence.operators.sessions import DAY_SECONDS, HOT_ROWS, sessionize
from cadence.schema import LOCAL_ZONE, SESSION_GAP_SECONDS


def transform(
    raw: DataFrame,
    zone: str = LOCAL_ZONE,
    gap_seconds: int = SESSION_GAP_SECONDS,
    by: Sequence[str] = (),
    bucket_seconds: int = DAY_SECONDS,
    seeds: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Raw events -> silver ``activity`` rows (raw columns + times + session id).

    ``by`` keeps independent runs apart (dedup and sessions are per run).
    ``hot_rows``: users above it take the two-level session path (see
    :func:`cadence.operators.sessions.sessionize`).
    """
    deduped = dedup_events(raw, key=(*by, "user_id", "event_time", "event_type", "product_id"))
    timed = with_local_time(deduped, zone)
    # De-duplication keeps every (user, event_time) pair, so the session
    # starts come from two pruned raw columns: the dedup shuffle has a single
    # consumer and is never planned twice.
    starts_src = raw.select(*by, "user_id", parse_utc("event_time").alias("event_time_utc"))
    return sessionize(
        timed, gap_seconds, by=by, bucket_seconds=bucket_seconds, seeds=seeds, source=starts_src, hot_rows=hot_rows
    )


def incremental_all_days(
    raw: DataFrame,
    lookback_days: int = 1,
    zone: str = LOCAL_ZONE,
    gap_seconds: int = SESSION_GAP_SECONDS,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """What a daily incremental run with ``lookback_days`` of context publishes,
    for every date at once.

    Each event joins the run of its own local date and of the next
    ``lookback_days`` dates; every run is transformed on its own (``by=run``)
    and keeps only its own date. One job over the whole table instead of one
    job per date; the input grows ``1 + lookback_days`` times.
    """
    timed = with_local_time(raw, zone)
    runs = F.transform(
        F.sequence(F.lit(0), F.lit(lookback_days)),
        lambda k: F.date_format(F.date_add(F.to_date("event_date"), k), "yyyy-MM-dd"),
    )
    fanned = timed.select(*raw.columns, F.explode(runs).alias("_run_date"))
    out = transform(fanned, zone, gap_seconds, by=("_run_date",), hot_rows=hot_rows)
    return out.where(F.col("event_date") == F.col("_run_date")).drop("_run_date")
