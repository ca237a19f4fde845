"""Structured Streaming versions of the pipeline.

* :func:`stream_dedup` - natural-key dedup within a watermark. Keeps the
  first *arrived* row, not the lowest price (batch :func:`dedup_events` does).
* :func:`stream_sessions` - one row per session from ``session_window``
  (same sessions as the batch rule when nothing is later than the watermark).
* :func:`stream_session_starts` - ``(user, second) -> session start`` with
  per-user state bounded by the watermark delay in seconds (skew-safe).
* :func:`attach_sessions` - every event of a batch with its session id, by an
  equi-join with those starts (in ``foreachBatch``, or on landed rows).
* :func:`unreadable` - the rows that the above leave out, for a quarantine sink.
* :func:`stream_daily_fact` - per local day and event type: counts, revenue
  and approximate distinct users (exact distinct is not available on streams).
* :func:`stream_daily_sessions` - sessions per local day, counted where they end.
* :func:`publish_stream` - ``foreachBatch`` sink: lands each micro-batch
  under its epoch id (idempotent on replay) and re-publishes every affected
  date, and the dates after it, through the batch gate and swap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from typing import Any
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cadence.functions.timecols import local_date_text, money_sum, to_local_clock, with_local_time
from cadence.operators.quality import with_reason
from cadence.operators.sessions import session_id_col
from cadence.schema import LOCAL_ZONE, NATURAL_KEY, RAW, RAW_COLUMNS, SESSION_GAP_SECONDS


def read_event_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw CSV files arriving in ``path`` (header, forced schema)."""
    reader = spark.readStream.schema(RAW).option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def stream_dedup(stream: DataFrame, delay: str = "1 hour", zone: str = LOCAL_ZONE) -> DataFrame:
    """Drop natural-key repeats arriving within ``delay`` of each other."""
    timed = with_local_time(stream, zone)
    return timed.withWatermark("event_time_utc", delay).dropDuplicatesWithinWatermark(list(NATURAL_KEY))


def stream_sessions(
    stream: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = "10 minutes", zone: str = LOCAL_ZONE
) -> DataFrame:
    """Sessions as they close: user, session id, start, end, events.

    ``session_window`` merges events closer than its gap; the batch rule
    splits at a gap of exactly ``gap_seconds`` whole seconds. With times
    truncated to the second and a gap one microsecond short, both agree.
    """
    timed = with_local_time(stream, zone).withColumn("_sec", F.date_trunc("second", "event_time_utc"))
    gap = f"{gap_seconds - 1} seconds 999999 microseconds"
    agg = (
        timed.withWatermark("_sec", delay)
        .groupBy("user_id", F.session_window("_sec", gap).alias("_w"))
        .agg(
            F.min("event_time_utc").alias("session_start"),
            F.max("event_time_utc").alias("session_end"),
            F.count(F.lit(1)).alias("events"),
        )
    )
    return agg.select(
        "user_id",
        session_id_col(F.col("user_id"), F.unix_timestamp("session_start")).alias("session_id"),
        "session_start",
        "session_end",
        "events",
    )


_SEC_STATE = T.StructType(
    [
        T.StructField("last_s", T.LongType()),
        T.StructField("start_s", T.LongType()),
        T.StructField("pending", T.ArrayType(T.LongType())),
    ]
)
_SEC_OUT = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("second", T.LongType()),
        T.StructField("session_start", T.LongType()),
    ]
)


def _assign_starts(gap_seconds: int):
    """Per-user state over distinct seconds only: at most ``delay`` seconds
    are pending per user, however many events the user sends."""

    def fn(key: tuple[Any, ...], pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        (user,) = key
        last_s = start_s = None
        pending: set[int] = set()
        if state.exists:
            last_s, start_s, p = state.get
            pending = set(p)
        for pdf in pdfs:
            pending.update(int(x) for x in pdf["_s"])
        wm_s = state.getCurrentWatermarkMs() // 1000
        out_s, out_start, keep = [], [], []
        for s in sorted(pending):
            if s >= wm_s:  # a later event of this very second may still arrive
                keep.append(s)
                continue
            if last_s is None or s - last_s >= gap_seconds:
                start_s = s
            last_s = s if last_s is None else max(last_s, s)
            out_s.append(s)
            out_start.append(start_s)
        if keep:
            state.update((last_s, start_s, keep))
            state.setTimeoutTimestamp(max((keep[0] + 1) * 1000, state.getCurrentWatermarkMs() + 1))
        elif last_s is not None and wm_s < last_s + gap_seconds:
            state.update((last_s, start_s, []))
            state.setTimeoutTimestamp((last_s + gap_seconds) * 1000)
        else:
            state.remove()
        if out_s:
            yield pd.DataFrame({"user_id": [user] * len(out_s), "second": out_s, "session_start": out_start})

    return fn


def stream_session_starts(
    stream: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = "10 minutes", zone: str = LOCAL_ZONE
) -> DataFrame:
    """``(user_id, second, session_start, session_id)`` for every active second.

    The skew-safe streaming form: the state per user is its last second, the
    session start and the distinct seconds not yet below the watermark
    (bounded by the delay, not by the user's event rate). Events get their
    id by an equi-join on ``(user_id, second)`` where they are batched, e.g.
    in ``foreachBatch``; :func:`publish_stream` does the equivalent with the
    batch sessionizer."""
    timed = with_local_time(stream, zone).where(F.col("event_time_utc").isNotNull())
    secs = timed.withWatermark("event_time_utc", delay).select(
        "user_id", F.unix_timestamp("event_time_utc").alias("_s"), "event_time_utc"
    )
    out = secs.groupBy("user_id").applyInPandasWithState(
        _assign_starts(gap_seconds), _SEC_OUT, _SEC_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return out.withColumn("session_id", session_id_col(F.col("user_id"), F.col("session_start")))


def attach_sessions(events: DataFrame, starts: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Batch: raw events with times and the session id of their second.

    ``starts``: rows of :func:`stream_session_starts`. A hot user's events are
    spread over the seconds. Events without a start yet (not below the
    watermark, or without a time) get a NULL id."""
    timed = with_local_time(events, zone).withColumn("second", F.unix_timestamp("event_time_utc"))
    return timed.join(starts.select("user_id", "second", "session_id"), ["user_id", "second"], "left").drop("second")


def unreadable(stream: DataFrame) -> DataFrame:
    """Rows of a stream (or batch) that have no usable time or price, with a reason."""
    return with_reason(stream, quarantine_null_keys=True).where(F.col("reason").isNotNull())


def stream_daily_fact(
    stream: DataFrame, delay: str = "1 hour", zone: str = LOCAL_ZONE, rsd: float = 0.01
) -> DataFrame:
    """Per local day and event type, emitted once the day is below the watermark."""
    timed = with_local_time(stream, zone)
    agg = (
        timed.withWatermark("event_time_kst", delay)
        .groupBy(F.window("event_time_kst", "1 day").alias("_d"), "event_type")
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.approx_count_distinct("user_id", rsd).alias("approx_users"),
            money_sum("price").alias("sum_price"),
        )
    )
    return agg.select(F.date_format("_d.start", "yyyy-MM-dd").alias("event_date"), "event_type", "event_count",
                      "approx_users", "sum_price")


def stream_daily_sessions(
    stream: DataFrame, gap_seconds: int = SESSION_GAP_SECONDS, delay: str = "10 minutes", zone: str = LOCAL_ZONE
) -> DataFrame:
    """``event_date, sessions``: closed sessions per local day of their last
    event's window, emitted once the day is below the watermark.

    Two chained aggregates, both in the JVM: session windows, then days. Days
    are windows shifted by the zone's offset, so the zone must have one offset
    all year."""
    offsets = {dt.datetime(2024, m, 1, tzinfo=ZoneInfo(zone)).utcoffset() for m in (1, 4, 7, 10)}
    if len(offsets) != 1:
        raise ValueError(f"{zone} changes its offset; days would not be of equal length")
    start = (-int(offsets.pop().total_seconds())) % 86400
    timed = with_local_time(stream, zone).withColumn("_sec", F.date_trunc("second", "event_time_utc"))
    closed = (
        timed.where(F.col("user_id").isNotNull()).withWatermark("_sec", delay)
        .groupBy("user_id", F.session_window("_sec", f"{gap_seconds - 1} seconds 999999 microseconds").alias("_w"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    days = closed.groupBy(F.window(F.window_time("_w"), "1 day", startTime=f"{start} seconds").alias("_d")).agg(
        F.count(F.lit(1)).alias("sessions")
    )
    return days.select(local_date_text(to_local_clock("_d.start", zone)).alias("event_date"), "sessions")


def publish_stream(
    stream: DataFrame,
    landing: str,
    output: str,
    checkpoint: str,
    zone: str = LOCAL_ZONE,
    gap_seconds: int = SESSION_GAP_SECONDS,
    trigger: dict | None = None,
):
    """Land raw micro-batches and keep the published silver dates complete.

    Each epoch writes ``landing/event_date=D/_epoch=N`` (it replaces just its
    own folders, so a replayed epoch lands the same files once). Every date
    touched by the batch - and each later date already published, whose seeds
    may change - is recomputed from the rows landed in its own folder and
    re-published in date order. Rows whose time or price cannot be read have no
    place there; they are kept in ``landing/_quarantine/_epoch=N`` with a reason.
    """
    from cadence.operators.quality import multiset_diff
    from cadence.plans.jobs import seeds_from_published
    from cadence.plans.pipeline import transform
    from cadence.sinks.publish import publish_silver
    from cadence.sources.files import committed_dates, read_committed

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        tagged = with_reason(batch, quarantine_null_keys=True)
        timed = with_local_time(tagged, zone).withColumn("_epoch", F.lit(epoch_id))
        bad = timed.where(F.col("reason").isNotNull())
        bad.select(*RAW_COLUMNS, "reason").write.mode("overwrite").parquet(f"{landing}/_quarantine/_epoch={epoch_id}")
        good = timed.where(F.col("reason").isNull())
        (
            good.select(*RAW_COLUMNS, "event_date", "_epoch").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("event_date", "_epoch").parquet(landing)
        )
        # the dates of one micro-batch: a handful of rows
        touched = sorted(r.event_date for r in good.select("event_date").distinct().collect())
        if not touched:
            return
        later = [d for d in committed_dates(spark, output) if d > touched[0] and d not in touched]
        for d in sorted(set(touched) | set(later)):
            raw = spark.read.schema(RAW).parquet(f"{landing}/event_date={d}")
            seeds = seeds_from_published(spark, output, d, gap_seconds)
            silver = transform(raw, zone, gap_seconds, seeds=seeds).where(F.col("event_date") == d)
            if d not in touched and d > touched[-1]:
                # A later date depends on earlier ones only through the
                # published state it is seeded from: once one comes out
                # unchanged, every date after it is unchanged too.
                old = read_committed(spark, output, [d])
                if multiset_diff(old, silver.select(*old.columns)).where("only_left + only_right > 0").isEmpty():
                    break
            publish_silver(spark, silver, output, [d])

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    return writer.start()
