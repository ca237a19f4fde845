"""Streaming operators against their batch counterparts (file source, availableNow)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from cadence.functions.timecols import with_local_time
from cadence.operators.sessions import sessionize
from cadence.plans.pipeline import transform
from cadence.sources.files import read_committed
from cadence.streaming.activity import (
    attach_sessions,
    publish_stream,
    read_event_stream,
    stream_daily_fact,
    stream_daily_sessions,
    stream_dedup,
    stream_session_starts,
    stream_sessions,
)
from tests.conftest import ev, raw_rows

START = dt.datetime(2019, 10, 1, 14, 0, 0)


def _rows(n_users=3, steps=(0, 60, 299, 300, 301, 20, 900, 5, 1800, 299, 1)):
    out = []
    for u in range(n_users):
        t = START + dt.timedelta(seconds=17 * u)
        for i, step in enumerate(steps * 3):
            t += dt.timedelta(seconds=step)
            out.append(ev(t.strftime("%Y-%m-%d %H:%M:%S"), user=u, product=i, etype=("view", "cart", "purchase")[i % 3],
                          price=float(i)))
    return out


def _write(spark, rows, path):
    raw_rows(spark, rows).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def _drain(df, tmp_dir, mode="append"):
    name = "q_" + uuid.uuid4().hex[:8]
    q = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", os.path.join(tmp_dir, "ckpt-" + name))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return df.sparkSession.table(name)


def _flushed(spark, tmp_dir, rows):
    """Two input folders: the rows, then one far-later event that moves the watermark."""
    _write(spark, rows, f"{tmp_dir}/in/a")
    late = (START + dt.timedelta(days=3)).strftime("%Y-%m-%d %H:%M:%S")
    _write(spark, [ev(late, user=99)], f"{tmp_dir}/in/b")
    return read_event_stream(spark, f"{tmp_dir}/in/*", max_files_per_trigger=1)


def test_attached_session_ids_equal_batch(spark, tmp_dir):
    rows = _rows()
    starts = _drain(stream_session_starts(_flushed(spark, tmp_dir, rows)), tmp_dir)
    out = attach_sessions(raw_rows(spark, rows), starts)
    batch = sessionize(with_local_time(raw_rows(spark, rows)))
    got = {(r.user_id, r.product_id): r.session_id for r in out.where("user_id <> 99").collect()}
    want = {(r.user_id, r.product_id): r.session_id for r in batch.collect()}
    assert got == want


def test_stream_sessions_match_batch_sessions(spark, tmp_dir):
    rows = _rows()
    out = _drain(stream_sessions(_flushed(spark, tmp_dir, rows)), tmp_dir)
    batch = sessionize(with_local_time(raw_rows(spark, rows)))
    want = {r.session_id: r["count"] for r in batch.groupBy("session_id").count().collect()}
    got = {r.session_id: r.events for r in out.where("user_id <> 99").collect()}
    assert got == want


def test_stream_dedup(spark, tmp_dir):
    rows = _rows(1)
    dup = [dict(r, price=r["price"] + 1) for r in rows[:5]]
    out = _drain(stream_dedup(_flushed(spark, tmp_dir, rows + dup), delay="1 day"), tmp_dir)
    assert out.where("user_id <> 99").count() == len(rows)


def test_stream_daily_fact(spark, tmp_dir):
    rows = _rows()
    out = _drain(stream_daily_fact(_flushed(spark, tmp_dir, rows)), tmp_dir)
    batch = with_local_time(raw_rows(spark, rows)).groupBy("event_date", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("u")
    )
    want = {(r.event_date, r.event_type): (r.n, r.u) for r in batch.collect()}
    got = {(r.event_date, r.event_type): (r.event_count, r.approx_users) for r in out.collect()}
    assert got == want


def test_stream_daily_sessions(spark, tmp_dir):
    rows = _rows()
    out = _drain(stream_daily_sessions(_flushed(spark, tmp_dir, rows)), tmp_dir)
    last = F.max("event_time_utc").alias("t")
    ends = sessionize(with_local_time(raw_rows(spark, rows))).groupBy("session_id").agg(last)
    day = F.date_format(F.from_utc_timestamp(F.col("t") + F.expr("INTERVAL 299 SECONDS"), "Asia/Seoul"), "yyyy-MM-dd")
    want = {r.d: r["count"] for r in ends.groupBy(day.alias("d")).count().collect()}
    assert {r.event_date: r.sessions for r in out.collect()} == want and len(want) > 1


def test_publish_stream_equals_backfill(spark, tmp_dir):
    rows = _rows()
    bad = [ev("never", user=5), ev(None, user=6), ev("2019-10-01 14:00:00", user=None)]
    half = len(rows) // 2
    _write(spark, rows[:half], f"{tmp_dir}/in/a")
    _write(spark, rows[half:] + bad, f"{tmp_dir}/in/b")
    stream = read_event_stream(spark, f"{tmp_dir}/in/*", max_files_per_trigger=1)
    q = publish_stream(stream, f"{tmp_dir}/landing", f"{tmp_dir}/silver", f"{tmp_dir}/ckpt")
    q.awaitTermination()
    published = read_committed(spark, f"{tmp_dir}/silver")
    backfill = transform(raw_rows(spark, rows)).select(*published.columns)
    assert published.exceptAll(backfill).count() == 0 and backfill.exceptAll(published).count() == 0
    kept = spark.read.parquet(f"{tmp_dir}/landing/_quarantine").collect()
    assert sorted(r.reason for r in kept) == ["null event_time", "null user_id", "unparseable event_time"]


def test_stream_session_starts_equal_batch(spark, tmp_dir):
    rows = _rows()
    out = _drain(stream_session_starts(_flushed(spark, tmp_dir, rows)), tmp_dir)
    batch = sessionize(with_local_time(raw_rows(spark, rows))).select(
        "user_id", F.unix_timestamp("event_time_utc").alias("second"), "session_id"
    ).distinct()
    want = {(r.user_id, r.second): r.session_id for r in batch.collect()}
    got = {(r.user_id, r.second): r.session_id for r in out.where("user_id <> 99").collect()}
    assert got == want


def test_publish_stream_late_event_republishes_next_date(spark, tmp_dir):
    # chain every 4 minutes over local midnight (15:00 UTC); the 14:56 event arrives late
    times = [dt.datetime(2019, 10, 1, 14, 40) + dt.timedelta(minutes=4 * k) for k in range(10)]
    rows = [ev(t.strftime("%Y-%m-%d %H:%M:%S"), user=7, product=k) for k, t in enumerate(times)]
    late = [r for r in rows if r["event_time"].startswith("2019-10-01 14:56")]
    early = [r for r in rows if r not in late]
    _write(spark, early, f"{tmp_dir}/in/a")
    _write(spark, late, f"{tmp_dir}/in/b")
    stream = read_event_stream(spark, f"{tmp_dir}/in/*", max_files_per_trigger=1)
    publish_stream(stream, f"{tmp_dir}/landing", f"{tmp_dir}/silver", f"{tmp_dir}/ckpt").awaitTermination()
    published = read_committed(spark, f"{tmp_dir}/silver")
    backfill = transform(raw_rows(spark, rows)).select(*published.columns)
    assert published.exceptAll(backfill).count() == 0 and backfill.exceptAll(published).count() == 0
    assert published.select("session_id").distinct().count() == 1
