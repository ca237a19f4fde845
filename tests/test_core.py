"""Time, dedup, sessions and the silver transform on inline rows."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from cadence.functions.timecols import with_local_time
from cadence.operators.dedup import dedup_events, duplicate_rate
from cadence.operators.quality import quarantine_counts, split_valid_invalid
from cadence.operators.sessions import (
    last_sessions,
    midnight_sessions,
    session_summary,
    sessionize,
    sessionize_two_level,
    sessionize_window,
)
from cadence.plans.pipeline import transform
from tests.conftest import ev, raw_rows


def _sessions(spark, times, user=1, gap=300):
    df = with_local_time(raw_rows(spark, [ev(f"2019-10-01 {t}", user=user, product=i) for i, t in enumerate(times)]))
    return sessionize(df, gap)


# --- time ---------------------------------------------------------------------


def test_local_date_crosses_midnight(spark):
    df = with_local_time(raw_rows(spark, [ev("2020-02-28 14:59:59"), ev("2020-02-28 15:00:00"), ev("2020-12-31 20:30:00")]))
    got = sorted(r.event_date for r in df.collect())
    assert got == ["2020-02-28", "2020-02-29", "2021-01-01"]


def test_malformed_time_is_quarantined_not_fatal(spark):
    df = raw_rows(spark, [ev("garbage"), ev(None), ev("2019-10-01 00:00:00", user=None), ev("2019-10-01 00:00:00")])
    valid, invalid = split_valid_invalid(df)
    assert valid.count() == 3 and [r.reason for r in invalid.collect()] == ["unparseable event_time"]
    valid, invalid = split_valid_invalid(df, quarantine_null_keys=True)
    assert valid.count() == 1
    reasons = sorted(r.reason for r in invalid.collect())
    assert reasons == ["null event_time", "null user_id", "unparseable event_time"]
    q = quarantine_counts(df).first()
    assert (q.rows, q.null_event_time, q.unparseable_event_time, q.null_user_id, q.valid_rows) == (4, 1, 1, 1, 1)


# --- dedup --------------------------------------------------------------------


def test_dedup_keeps_lowest_price(spark):
    df = raw_rows(
        spark,
        [
            ev("2020-05-04 08:15:30", product=31, price=12.4),
            ev("2020-05-04 08:15:30", product=31, price=12.39),
            ev("2020-05-04 08:15:30", product=31, price=40.0),
            ev("2020-05-04 08:15:31", product=31, price=40.0),
        ],
    )
    out = dedup_events(df).orderBy("event_time").collect()
    assert [r.price for r in out] == [12.39, 40.0]


def test_dedup_nulls_last_and_identical_rows(spark):
    df = raw_rows(
        spark,
        [
            ev("2019-10-01 00:00:00", price=None),
            ev("2019-10-01 00:00:00", price=7.0),
            ev("2019-10-01 00:05:00"),
            ev("2019-10-01 00:05:00"),
        ],
    )
    out = dedup_events(df).orderBy("event_time").collect()
    assert [r.price for r in out] == [7.0, None]


def test_dedup_without_tiebreak_columns(spark):
    df = raw_rows(spark, [ev("2019-10-01 00:00:00"), ev("2019-10-01 00:00:00")]).select(
        "user_id", "event_time", "event_type", "product_id"
    )
    assert dedup_events(df).count() == 1


def test_duplicate_rate(spark):
    df = raw_rows(
        spark,
        [
            ev("2019-10-01 00:00:00", price=1.0),
            ev("2019-10-01 00:00:00", price=1.0),
            ev("2019-10-01 00:00:00", price=2.0),
            ev("2019-10-01 00:01:00", price=None),
            ev("2019-10-01 00:01:00", price=None),
        ],
    )
    r = duplicate_rate(df).first()
    assert (r.rows, r.exact_duplicates, r.key_duplicates) == (5, 2, 3)


# --- sessions -----------------------------------------------------------------


def test_gap_boundaries(spark):
    def n(times):
        return _sessions(spark, times).select("session_id").distinct().count()

    assert n(["07:21:10", "07:26:10"]) == 2  # exactly the gap
    assert n(["07:21:10", "07:26:09"]) == 1  # one second short of it
    assert n(["07:21:10", "07:21:10"]) == 1
    assert n(["07:21:10"]) == 1


def test_session_over_local_midnight_keeps_one_id(spark):
    s = _sessions(spark, ["14:57:40", "15:02:05"])
    rows = s.collect()
    assert len({r.session_id for r in rows}) == 1
    assert sorted(r.event_date for r in rows) == ["2019-10-01", "2019-10-02"]
    assert midnight_sessions(s).count() == 1


def test_session_id_is_user_and_start(spark):
    ids = {r.session_id for r in _sessions(spark, ["03:04:05", "03:08:00"], user=23).collect()}
    assert ids == {"23_1569899045"}


def test_same_second_ties_are_order_free(spark):
    rows = [ev("2019-10-01 00:00:00", etype=t, product=p) for t, p in [("view", 2), ("cart", 1), ("purchase", 3)]]
    rows.append(ev("2019-10-01 00:10:00", etype="view"))
    ids = []
    for perm in (rows, list(reversed(rows))):
        s = sessionize(with_local_time(raw_rows(spark, perm)))
        ids.append(sorted((r.event_type, r.session_id) for r in s.collect()))
    assert ids[0] == ids[1]
    assert len({sid for _, sid in ids[0]}) == 2


def test_null_user_and_null_time(spark):
    df = with_local_time(
        raw_rows(spark, [ev("2019-10-01 00:00:00", user=None), ev(None, user=1), ev("2019-10-01 00:00:00", user=1)])
    )
    b = sorted((str(r.user_id), str(r.event_time), r.session_id) for r in sessionize_window(df).collect())
    for hot_rows in (None, 0, 1):
        a = sorted((str(r.user_id), str(r.event_time), r.session_id) for r in sessionize(df, hot_rows=hot_rows).collect())
        assert a == b, hot_rows
    assert ("None", "2019-10-01 00:00:00 UTC", "1569888000") in a
    assert ("1", "None", "1") in a


def test_two_level_equals_single_window_on_random_data(spark):
    rnd = random.Random(7)
    rows = []
    for u in range(6):
        t = 1569888000
        for _ in range(120):
            t += rnd.choice([0, 1, 30, 200, 299, 300, 301, 4000, 86399, 86400, 90000])
            rows.append((u, t, rnd.choice(["view", "cart", "purchase"]), rnd.randint(1, 3)))
    df = spark.createDataFrame(rows, "user_id long, s long, event_type string, product_id long").select(
        "user_id", F.timestamp_seconds("s").alias("event_time_utc"), "event_type", "product_id"
    ).dropDuplicates()
    for gap in (300, 1800, 86400):
        b = sessionize_window(df, gap)
        for bucket in (3600, 86400):
            a = sessionize_two_level(df, gap, bucket_seconds=bucket)
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, (gap, bucket)
        mixed = sessionize(df, gap, hot_rows=100)  # some users hot, some cold
        assert mixed.exceptAll(b).count() == 0 and b.exceptAll(mixed).count() == 0, gap


def test_seeded_sessions_continue_published_state(spark):
    # day 1 alone, then day 2 seeded with day 1's last event and session start
    times = [f"2019-10-01 {h:02d}:{m:02d}:00" for h in range(23, 24) for m in range(50, 60, 4)]
    times += ["2019-10-02 00:01:00", "2019-10-02 00:04:00", "2019-10-02 00:20:00"]
    full = with_local_time(raw_rows(spark, [ev(t, product=i) for i, t in enumerate(times)]))
    whole = {r.event_time: r.session_id for r in sessionize(full).collect()}
    day1 = full.where(F.col("event_time") < "2019-10-02")
    day2 = full.where(F.col("event_time") >= "2019-10-02")
    s1 = sessionize(day1)
    seeds = s1.groupBy("user_id").agg(
        F.max(F.unix_timestamp("event_time_utc")).alias("last_s"),
        F.max(F.substring_index("session_id", "_", -1).cast("long")).alias("start_s"),
    )
    for hot_rows in (None, 5_000_000, 1):  # two-level, window with pseudo-events, split
        s2 = sessionize(day2, seeds=seeds, hot_rows=hot_rows)
        parts = {r.event_time: r.session_id for r in s1.union(s2).collect()}
        assert parts == whole, hot_rows


def test_transform_pipeline(spark):
    df = raw_rows(
        spark,
        [
            ev("2020-06-07 11:00:20", product=8, session="m"),
            ev("2020-06-07 11:00:20", product=8, session="m"),
            ev("2020-06-07 11:03:20", product=9, session="m"),
            ev("2020-06-07 11:09:01", product=8, session="n"),
        ],
    ).select("event_time", "event_type", "product_id", "user_id", "user_session")
    out = transform(df)
    assert out.count() == 3
    assert out.select("session_id").distinct().count() == 2
    assert {"session_id", "event_date", "user_session", "event_time_utc", "event_time_kst"} <= set(out.columns)
    summ = session_summary(out).orderBy("session_start").collect()
    assert [(r.events, r.duration_seconds, r.dates_touched) for r in summ] == [(2, 180, 1), (1, 0, 1)]


def _random_events(spark, seed=11, users=5, n=80):
    rnd = random.Random(seed)
    rows = []
    for u in range(users):
        t = 1569888000 + rnd.randint(0, 3000)
        for i in range(n):
            t += rnd.choice([0, 0, 1, 120, 299, 300, 600, 7200])
            rows.append((u, t, rnd.choice(["view", "cart", "purchase"]), i))
    return rows


def test_sessionize_properties(spark):
    rows = _random_events(spark)
    schema = "user_id long, s long, event_type string, product_id long"

    def frame(rs, parts):
        return spark.createDataFrame(rs, schema).repartition(parts).select(
            "user_id", F.timestamp_seconds("s").alias("event_time_utc"), "event_type", "product_id"
        )

    for hot_rows in (None, 40):
        base = sessionize(frame(rows, 3), hot_rows=hot_rows)
        shuffled = list(rows)
        random.Random(5).shuffle(shuffled)
        perm = sessionize(frame(shuffled, 7), hot_rows=hot_rows)
        assert base.exceptAll(perm).count() == 0 and perm.exceptAll(base).count() == 0  # order-free
        again = sessionize(base, hot_rows=hot_rows)
        assert again.exceptAll(base).count() == 0 and base.exceptAll(again).count() == 0  # idempotent
        one = sessionize(frame(rows, 3).where("user_id = 2"), hot_rows=hot_rows)
        sub = base.where("user_id = 2")
        assert one.exceptAll(sub).count() == 0 and sub.exceptAll(one).count() == 0  # commutes with a user filter


def _brute_force_ids(events, gap):
    """Pure-Python gap rule: per (run, user), ordered by second; new session at gap >= ``gap``."""
    by_key = {}
    for run, user, s in events:
        by_key.setdefault((run, user), []).append(s)
    ids = {}
    for (run, user), secs in by_key.items():
        start = last = None
        for s in sorted(secs):
            if last is None or s - last >= gap:
                start = s
            last = s
            ids[(run, user, s)] = f"{user}_{start}"
    return ids


def test_sessionize_against_brute_force_many_datasets(spark):
    rnd = random.Random(2024)
    events = []
    for run in range(300):
        for user in range(rnd.randint(1, 3)):
            t = 1569888000 + rnd.randint(0, 86400)
            for _ in range(rnd.randint(1, 12)):
                t += rnd.choice([0, 1, 150, 299, 300, 301, 3599, 86399, 86400, 200000])
                events.append((run, user, t))
    df = spark.createDataFrame(events, "run long, user_id long, s long").select(
        "run", "user_id", F.timestamp_seconds("s").alias("event_time_utc"), "s"
    )
    for gap, bucket, hot_rows in ((300, 86400, None), (300, 600, None), (3600, 86400, 6), (300, 86400, 5_000_000)):
        out = sessionize(df, gap, by=("run",), bucket_seconds=bucket, hot_rows=hot_rows).collect()
        got = {(r.run, r.user_id, r.s): r.session_id for r in out}
        assert got == _brute_force_ids(events, gap), (gap, bucket, hot_rows)


def test_hot_user_third_of_rows(spark):
    # user 0 holds a third of all rows, spread over 20 days; others are light
    hot = spark.range(0, 40000).select(
        F.lit(0).cast("long").alias("user_id"), (F.lit(1569888000) + F.col("id") * 43 + (F.col("id") % 7) * 61).alias("s")
    )
    cold = spark.range(0, 80000).select(
        (F.col("id") % 997 + 1).alias("user_id"), (F.lit(1569888000) + F.col("id") * 21).alias("s")
    )
    df = hot.unionByName(cold).select("user_id", F.timestamp_seconds("s").alias("event_time_utc"), F.lit("view").alias(
        "event_type"), F.lit(1).cast("long").alias("product_id")).dropDuplicates()
    b = sessionize_window(df, 300)
    # user 0 hot, the rest cold; all hot; everyone two-level
    for hot_rows in (10_000, 10, None):
        a = sessionize(df, 300, hot_rows=hot_rows)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, hot_rows


def test_transform_same_rows_on_every_session_path(spark):
    rnd = random.Random(99)
    rows = []
    for i in range(600):
        user = rnd.choice([1, 1, 1, 2, 3, None])  # user 1 is hot, some users are NULL
        sec = 1569888000 + rnd.randint(0, 3 * 86400)
        t = dt_text(sec)
        row = ev(t, user=user, product=rnd.randint(1, 4), etype=rnd.choice(["view", "cart", "purchase"]),
                 price=rnd.choice([None, 1.0, 2.5]))
        rows.append(row)
        if i % 7 == 0:  # re-delivered with another (or no) price
            rows.append(dict(row, price=rnd.choice([None, 0.5, 9.0])))
    rows.append(ev("garbage", user=2))
    raw = raw_rows(spark, rows)
    want = transform(raw, hot_rows=None)
    for hot_rows in (5_000_000, 150):
        got = transform(raw, hot_rows=hot_rows)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, hot_rows


def dt_text(sec: int) -> str:
    import datetime as _dt

    return _dt.datetime.fromtimestamp(sec, _dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S UTC")


def test_last_sessions_equal_the_last_session_of_each_user(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 2, 3, None]), 1_600_000_000 + rnd.randrange(0, 5000)) for _ in range(90)]
    df = spark.createDataFrame(rows, "user_id long, s long").withColumn("event_time_utc", F.timestamp_seconds("s"))
    df = df.withColumn("event_type", F.lit("view"))
    seeds = spark.createDataFrame([(1, 1_599_999_990, 1_599_990_000), (9, 1_599_999_000, 1_599_998_000)], "user_id long, last_s long, start_s long")
    for gap, bucket, given in ((300, 86400, None), (200, 600, seeds), (4000, 600, seeds)):
        out = sessionize(df, gap, seeds=given)
        want = {}
        for r in out.collect():
            start = int(r.session_id.split("_")[-1])
            want[r.user_id] = max(want.get(r.user_id, (0, 0)), (r.s, start))
        if given is not None:
            want[9] = (1_599_999_000, 1_599_998_000)
        got = {r.user_id: (r.last_s, r.start_s) for r in last_sessions(df, gap, bucket_seconds=bucket, seeds=given).collect()}
        assert got == want, (gap, bucket)
