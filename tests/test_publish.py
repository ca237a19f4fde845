"""Gate, staged day publication, catalog, jobs: backfill vs incremental."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from cadence.plans import intake, jobs
from cadence.plans.pipeline import transform
from cadence.schema import ACTIVITY, CORRUPT_COLUMN, RAW
from cadence.sinks import publish
from cadence.sources.files import committed_dates, read_activity, read_committed, read_events
from tests.conftest import ev, raw_rows


def _write_csv(spark, rows, path):
    raw_rows(spark, rows).coalesce(1).write.option("header", True).mode("overwrite").csv(path)
    return path


def test_gate_cases(spark):
    empty = spark.createDataFrame([], ACTIVITY)
    with pytest.raises(publish.GateError, match="no rows"):
        publish.gate(spark, empty, ["2019-10-01"])
    rows = transform(raw_rows(spark, [ev("2019-10-01 00:00:00", user=None), ev("2019-10-01 00:01:00")]))
    with pytest.raises(publish.GateError, match="1 rows without a key"):
        publish.gate(spark, rows)
    ok = transform(raw_rows(spark, [ev("2019-10-01 00:00:00", user=2), ev("2019-10-01 00:01:00")]))
    (c,) = publish.gate(spark, ok, ["2019-10-01"])
    assert c.ok and c.rows == 2 and c.null_key_rows == 0


def test_publish_writes_marker_and_cleans_staging(spark, tmp_dir):
    base = os.path.join(tmp_dir, "silver")
    act = transform(raw_rows(spark, [ev("2019-10-01 00:00:00")]))
    checks = publish.publish_silver(spark, act, base, ["2019-10-01"])
    assert [c.event_date for c in checks] == ["2019-10-01"]
    assert os.path.exists(f"{base}/event_date=2019-10-01/_SUCCESS")
    assert not os.listdir(f"{base}/_staging")
    assert read_activity(spark, base).count() == 1
    assert committed_dates(spark, base) == ["2019-10-01"]


def test_failing_date_publishes_nothing(spark, tmp_dir):
    base = os.path.join(tmp_dir, "silver")
    rows = [ev("2019-10-08 15:00:00"), ev("2019-10-08 16:00:00", user=None)]  # KST 10-09 has a null user
    act = transform(raw_rows(spark, rows))
    with pytest.raises(publish.GateError, match="2019-10-09: 1 rows without a key"):
        publish.publish_silver(spark, act, base)
    assert committed_dates(spark, base) == []


def test_rerun_replaces_only_its_date(spark, tmp_dir):
    base = os.path.join(tmp_dir, "silver")
    two = transform(raw_rows(spark, [ev("2019-10-01 00:00:00"), ev("2019-10-02 00:00:00", user=5)]))
    publish.publish_silver(spark, two, base)
    again = transform(raw_rows(spark, [ev("2019-10-02 00:00:00", user=5), ev("2019-10-02 00:00:09", user=6)]))
    publish.publish_silver(spark, again, base, ["2019-10-02"])
    got = read_committed(spark, base).groupBy("event_date").count().orderBy("event_date").collect()
    assert [(r.event_date, r["count"]) for r in got] == [("2019-10-01", 1), ("2019-10-02", 2)]
    files = os.listdir(f"{base}/event_date=2019-10-02")
    assert sum(f.endswith(".parquet") for f in files) >= 1 and "_SUCCESS" in files


def test_split_daily_folders(spark, tmp_dir):
    rows = [ev("2020-03-31 14:59:00"), ev("2020-03-31 15:00:00", user=2), ev("2020-04-01 02:00:00", user=None), ev("soon"), ev(None)]
    src = _write_csv(spark, rows, f"{tmp_dir}/raw")
    took = jobs.split_daily(spark, src, f"{tmp_dir}/daily")
    assert sorted(d for d in os.listdir(f"{tmp_dir}/daily") if d.startswith("event_date")) == [
        "event_date=2020-03-31",
        "event_date=2020-04-01",
    ]
    back = spark.read.option("header", True).schema(RAW).csv(f"{tmp_dir}/daily/event_date=2020-04-01")
    assert back.columns == list(RAW.fieldNames()) and back.count() == 2
    kept = spark.read.parquet(f"{tmp_dir}/daily/_quarantine").collect()
    assert sorted(r.reason for r in kept) == ["null event_time", "unparseable event_time"]
    assert (took.input_rows, took.quarantined_rows) == (5, 2)


def test_catalog_table_and_partitions(spark, tmp_dir):
    base = os.path.join(tmp_dir, "silver")
    act = transform(raw_rows(spark, [ev("2019-10-01 00:00:00"), ev("2019-10-02 00:00:00")]))
    publish.publish_silver(spark, act, base)
    name = "activity_" + os.path.basename(tmp_dir).replace("-", "_")
    publish.ensure_activity_table(spark, base, name)
    publish.repair_table(spark, name)
    parts = sorted(r[0] for r in publish.show_partitions(spark, name).collect())
    assert parts == ["event_date=2019-10-01", "event_date=2019-10-02"]
    assert spark.table(name).where("event_date = '2019-10-02'").count() == 1


def _chain_rows(start: dt.datetime, hours: int, step_min: int = 4):
    rows, t, i = [], start, 0
    while t < start + dt.timedelta(hours=hours):
        rows.append(ev(t.strftime("%Y-%m-%d %H:%M:%S"), user=1, product=i))
        rows.append(ev(t.strftime("%Y-%m-%d %H:%M:%S"), user=2, product=i, etype="cart") if i % 50 else ev(
            (t + dt.timedelta(minutes=30 * (i % 7))).strftime("%Y-%m-%d %H:%M:%S"), user=2, product=i))
        t += dt.timedelta(minutes=step_min)
        i += 1
    return rows


def test_incremental_seeded_equals_backfill(spark, tmp_dir):
    # user 1: one event every 4 minutes for 49 hours -> one session over three dates
    rows = _chain_rows(dt.datetime(2019, 9, 30, 15, 0, 0), 49)
    src = _write_csv(spark, rows, f"{tmp_dir}/raw")
    jobs.split_daily(spark, src, f"{tmp_dir}/daily")
    back = jobs.run_backfill(spark, src, f"{tmp_dir}/backfill")
    dates = back.dates
    assert len(dates) == 3 and back.output_rows <= back.input_rows
    for d in dates:
        jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/incr", d)
    lookback = f"{tmp_dir}/lookback"
    for d in dates:
        jobs.run_incremental(spark, f"{tmp_dir}/daily", lookback, d, lookback_days=1, seed=False)
    b = read_committed(spark, f"{tmp_dir}/backfill")
    i = read_committed(spark, f"{tmp_dir}/incr")
    assert b.exceptAll(i).count() == 0 and i.exceptAll(b).count() == 0
    # the reference's lookback mode cannot see the chain's start on day 3
    lb = read_committed(spark, lookback).where(F.col("event_date") == dates[-1])
    assert lb.exceptAll(b.where(F.col("event_date") == dates[-1])).count() > 0
    # one session id for user 1 on every date
    ids = b.where("user_id = 1").select("session_id").distinct().count()
    assert ids == 1


def test_backfill_quarantines_malformed_rows(spark, tmp_dir):
    rows = [ev("2019-10-01 00:00:00"), ev("garbage"), ev("2019-10-01 00:01:00", user=None)]
    src = _write_csv(spark, rows, f"{tmp_dir}/raw")
    rep = jobs.run_backfill(
        spark, src, f"{tmp_dir}/silver", quarantine_path=f"{tmp_dir}/quarantine", quarantine_null_keys=True
    )
    assert (rep.input_rows, rep.quarantined_rows, rep.duplicate_rows, rep.output_rows) == (3, 2, 0, 1)
    assert spark.read.parquet(f"{tmp_dir}/quarantine").count() == 2


def test_backfill_null_user_fails_its_date(spark, tmp_dir):
    path = f"{tmp_dir}/raw.csv"
    with open(path, "w") as f:
        f.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        f.write("2019-10-08 15:00:00 UTC,view,1001,2001,c,b,10.0,7,s0\n")
        f.write("2019-10-08 16:00:00 UTC,view,1001,2001,c,b,10.0,,s1\n")
    with pytest.raises(publish.GateError, match="2019-10-09: 1 rows without a key"):
        jobs.run_backfill(spark, path, f"{tmp_dir}/silver")
    assert committed_dates(spark, f"{tmp_dir}/silver") == []


def test_incremental_requires_run_date(spark, tmp_dir):
    with pytest.raises(ValueError):
        jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/silver", "")


def test_build_marts_reads_committed_only(spark, tmp_dir):
    base = f"{tmp_dir}/silver"
    act = transform(raw_rows(spark, [ev("2019-10-07 00:00:00"), ev("2019-10-08 00:00:00", user=2)]))
    publish.publish_silver(spark, act, base)
    os.remove(f"{base}/event_date=2019-10-08/_SUCCESS")  # an unfinished date
    counts = jobs.build_marts(spark, base, f"{tmp_dir}/gold", ["mart_dau", "dim_date"])
    assert counts == {"mart_dau": 1, "dim_date": 1}
    assert spark.table("gold_mart_dau").count() == 1


def test_sources_read_and_transform_sample_and_sql_marts(spark, tmp_dir):
    from cadence.sources.files import read_and_transform, read_sample, sql_marts

    rows = [ev("2019-10-07 00:00:00"), ev("2019-10-07 00:01:00", user=2), ev("2019-10-14 00:00:00", user=2)]
    src = _write_csv(spark, rows, f"{tmp_dir}/raw")
    silver = read_and_transform(spark, src)
    assert silver.count() == 3 and "session_id" in silver.columns
    assert read_sample(spark, src, 2).count() == 2
    os.makedirs(f"{tmp_dir}/sql")
    with open(f"{tmp_dir}/sql/weekly.sql", "w") as f:
        f.write("SELECT date_trunc('week', to_date(event_date)) AS week_start,\n"
                "       count(DISTINCT user_id) AS wau_users\nFROM activity GROUP BY 1 ORDER BY 1;\n")
    (weekly,) = sql_marts(spark, f"{tmp_dir}/sql", silver, ["weekly"]).values()
    assert [r.wau_users for r in weekly.collect()] == [2, 1]


def test_corrupt_rows_are_captured(spark, tmp_dir):
    from cadence.sources.files import read_events

    path = f"{tmp_dir}/raw.csv"
    with open(path, "w") as f:
        f.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        f.write("2019-10-01 00:00:00 UTC,view,1,2,c,b,1.0,7,s\n")
        f.write("2019-10-01 00:01:00 UTC,view,not-a-number,2,c,b,1.0,7,s\n")
    rows = read_events(spark, path, keep_corrupt=True).collect()
    bad = [r for r in rows if r[CORRUPT_COLUMN] is not None]
    assert len(rows) == 2 and len(bad) == 1 and "not-a-number" in bad[0][CORRUPT_COLUMN]


def test_multi_path_read_and_payload_files(spark, tmp_dir):
    from cadence.operators import marts, serving
    from cadence.sources.files import read_events

    a = _write_csv(spark, [ev("2019-10-07 00:00:00")], f"{tmp_dir}/a")
    b = _write_csv(spark, [ev("2019-10-14 00:00:00", user=2)], f"{tmp_dir}/b")
    raw = read_events(spark, f"{a},{b}")
    assert raw.count() == 2
    silver = transform(raw)
    payload = serving.publish_payload({"mart_wau": marts.mart_wau(silver), "dim_date": marts.dim_date(silver)})
    publish.write_payload(payload, f"{tmp_dir}/payload")
    assert sorted(d for d in os.listdir(f"{tmp_dir}/payload") if d.startswith("table=")) == [
        "table=dim_date",
        "table=mart_wau",
    ]
    lines = spark.read.text(f"{tmp_dir}/payload/table=mart_wau").collect()
    assert len(lines) == 2 and all('"week_start":"2019-10-' in r.value for r in lines)


def test_register_dates_adds_partitions(spark, tmp_dir):
    base = os.path.join(tmp_dir, "silver")
    act = transform(raw_rows(spark, [ev("2019-10-01 00:00:00"), ev("2019-10-02 00:00:00")]))
    publish.publish_silver(spark, act, base)
    name = "act_reg_" + os.path.basename(tmp_dir).replace("-", "_")
    publish.ensure_activity_table(spark, base, name)
    publish.register_dates(spark, ["2019-10-02"], base, name)
    assert [r[0] for r in publish.show_partitions(spark, name).collect()] == ["event_date=2019-10-02"]
    assert spark.table(name).count() == 1
    publish.register_dates(spark, ["2019-10-01", "2019-10-02"], base, name)  # idempotent
    assert spark.table(name).count() == 2


# --- nothing published is lost -------------------------------------------------


@pytest.mark.parametrize("fails", ["rename 1", "rename 2", "touch 1"])
def test_a_failed_swap_keeps_a_complete_copy_of_every_date(spark, tmp_dir, monkeypatch, fails):
    base = os.path.join(tmp_dir, "silver")
    old = [ev(f"2020-07-{d:02d} 01:00:00", user=d) for d in range(1, 6)]
    publish.publish_silver(spark, transform(raw_rows(spark, old)), base)
    fresh = transform(raw_rows(spark, old + [ev(f"2020-07-{d:02d} 02:00:00", user=d) for d in range(1, 7)]))
    what, nth = fails.split()
    real, calls = getattr(publish.fs, what), []

    def flaky(spark, path, *args, **kw):
        if "event_date=2020-07-03" in path:
            calls.append(path)
            if len(calls) == int(nth):
                raise RuntimeError("injected")
        return real(spark, path, *args, **kw)

    monkeypatch.setattr(publish.fs, what, flaky)
    with pytest.raises(publish.PublishError, match="2020-07-03"):
        publish.publish_silver(spark, fresh, base)
    monkeypatch.undo()
    got = {r.event_date: r["count"] for r in read_committed(spark, base).groupBy("event_date").count().collect()}
    assert got == {f"2020-07-{d:02d}": 2 if d != 3 else 1 for d in range(1, 6)} | {"2020-07-06": 1}
    assert publish.recover(spark, base) == []
    publish.publish_silver(spark, fresh, base)
    assert read_committed(spark, base).count() == 11


@pytest.mark.parametrize("at", [1, 2, 3])
def test_recover_after_the_driver_died(spark, tmp_dir, monkeypatch, at):
    base = os.path.join(tmp_dir, "silver")
    one = transform(raw_rows(spark, [ev("2020-07-01 01:00:00")]))
    publish.publish_silver(spark, one, base)
    steps = []

    def dies(fn):
        def step(*args, **kw):
            steps.append(fn)
            if len(steps) >= at:
                raise KeyboardInterrupt  # also what would put things back fails
            return fn(*args, **kw)

        return step

    monkeypatch.setattr(publish.fs, "rename", dies(publish.fs.rename))
    monkeypatch.setattr(publish.fs, "touch", dies(publish.fs.touch))
    with pytest.raises((KeyboardInterrupt, publish.PublishError)):
        publish.publish_silver(spark, transform(raw_rows(spark, [ev("2020-07-01 01:00:00"), ev("2020-07-01 01:00:01")])), base)
    monkeypatch.undo()
    publish.recover(spark, base)
    assert committed_dates(spark, base) == ["2020-07-01"] and read_committed(spark, base).count() == 1


def test_a_mart_is_replaced_whole_or_not_at_all(spark, tmp_dir, monkeypatch):
    name = "m" + os.path.basename(tmp_dir).replace("-", "_")
    assert publish.write_mart(spark, spark.range(3), tmp_dir, name) == 3
    monkeypatch.setattr(publish.fs, "touch", lambda *a: (_ for _ in ()).throw(RuntimeError("injected")))
    with pytest.raises(RuntimeError):
        publish.write_mart(spark, spark.range(5), tmp_dir, name)
    monkeypatch.undo()
    assert spark.read.parquet(f"{tmp_dir}/{name}").count() == 3
    assert publish.write_mart(spark, spark.range(4), tmp_dir, name) == 4 and spark.table(f"gold_{name}").count() == 4
    assert publish.write_mart(spark, spark.range(4).selectExpr("id", "'x' AS y"), tmp_dir, name) == 4
    assert spark.table(f"gold_{name}").columns == ["id", "y"]


# --- no row is lost without a trace --------------------------------------------

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"


def _lines(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(HEADER + "".join(x + "\n" for x in lines))
    return path


GOOD = "2020-07-01 01:00:00 UTC,view,1,2,c,b,1.5,7,s"
BAD = ["not a time,view,1,2,c,b,1.5,7,s", "2020-07-01 01:00:01 UTC,view,x1,2,c,b,1.5,7,s", "2020-07-01 01:00:02 UTC,view,1,2,c,b,abc,7,s", "2020-07-01 01:00:03 UTC,view,1,2,c,b,NaN,7,s"]


def test_backfill_and_incremental_keep_every_bad_line(spark, tmp_dir):
    path = _lines(f"{tmp_dir}/raw.csv", GOOD, GOOD, *BAD)
    rep = jobs.run_backfill(spark, path, f"{tmp_dir}/a")
    assert (rep.input_rows, rep.quarantined_rows, rep.duplicate_rows, rep.output_rows, rep.sessions) == (6, 4, 1, 1, 1)
    kept = spark.read.parquet(f"{tmp_dir}/a/_quarantine/{rep.run_id}").collect()
    assert sorted(r.reason for r in kept) == ["price out of range", "unparseable event_time", "unreadable line", "unreadable line"]
    _lines(f"{tmp_dir}/daily/event_date=2020-07-01/d.csv", GOOD, GOOD, *BAD, "2020-07-05 01:00:00 UTC,view,1,2,c,b,1.5,7,s")
    rep = jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/b", "2020-07-01")
    assert (rep.input_rows, rep.quarantined_rows, rep.duplicate_rows, rep.output_rows) == (7, 5, 1, 1)
    kept = spark.read.parquet(f"{tmp_dir}/b/_quarantine/{rep.run_id}").collect()
    assert "outside the run date" in {r.reason for r in kept}
    _lines(f"{tmp_dir}/daily/event_date=2020-07-02/d.csv", ",view,1,2,c,b,1.5,7,s", "2020-07-02 01:00:00 UTC,view,1,2,c,b,1.5,7,s")
    with pytest.raises(publish.GateError, match="without a key"):  # a NULL time fails its date
        jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/b", "2020-07-02")
    log = jobs.run_log(spark, f"{tmp_dir}/b").orderBy("started_at").collect()
    assert [r.status.split(":")[0] for r in log] == ["ok", "GateError"] and log[0].duplicate_rows == 1


# --- incremental runs equal a backfill -----------------------------------------


def test_first_day_hole_and_late_rows_equal_backfill(spark, tmp_dir):
    rows = _chain_rows(dt.datetime(2020, 7, 1, 15, 0, 0), 95)  # local dates 07-02 to 07-05, one chain for user 1
    late = [r for r in rows if r["event_time"].startswith("2020-07-02 14:5") and r["user_id"] == 1]
    early = [r for r in rows if r not in late]
    daily, out = f"{tmp_dir}/daily", f"{tmp_dir}/silver"
    jobs.split_daily(spark, _write_csv(spark, early, f"{tmp_dir}/early"), daily)
    table = "chain_" + os.path.basename(tmp_dir).replace("-", "_")
    jobs.run_incremental(spark, daily, out, "2020-07-03", table=table)  # a first run, with an earlier folder
    jobs.run_incremental(spark, daily, out, "2020-07-05")  # a hole on 07-04
    jobs.run_incremental(spark, daily, out, "2020-07-04")
    jobs.run_incremental(spark, daily, out, "2020-07-02")
    src = _write_csv(spark, rows, f"{tmp_dir}/all")
    jobs.split_daily(spark, src, f"{tmp_dir}/daily2")  # the late rows arrive in 07-02's folder
    rep = jobs.run_incremental(spark, f"{tmp_dir}/daily2", out, "2020-07-02", table=table)
    assert late and rep.republished == ["2020-07-03", "2020-07-04", "2020-07-05"]
    jobs.run_backfill(spark, src, f"{tmp_dir}/backfill")
    a, b = read_committed(spark, f"{tmp_dir}/backfill"), read_committed(spark, out)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert {r[0][-10:] for r in publish.show_partitions(spark, table).collect()} == {f"2020-07-0{d}" for d in (2, 3, 4, 5)}
    again = jobs.run_incremental(spark, f"{tmp_dir}/daily2", out, "2020-07-02")
    assert again.republished == []


def _plans(monkeypatch):
    """The optimized plans of what jobs publish from here on."""
    plans, publish_silver = [], publish.publish_silver

    def seen(spark, silver, *rest, **options):
        plans.append(silver._jdf.queryExecution().optimizedPlan().toString())
        return publish_silver(spark, silver, *rest, **options)

    monkeypatch.setattr(publish, "publish_silver", seen)
    return plans


def test_a_day_is_planned_without_text_and_without_a_filter_on_its_date(spark, tmp_dir, monkeypatch):
    src = _write_csv(spark, _chain_rows(dt.datetime(2020, 7, 1, 15, 0, 0), 60), f"{tmp_dir}/raw")
    jobs.split_daily(spark, src, f"{tmp_dir}/daily")
    plans = _plans(monkeypatch)
    jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/silver", "2020-07-03")  # 07-02 is context
    jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/silver", "2020-07-04")
    assert len(plans) == 2 and " csv" not in plans[0]  # context is parsed once, not once per reader
    # a filter on the date reaches one session path only, which then has a de-duplication shuffle of its own
    assert "2020-07-04" not in plans[1]


def test_context_lines_that_do_not_fit_the_schema_bridge_no_session(spark, tmp_dir):
    line = "2020-07-01 14:{} UTC,view,{},2,c,b,1.5,7,s"
    lines = [line.format("50:00", 1), line.format("54:00", "x1"), line.format("58:00", 1)]  # the bad one is in the gap
    _lines(f"{tmp_dir}/daily/event_date=2020-07-01/d.csv", *lines)
    _lines(f"{tmp_dir}/daily/event_date=2020-07-02/d.csv", "2020-07-01 15:01:00 UTC,view,1,2,c,b,1.5,7,s")
    for i, options in enumerate(({}, {"hot_rows": 0}, {"hot_rows": None}, {"seed": False})):
        jobs.run_incremental(spark, f"{tmp_dir}/daily", f"{tmp_dir}/out{i}", "2020-07-02", **options)
        got = read_committed(spark, f"{tmp_dir}/out{i}").collect()
        assert [r.session_id for r in got] == [f"7_{int(dt.datetime(2020, 7, 1, 14, 58, tzinfo=dt.timezone.utc).timestamp())}"], options


def test_intake_keeps_extra_columns_with_the_usable_rows_only(spark, tmp_dir):
    path = _lines(f"{tmp_dir}/raw.csv", GOOD, *BAD)
    tagged = intake.split(read_events(spark, path, keep_corrupt=True), keep=("event_time_utc",))
    staged = intake.stage(spark, tagged, f"{tmp_dir}/staged")
    assert (staged.input_rows, staged.quarantined_rows) == (5, 4)
    assert staged.valid.columns == [*RAW.fieldNames(), "event_time_utc"] and staged.valid.count() == 1
    assert staged.quarantined.columns == intake.QUARANTINE.fieldNames() and staged.quarantined.count() == 4
    assert not [d for d in os.listdir(f"{tmp_dir}/staged") if "=" in d]  # no partitions: nothing is sorted
