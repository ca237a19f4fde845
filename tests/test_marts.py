"""Marts on a small ``activity`` view."""

from __future__ import annotations

import datetime as dt
import math

import pytest

from cadence.operators import marts, serving

D = dt.date
SCHEMA = "user_id long, session_id string, event_type string, price double, event_date string"


@pytest.fixture(scope="module")
def activity(spark):
    # two ISO weeks of March 2021: users 41 and 42 on Tuesday and Friday, 41 and 43 on the next Wednesday
    rows = [
        (41, "p", "view", 3.5, "2021-03-02"),
        (41, "p", "view", 8.0, "2021-03-02"),
        (41, "p", "cart", 8.0, "2021-03-02"),
        (41, "q", "purchase", 8.005, "2021-03-05"),
        (42, "r", "view", 1.0, "2021-03-05"),
        (42, "r", "cart", 1.0, "2021-03-05"),
        (42, "r", "purchase", 0.0004, "2021-03-05"),
        (41, "s", "view", 2.0, "2021-03-10"),
        (43, "t", "view", 2.0, "2021-03-10"),
        (43, "t", "purchase", 6.25, "2021-03-10"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_dim_date(activity):
    rows = marts.dim_date(activity).collect()
    assert [r.date_key for r in rows] == [f"2021-03-{d:02d}" for d in range(2, 11)]
    assert (rows[0].dow, rows[0].is_weekend, rows[0].iso_week, rows[0].month) == (3, False, D(2021, 3, 1), "2021-03")
    assert [(r.dow, r.is_weekend) for r in rows[4:7]] == [(7, True), (1, True), (2, False)]


def test_fact_daily_activity(activity):
    rows = {(r.event_date, r.event_type): (r.event_count, r.distinct_users, r.distinct_sessions, r.sum_price) for r in marts.fact_daily_activity(activity).collect()}
    assert rows["2021-03-02", "view"] == (2, 1, 1, 11.5)
    assert rows["2021-03-05", "purchase"] == (2, 2, 2, 8.0054)
    assert len(rows) == 7


def test_dau_wau_mau(activity):
    assert [(r.event_date, r.dau_users, r.dau_sessions) for r in marts.mart_dau(activity).collect()] == [
        ("2021-03-02", 1, 1), ("2021-03-05", 2, 2), ("2021-03-10", 2, 2),
    ]
    assert [(r.wau_users, r.wau_sessions) for r in marts.mart_wau(activity).collect()] == [(2, 3), (2, 2)]
    assert [r.wau_users for r in marts.wau_users(activity).collect()] == [2, 2]
    assert [(r.month, r.mau_users) for r in marts.mart_mau(activity).collect()] == [("2021-03", 3)]


def test_stickiness(activity):
    rows = marts.mart_stickiness(activity).collect()
    assert [(r.date.day, r.dau, r.mau) for r in rows] == [(2, 1, 3), (5, 2, 3), (10, 2, 3)]
    assert [r.stickiness for r in rows] == pytest.approx([1 / 3, 2 / 3, 2 / 3])


def test_funnel(activity):
    w1, w2 = marts.mart_funnel(activity).collect()
    assert (w1.users_view, w1.users_cart, w1.users_purchase, w1.view_to_cart, w1.cart_to_purchase) == (2, 2, 2, 1.0, 1.0)
    assert (w2.users_view, w2.users_cart, w2.users_purchase, w2.view_to_cart, w2.cart_to_purchase) == (2, 0, 1, 0.0, None)


def test_cvr(activity):
    w1, w2 = marts.mart_cvr(activity).collect()
    assert (w1.visitors, w1.purchasers, w1.cvr, w1.cvr_wow_delta) == (2, 2, 1.0, None)
    assert (w2.visitors, w2.purchasers, w2.cvr, w2.cvr_wow_delta) == (2, 1, 0.5, -0.5)


def test_revenue_and_arppu(activity):
    w1, w2 = marts.mart_revenue(activity).collect()
    assert (w1.revenue, w1.purchases, w1.aov) == (8.0054, 2, 4.0027)
    assert (w2.revenue, w2.purchases, w2.aov) == (6.25, 1, 6.25)
    assert [(a.buyers, a.arppu) for a in marts.mart_arppu(activity).collect()] == [(2, 4.0027), (1, 6.25)]


def test_money_is_not_rounded_and_odd_prices_show(spark):
    small = spark.createDataFrame([(i, f"s{i}", "purchase", 0.004, "2021-03-02") for i in range(1000)], SCHEMA)
    odd = spark.createDataFrame(
        [(1, "a", "purchase", math.nan, "2021-03-09"), (1, "a", "purchase", 5.0, "2021-03-09"), (2, "b", "purchase", 1e21, "2021-03-16"),
         (2, "b", "purchase", 1.5, "2021-03-16"), (3, "c", "purchase", None, "2021-03-23")], SCHEMA)
    both = small.unionByName(odd)
    for source in (both, marts.activity_grain(both)):
        rows = marts.mart_revenue(source).collect()
        assert (rows[0].revenue, rows[0].purchases, rows[0].aov) == (4.0, 1000, 0.004)
        assert math.isnan(rows[1].revenue) and math.isnan(rows[1].aov) and rows[2].revenue == 1e21 and rows[3].revenue is None
        assert math.isnan(marts.fact_daily_activity(source).where("event_date = '2021-03-09'").first().sum_price)
        assert marts.mart_arppu(source).first().arppu == 0.004


def test_retention(spark):
    seen = [(61, "2021-03-02"), (61, "2021-03-04"), (61, "2021-03-16"), (62, "2021-03-07"), (62, "2021-05-11"), (63, "2021-03-16")]
    views = spark.createDataFrame(seen, "user_id long, event_date string")
    first, second = D(2021, 3, 1), D(2021, 3, 15)
    got = [(r.cohort_week, r.week_offset, r.active_users, r.cohort_users, r.retention_rate) for r in marts.mart_retention(views).collect()]
    assert got == [(first, 0, 2, 2, 1.0), (first, 2, 1, 2, 0.5), (first, 10, 1, 2, 0.5), (second, 0, 1, 1, 1.0)]
    m = serving.retention_matrix(marts.mart_retention(views)).collect()
    assert [r.rates for r in m] == [[1.0, None, 0.5, *[None] * 7, 0.5], [1.0]]
    assert serving.retention_cells(marts.mart_retention(views)).count() == 12


def test_empty_week_positional_vs_calendar(spark):
    rows = [(1, "a", "view", 0.0, "2019-10-07"), (1, "a", "purchase", 5.0, "2019-10-07"), (2, "b", "view", 0.0, "2019-10-21")]
    df = spark.createDataFrame(rows, "user_id long, session_id string, event_type string, price double, event_date string")
    pos = marts.mart_cvr(df).collect()
    cal = marts.cvr_wow_calendar(df).collect()
    assert pos[1].cvr_wow_delta == pytest.approx(-1.0)  # compared with the previous row
    assert cal[1].cvr_wow_delta is None  # the calendar week before is empty


def test_purchase_without_cart(spark):
    df = spark.createDataFrame(
        [(1, "a", "purchase", 1.0, "2019-10-07"), (2, "b", "view", 0.0, "2019-10-07")],
        "user_id long, session_id string, event_type string, price double, event_date string",
    )
    (f,) = marts.mart_funnel(df).collect()
    assert f.users_cart == 0 and f.cart_to_purchase is None


def test_iso_week_year_edge(spark):
    df = spark.createDataFrame(
        [(1, "a", "view", 0.0, "2019-12-30"), (2, "b", "view", 0.0, "2020-01-01")],
        "user_id long, session_id string, event_type string, price double, event_date string",
    )
    (w,) = marts.mart_wau(df).collect()
    assert w.week_start == D(2019, 12, 30) and w.wau_users == 2


def test_wau_session_crossing_week_edge_counts_twice(spark):
    df = spark.createDataFrame(
        [(1, "x", "view", 0.0, "2019-10-13"), (1, "x", "view", 0.0, "2019-10-14")],
        "user_id long, session_id string, event_type string, price double, event_date string",
    )
    assert [r.wau_sessions for r in marts.mart_wau(df).collect()] == [1, 1]


def test_serving_views(activity):
    latest = serving.funnel_latest(activity).collect()
    assert len(latest) == 1 and latest[0].week_start == D(2021, 3, 8)
    dense = serving.dau_dense(activity).collect()
    assert [r.dau_users for r in dense] == [1, 0, 0, 2, 0, 0, 0, 0, 2]
    spu = serving.sessions_per_user(activity).collect()
    assert [r.sessions_per_user for r in spu] == [1.5, 1.0]


def test_payload_keeps_nulls_and_dates(spark):
    df = spark.createDataFrame(
        [(D(2019, 10, 7), 100, 5, 0.05, None), (D(2019, 10, 14), 120, 9, 0.075, 0.025)],
        "week_start date, visitors long, purchasers long, cvr double, cvr_wow_delta double",
    )
    recs = [r.record for r in serving.payload_records(df, "mart_cvr").orderBy("record").collect()]
    assert len(recs) == 2
    assert '"week_start":"2019-10-07"' in recs[0] and '"cvr_wow_delta":null' in recs[0]
