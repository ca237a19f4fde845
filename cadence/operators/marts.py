"""Gold marts over the silver ``activity`` table.

Every mart is a ``DataFrame -> DataFrame`` function. Distinct counts are
built bottom-up instead of with several ``count(DISTINCT ...)`` in one
aggregate (which Catalyst plans as an ``Expand`` that multiplies the rows
before the shuffle): a session belongs to exactly one user, so

    (key, user, session)  ->  (key, user): sessions  ->  (key): users, sum(sessions)

gives exact distinct users and sessions, and every level combines map-side.
A hot key (one week holding a third of the data) is split by user and
session at the first level and only partial counts reach the last one.
Weekly/monthly distinct counts are always recomputed from silver, never
summed from daily rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.functions.timecols import exact_money, money_total, month_of, odd_money, safe_div, week_start
from cadence.schema import STAGES


def activity_grain(activity: DataFrame) -> DataFrame:
    """One row per (event_date, event_type, user_id, session_id) with its
    event count and exact revenue. Every mart below gives the same result on
    this grain as on the events (distinct counts are unchanged, additive
    measures are carried), so the gold job reads silver once."""
    return activity.groupBy("event_date", "event_type", "user_id", "session_id").agg(
        F.count(F.lit(1)).alias("events"), *_money_parts(activity)
    )


def _events(df: DataFrame) -> Column:
    """Event count of a group: rows of silver, or summed counts of the grain."""
    return F.coalesce(F.sum("events"), F.lit(0).cast("long")) if "events" in df.columns else F.count(F.lit(1))


def _money_parts(df: DataFrame) -> list[Column]:
    """Revenue of a group in two sums that can be summed again: exact
    decimals, and prices that are no amount of money (NaN, ...)."""
    if "odd_revenue" in df.columns:
        return [F.try_sum("revenue").alias("revenue"), F.sum("odd_revenue").alias("odd_revenue")]
    return [F.try_sum(exact_money("price")).alias("revenue"), F.sum(odd_money("price")).alias("odd_revenue")]


def _money(df: DataFrame) -> Column:
    """Total revenue of a group (DOUBLE)."""
    return money_total(*_money_parts(df))


def _users_and_sessions(activity: DataFrame, keys: dict[str, Column], users: str, sessions: str) -> DataFrame:
    names = list(keys)
    per_session = activity.select(*[c.alias(n) for n, c in keys.items()], "user_id", "session_id").distinct()
    per_user = per_session.groupBy(*names, "user_id").agg(F.count("session_id").alias("_ns"))
    return per_user.groupBy(*names).agg(
        F.count("user_id").alias(users), F.coalesce(F.sum("_ns"), F.lit(0)).cast("long").alias(sessions)
    )


def _stage_flags(activity: DataFrame, key: Column, key_name: str, stages: Sequence[str]) -> DataFrame:
    """One row per (key, user) with a 0/1 flag per stage reached.

    NULL users keep their (key) row so that every active key shows up, but
    their flags are 0: distinct counts ignore NULL."""
    reached = [
        F.max(F.when((F.col("event_type") == s) & F.col("user_id").isNotNull(), 1).otherwise(0)).alias(f"_{s}")
        for s in stages
    ]
    return activity.groupBy(key.alias(key_name), "user_id").agg(*reached)


# --------------------------------------------------------------------------- marts


def fact_daily_activity(activity: DataFrame) -> DataFrame:
    """Grain event_date x event_type: events, distinct users/sessions, sum(price)."""
    per_session = activity.groupBy("event_date", "event_type", "user_id", "session_id").agg(
        _events(activity).alias("_n"), *_money_parts(activity)
    )
    per_user = per_session.groupBy("event_date", "event_type", "user_id").agg(
        F.sum("_n").alias("_n"), *_money_parts(per_session), F.count("session_id").alias("_ns")
    )
    return (
        per_user.groupBy("event_date", "event_type")
        .agg(
            F.sum("_n").alias("event_count"),
            F.count("user_id").alias("distinct_users"),
            F.sum("_ns").alias("distinct_sessions"),
            _money(per_user).alias("sum_price"),
        )
        .orderBy("event_date", "event_type")
    )


def mart_dau(activity: DataFrame) -> DataFrame:
    return _users_and_sessions(activity, {"event_date": F.col("event_date")}, "dau_users", "dau_sessions").orderBy(
        "event_date"
    )


def mart_wau(activity: DataFrame) -> DataFrame:
    """ISO week (Monday). A session crossing the week edge counts in both weeks."""
    return _users_and_sessions(
        activity, {"week_start": week_start("event_date")}, "wau_users", "wau_sessions"
    ).orderBy("week_start")


def wau_users(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy(week_start("event_date").alias("week_start"))
        .agg(F.countDistinct("user_id").alias("wau_users"))
        .orderBy("week_start")
    )


def wau_sessions(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy(week_start("event_date").alias("week_start"))
        .agg(F.countDistinct("session_id").alias("wau_sessions"))
        .orderBy("week_start")
    )


def wau_approx(activity: DataFrame, rsd: float = 0.01) -> DataFrame:
    """HyperLogLog++ estimate of weekly users and sessions (bounded memory per group)."""
    return (
        activity.groupBy(week_start("event_date").alias("week_start"))
        .agg(
            F.approx_count_distinct("user_id", rsd).alias("wau_users"),
            F.approx_count_distinct("session_id", rsd).alias("wau_sessions"),
        )
        .orderBy("week_start")
    )


def mart_mau(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy(month_of("event_date").alias("month"))
        .agg(F.countDistinct("user_id").alias("mau_users"))
        .orderBy("month")
    )


def mart_stickiness(activity: DataFrame) -> DataFrame:
    """Per date: DAU / MAU of its month. The month side has one row per month;
    AQE sees its real size at run time and broadcasts it (or not)."""
    user_days = activity.where(F.col("user_id").isNotNull()).select("event_date", "user_id").distinct()
    dau = user_days.groupBy("event_date").agg(F.count(F.lit(1)).alias("dau"))
    dau = dau.select(
        F.to_date("event_date").alias("date"), month_of("event_date").alias("month"), "dau"
    )
    mau = (
        user_days.select(month_of("event_date").alias("month"), "user_id")
        .distinct()
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("mau"))
    )
    return (
        dau.join(mau, "month")
        .select("date", "dau", "mau", safe_div("dau", "mau").alias("stickiness"))
        .orderBy("date")
    )


def stickiness_full_months(activity: DataFrame, min_days: int = 2) -> DataFrame:
    """Stickiness without months observed on fewer than ``min_days`` dates."""
    s = mart_stickiness(activity)
    days = Window.partitionBy(F.date_format("date", "yyyy-MM"))
    return s.withColumn("_days", F.count(F.lit(1)).over(days)).where(F.col("_days") >= min_days).drop("_days").orderBy(
        "date"
    )


def mart_funnel(activity: DataFrame, stages: Sequence[str] = STAGES) -> DataFrame:
    """Weekly distinct users per stage (independent counts) and stage ratios."""
    view, cart, purchase = stages
    flags = _stage_flags(activity, week_start("event_date"), "week_start", stages)
    wk = flags.groupBy("week_start").agg(
        F.sum(f"_{view}").cast("long").alias("users_view"),
        F.sum(f"_{cart}").cast("long").alias("users_cart"),
        F.sum(f"_{purchase}").cast("long").alias("users_purchase"),
    )
    return wk.select(
        "week_start",
        "users_view",
        "users_cart",
        "users_purchase",
        safe_div("users_cart", "users_view").alias("view_to_cart"),
        safe_div("users_purchase", "users_cart").alias("cart_to_purchase"),
    ).orderBy("week_start")


def _weekly_cvr(activity: DataFrame, visit: str, buy: str) -> DataFrame:
    flags = _stage_flags(activity, week_start("event_date"), "week_start", (visit, buy))
    wk = flags.groupBy("week_start").agg(
        F.sum(f"_{visit}").cast("long").alias("visitors"), F.sum(f"_{buy}").cast("long").alias("purchasers")
    )
    return wk.withColumn("cvr", safe_div("purchasers", "visitors"))


def mart_cvr(activity: DataFrame, visit: str = "view", buy: str = "purchase") -> DataFrame:
    """Weekly purchasers / visitors and the change against the previous *row*.

    The window has no partition, but runs on one row per week."""
    wk = _weekly_cvr(activity, visit, buy)
    prev = F.lag("cvr").over(Window.orderBy("week_start"))
    return wk.withColumn("cvr_wow_delta", F.col("cvr") - prev).orderBy("week_start")


def cvr_wow_calendar(activity: DataFrame, visit: str = "view", buy: str = "purchase") -> DataFrame:
    """As :func:`mart_cvr`, but compared with the calendar week before (NULL if empty)."""
    wk = _weekly_cvr(activity, visit, buy)
    rows = Window.orderBy("week_start")  # one row per week
    adjacent = F.datediff("week_start", F.lag("week_start").over(rows)) == 7
    return wk.withColumn("cvr_wow_delta", F.when(adjacent, F.col("cvr") - F.lag("cvr").over(rows))).orderBy("week_start")


def mart_revenue(activity: DataFrame, buy: str = "purchase") -> DataFrame:
    """Weekly purchase revenue, purchase events (order proxy) and AOV."""
    return (
        activity.where(F.col("event_type") == buy)
        .groupBy(week_start("event_date").alias("week_start"))
        .agg(_money(activity).alias("revenue"), _events(activity).alias("purchases"))
        .withColumn("aov", safe_div("revenue", "purchases"))
        .orderBy("week_start")
    )


def mart_arppu(activity: DataFrame, buy: str = "purchase") -> DataFrame:
    """Weekly revenue per paying user (NULL without buyers)."""
    per_user = (
        activity.where(F.col("event_type") == buy)
        .groupBy(week_start("event_date").alias("week_start"), "user_id")
        .agg(*_money_parts(activity))
    )
    return (
        per_user.groupBy("week_start")
        .agg(_money(per_user).alias("revenue"), F.count("user_id").alias("buyers"))
        .withColumn("arppu", safe_div("revenue", "buyers"))
        .orderBy("week_start")
    )


def mart_retention(activity: DataFrame) -> DataFrame:
    """Weekly cohort retention.

    Cohort = a user's first active week. Each user is active in their own
    cohort week, so the cohort size is the offset-0 count: no join back to a
    cohort table is needed. Sort groups are one user's distinct weeks.
    """
    user_weeks = (
        activity.where(F.col("user_id").isNotNull())
        .select("user_id", week_start("event_date").alias("wk"))
        .distinct()
    )
    cohort = F.min("wk").over(Window.partitionBy("user_id"))
    with_cohort = user_weeks.select(
        cohort.alias("cohort_week"), "wk"
    ).select("cohort_week", (F.datediff("wk", "cohort_week") / 7).cast("int").alias("week_offset"))
    cells = with_cohort.groupBy("cohort_week", "week_offset").agg(F.count(F.lit(1)).alias("active_users"))
    size = F.max(F.when(F.col("week_offset") == 0, F.col("active_users"))).over(Window.partitionBy("cohort_week"))
    return (
        cells.withColumn("cohort_users", size)
        .withColumn("retention_rate", F.col("active_users").cast("double") / F.col("cohort_users"))
        .orderBy("cohort_week", "week_offset")
    )


def dim_date(activity: DataFrame) -> DataFrame:
    """One row per calendar date from the first to the last activity date."""
    bounds = activity.agg(F.min(F.to_date("event_date")).alias("d0"), F.max(F.to_date("event_date")).alias("d1"))
    days = bounds.where(F.col("d0").isNotNull()).select(
        F.explode(F.sequence("d0", "d1", F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    dow = F.dayofweek("date")
    return days.select(
        F.date_format("date", "yyyy-MM-dd").alias("date_key"),
        "date",
        F.date_trunc("week", "date").cast("date").alias("iso_week"),
        F.date_format("date", "yyyy-MM").alias("month"),
        dow.alias("dow"),
        dow.isin(1, 7).alias("is_weekend"),
    ).orderBy("date")


MARTS = {
    "dim_date": dim_date,
    "fact_daily_activity": fact_daily_activity,
    "mart_dau": mart_dau,
    "mart_wau": mart_wau,
    "mart_mau": mart_mau,
    "mart_stickiness": mart_stickiness,
    "mart_funnel": mart_funnel,
    "mart_cvr": mart_cvr,
    "mart_revenue": mart_revenue,
    "mart_retention": mart_retention,
}
