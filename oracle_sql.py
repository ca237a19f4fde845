"""Independent DuckDB SQL for every oracle-checked query.

Written the plain way (one window per user, ``count(DISTINCT ...)``) so it
checks the Spark plans, which are shaped for skew and scale, against the
textbook formulation. Views ``events`` and ``orders`` are pre-registered.
"""

from __future__ import annotations

GAP = 300
FMT = "%Y-%m-%d %H:%M:%S UTC"
RAW_COLS = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
SILVER_COLS = RAW_COLS + ", event_time_utc, event_time_kst, event_date, session_id"
WEEK = "CAST(date_trunc('week', CAST(event_date AS DATE)) AS DATE)"
MONTH = "strftime(CAST(event_date AS DATE), '%Y-%m')"


def _raw(ts: str = "ts") -> str:
    """Numbered raw rows and, without the number, ``raw``. ``ts``: the event's time."""
    return f"""
numbered AS (
  SELECT *, CAST(CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id END AS BIGINT) AS u, {ts} AS t FROM events
),
raw0 AS (
  SELECT event_id, strftime(t, '%Y-%m-%d %H:%M:%S') || ' UTC' AS event_time,
         CASE WHEN event_type = 'click' THEN 'cart' ELSE event_type END AS event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
         CAST(event_id % 9 AS BIGINT) AS category_id,
         CAST(NULL AS VARCHAR) AS category_code,
         'b' || (event_id % 4) AS brand,
         value + (event_id % 7) * CAST(0.0013 AS DOUBLE) AS price,
         u AS user_id,
         u || '-' || CAST(floor(floor(epoch(t)) / 5400) AS BIGINT) AS user_session
  FROM numbered
),
lines AS (
  SELECT * FROM raw0
  UNION ALL
  SELECT * REPLACE (CASE WHEN event_type = 'purchase' THEN abs(price - CAST(20.0 AS DOUBLE)) END AS price)
  FROM raw0 WHERE event_type IN ('purchase', 'error')
  UNION ALL SELECT * FROM raw0 WHERE event_id % 11 = 0
  UNION ALL SELECT * REPLACE ('a0' AS brand) FROM raw0 WHERE event_id % 13 = 0
),
raw AS (SELECT {RAW_COLS} FROM lines)"""


GAPS = (
    "ts + INTERVAL 1 DAY * CASE WHEN ts >= '2024-01-30' THEN 100 WHEN ts >= '2024-01-27' THEN 45 "
    "WHEN ts >= '2024-01-12' THEN 18 ELSE 0 END"
)
FOLDED = "TIMESTAMP '2024-03-01' + INTERVAL 1 SECOND * (CAST(floor(epoch(ts)) AS BIGINT) % 432000)"
# the reason why a line of the spoilt text cannot be used
REASON = """CASE WHEN event_id % 113 = 0 THEN 'unreadable line' WHEN event_id % 101 = 0 THEN 'unparseable event_time'
  WHEN event_id % 109 = 0 THEN 'price out of range' WHEN event_id % 103 = 0 THEN 'null event_time'
  WHEN event_id % 107 = 0 THEN 'null user_id' END"""


def _silver(p: str = "", gap: int = GAP, lookback: int | None = None) -> str:
    """CTEs ending in ``{p}activity``; with ``lookback`` each local date is a
    separate run that also sees the ``lookback`` dates before it."""
    if lookback is None:
        src, run, run_sel = "raw", "", ""
    else:
        src, run, run_sel = f"{p}fan", "run_date, ", "run_date, "
    fan = ""
    if lookback is not None:
        fan = f"""
{p}fan AS (
  SELECT *, strftime(CAST(strftime(strptime(event_time, '{FMT}') + INTERVAL 9 HOUR, '%Y-%m-%d') AS DATE)
                     + CAST(k AS INTEGER), '%Y-%m-%d') AS run_date
  FROM (SELECT r.*, unnest(range(0, {lookback + 1})) AS k FROM raw r)
),"""
    order = "event_time_utc ASC NULLS FIRST, event_type ASC NULLS FIRST, product_id ASC NULLS FIRST"
    return f"""{fan}
{p}dedup AS (
  SELECT {run_sel}{RAW_COLS} FROM (
    SELECT *, row_number() OVER (
      PARTITION BY {run}user_id, event_time, event_type, product_id
      ORDER BY price ASC NULLS LAST, brand ASC NULLS LAST, category_id ASC NULLS LAST,
               category_code ASC NULLS LAST, user_session ASC NULLS LAST) AS rn
    FROM {src}) WHERE rn = 1
),
{p}timed AS (
  SELECT *, event_time_utc + INTERVAL 9 HOUR AS event_time_kst,
         strftime(event_time_utc + INTERVAL 9 HOUR, '%Y-%m-%d') AS event_date
  FROM (SELECT *, strptime(event_time, '{FMT}') AS event_time_utc FROM {p}dedup)
),
{p}flag AS (
  SELECT *, CASE WHEN prev_t IS NULL
                   OR CAST(floor(epoch(event_time_utc)) AS BIGINT) - CAST(floor(epoch(prev_t)) AS BIGINT) >= {gap}
                 THEN 1 ELSE 0 END AS is_new
  FROM (SELECT *, lag(event_time_utc) OVER (PARTITION BY {run}user_id ORDER BY {order}) AS prev_t FROM {p}timed)
),
{p}seq AS (
  SELECT *, sum(is_new) OVER (PARTITION BY {run}user_id ORDER BY {order}
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS seq
  FROM {p}flag
),
{p}sessioned AS (
  SELECT {run_sel}{RAW_COLS}, event_time_utc, event_time_kst, event_date,
         concat_ws('_', CAST(user_id AS VARCHAR),
                   CAST(CAST(floor(epoch(min(event_time_utc) OVER (PARTITION BY {run}user_id, seq))) AS BIGINT) AS VARCHAR))
           AS session_id
  FROM {p}seq
),
{p}activity AS (
  SELECT {SILVER_COLS} FROM {p}sessioned {"WHERE event_date = run_date" if lookback is not None else ""}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes if c.strip())


def _on_silver(body: str, gap: int = GAP, ts: str = "ts") -> str:
    return _with(_raw(ts), _silver("", gap)) + "\n" + body


def _ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


# ----------------------------------------------------------------------------- marts on `activity`


def _fact(a: str = "activity") -> str:
    return f"""SELECT event_date, event_type, count(*) AS event_count,
       count(DISTINCT user_id) AS distinct_users, count(DISTINCT session_id) AS distinct_sessions,
       round(fsum(price), 6) AS sum_price
FROM {a} GROUP BY event_date, event_type"""


def _dau(a: str = "activity") -> str:
    return f"""SELECT event_date, count(DISTINCT user_id) AS dau_users, count(DISTINCT session_id) AS dau_sessions
FROM {a} GROUP BY event_date"""


def _wau(a: str = "activity") -> str:
    return f"""SELECT {WEEK} AS week_start, count(DISTINCT user_id) AS wau_users,
       count(DISTINCT session_id) AS wau_sessions
FROM {a} GROUP BY 1"""


def _dim_date(a: str = "activity") -> str:
    return f"""SELECT strftime(d, '%Y-%m-%d') AS date_key, d AS date, CAST(date_trunc('week', d) AS DATE) AS iso_week,
       strftime(d, '%Y-%m') AS month, CAST(dayofweek(d) + 1 AS INTEGER) AS dow,
       dayofweek(d) IN (0, 6) AS is_weekend
FROM (SELECT CAST(gs AS DATE) AS d
      FROM (SELECT min(CAST(event_date AS DATE)) AS d0, max(CAST(event_date AS DATE)) AS d1 FROM {a}) b,
           generate_series(CAST(b.d0 AS TIMESTAMP), CAST(b.d1 AS TIMESTAMP), INTERVAL 1 DAY) AS t(gs)
      WHERE b.d0 IS NOT NULL)"""


def _stickiness(a: str = "activity") -> str:
    return f"""SELECT d.day AS date, d.n AS dau, m.n AS mau, d.n / nullif(m.n, 0) AS stickiness
FROM (SELECT CAST(event_date AS DATE) AS day, count(DISTINCT user_id) AS n FROM {a} GROUP BY 1) d
JOIN (SELECT {MONTH} AS ym, count(DISTINCT user_id) AS n FROM {a} GROUP BY 1) m
  ON m.ym = strftime(d.day, '%Y-%m')"""


def _funnel(a: str = "activity") -> str:
    return f"""SELECT week_start, v AS users_view, c AS users_cart, p AS users_purchase,
       c / nullif(v, 0) AS view_to_cart, p / nullif(c, 0) AS cart_to_purchase
FROM (SELECT {WEEK} AS week_start,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS v,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'cart') AS c,
             count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS p
      FROM {a} GROUP BY 1)"""


def _cvr_weeks(a: str = "activity") -> str:
    return f"""SELECT week_start, visitors, purchasers, purchasers / nullif(visitors, 0) AS cvr FROM (
  SELECT {WEEK} AS week_start,
         count(DISTINCT user_id) FILTER (WHERE event_type = 'view') AS visitors,
         count(DISTINCT user_id) FILTER (WHERE event_type = 'purchase') AS purchasers
  FROM {a} GROUP BY 1)"""


def _revenue(a: str = "activity") -> str:
    return f"""SELECT week_start, round(total, 6) AS revenue, purchases, round(total / nullif(purchases, 0), 6) AS aov FROM (
  SELECT {WEEK} AS week_start, fsum(price) AS total, count(*) AS purchases
  FROM {a} WHERE event_type = 'purchase' GROUP BY 1)"""


def _arppu(a: str = "activity") -> str:
    return f"""SELECT week_start, round(total, 6) AS revenue, buyers, round(total / nullif(buyers, 0), 6) AS arppu FROM (
  SELECT {WEEK} AS week_start, fsum(price) AS total,
         count(DISTINCT user_id) AS buyers
  FROM {a} WHERE event_type = 'purchase' GROUP BY 1)"""


def _retention(a: str = "activity") -> str:
    size = "(SELECT count(*) FROM firsts x WHERE x.cohort_week = cells.cohort_week)"
    return f"""SELECT * FROM (
WITH user_week AS (SELECT DISTINCT user_id, {WEEK} AS wk FROM {a} WHERE user_id IS NOT NULL),
firsts AS (SELECT user_id, min(wk) AS cohort_week FROM user_week GROUP BY user_id),
cells AS (
  SELECT f.cohort_week, CAST(date_diff('day', f.cohort_week, w.wk) // 7 AS INTEGER) AS week_offset,
         count(*) AS active_users
  FROM user_week w JOIN firsts f ON f.user_id = w.user_id
  GROUP BY 1, 2)
SELECT cohort_week, week_offset, active_users, {size} AS cohort_users,
       CAST(active_users AS DOUBLE) / {size} AS retention_rate
FROM cells) retention"""


def _retention_cells(a: str = "activity") -> str:
    return f"""SELECT c.cohort_week, c.cohort_users, CAST(c.k AS INTEGER) AS week_offset, r.retention_rate
FROM (SELECT cohort_week, cohort_users, unnest(range(0, max(week_offset) + 1)) AS k FROM ({_retention(a)}) x GROUP BY 1, 2) c
LEFT JOIN ({_retention(a)}) r ON r.cohort_week = c.cohort_week AND r.week_offset = c.k"""


def _payload() -> str:
    """Every mart as (table, row_key, field, number, text)."""
    tables = {
        "dim_date": (_dim_date(), "concat_ws('|', date_key, month, date)"),
        "fact_daily_activity": (_fact(), "concat_ws('|', event_date, event_type)"),
        "mart_dau": (_dau(), "event_date"),
        "mart_wau": (_wau(), "CAST(week_start AS VARCHAR)"),
        "mart_mau": (f"SELECT {MONTH} AS month, count(DISTINCT user_id) AS mau_users FROM activity GROUP BY 1", "month"),
        "mart_stickiness": (_stickiness(), "CAST(date AS VARCHAR)"),
        "mart_funnel": (_funnel(), "CAST(week_start AS VARCHAR)"),
        "mart_cvr": (
            f"SELECT *, cvr - lag(cvr) OVER (ORDER BY week_start) AS cvr_wow_delta FROM ({_cvr_weeks()}) w",
            "CAST(week_start AS VARCHAR)",
        ),
        "mart_revenue": (_revenue(), "CAST(week_start AS VARCHAR)"),
        "mart_retention": (_retention(), "concat_ws('|', cohort_week, week_offset)"),
    }
    parts = [
        f"""SELECT '{name}' AS "table", row_key, field, value FROM (
  SELECT CAST({key} AS VARCHAR) AS row_key, CAST(COLUMNS(*) AS VARCHAR) FROM ({sql}) m
) UNPIVOT INCLUDE NULLS (value FOR field IN (COLUMNS(* EXCLUDE (row_key))))"""
        for name, (sql, key) in tables.items()
    ]
    return f"""SELECT "table", row_key, field, round(try_cast(value AS DOUBLE), 6) AS number,
       CASE WHEN try_cast(value AS DOUBLE) IS NULL THEN value END AS text FROM ({" UNION ALL ".join(parts)}) p"""


ORDERS_ACTIVITY = """orders_activity AS (
  SELECT o_custkey AS user_id, 'o-' || CAST(o_orderkey AS VARCHAR) AS session_id, 'purchase' AS event_type,
         o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS event_date
  FROM orders
)"""


def _incremental_diff(gap: int, lookback: int) -> str:
    return _with(_raw(), _silver("b_", gap), _silver("i_", gap, lookback)) + f"""
, ob AS (SELECT event_date, count(*) AS n FROM (SELECT * FROM b_activity EXCEPT ALL SELECT * FROM i_activity) GROUP BY 1)
, oi AS (SELECT event_date, count(*) AS n FROM (SELECT * FROM i_activity EXCEPT ALL SELECT * FROM b_activity) GROUP BY 1)
, nb AS (SELECT event_date, count(*) AS n FROM b_activity GROUP BY 1)
, ni AS (SELECT event_date, count(*) AS n FROM i_activity GROUP BY 1)
SELECT coalesce(nb.event_date, ni.event_date) AS event_date,
       CAST(coalesce(nb.n, 0) AS BIGINT) AS backfill_rows, CAST(coalesce(ni.n, 0) AS BIGINT) AS incremental_rows,
       CAST(coalesce(ob.n, 0) AS BIGINT) AS only_backfill, CAST(coalesce(oi.n, 0) AS BIGINT) AS only_incremental
FROM nb FULL JOIN ni ON nb.event_date = ni.event_date
LEFT JOIN ob ON ob.event_date = coalesce(nb.event_date, ni.event_date)
LEFT JOIN oi ON oi.event_date = coalesce(nb.event_date, ni.event_date)"""


def _session_audit(gap: int = GAP) -> str:
    return _on_silver(f"""
, base AS (SELECT user_id, user_session AS us,
                  CAST(floor(epoch(event_time_utc)) AS BIGINT) AS s
           FROM activity WHERE event_time_utc IS NOT NULL)
, sg AS (SELECT user_id, us, s, s - lag(s) OVER (PARTITION BY user_id, us ORDER BY s) AS g
         FROM (SELECT DISTINCT user_id, us, s FROM base))
, per_sess AS (SELECT user_id, us, max(CASE WHEN g > {gap} THEN 1 ELSE 0 END) AS has_gap, min(s) AS s0
               FROM sg GROUP BY 1, 2)
, up AS (SELECT user_id, s, nsess, lag(s) OVER (PARTITION BY user_id ORDER BY s) AS prev
         FROM (SELECT user_id, s, count(DISTINCT us) AS nsess FROM base GROUP BY 1, 2))
, st AS (SELECT p.has_gap, (u.nsess > 1 OR u.prev IS NOT NULL) AS is_switch,
                CASE WHEN u.nsess > 1 THEN 0 ELSE u.s - u.prev END AS sw_gap
         FROM per_sess p JOIN up u ON p.user_id = u.user_id AND p.s0 = u.s)
SELECT count(*) AS original_sessions, CAST(sum(has_gap) AS BIGINT) AS sessions_with_gap,
       CAST(sum(CAST(is_switch AS INTEGER)) AS BIGINT) AS switches,
       CAST(sum(CAST(is_switch AND sw_gap < {gap} AS INTEGER)) AS BIGINT) AS short_switches,
       CAST(sum(has_gap) AS BIGINT) / nullif(count(*), 0) AS sessions_with_gap_share,
       CAST(sum(CAST(is_switch AND sw_gap < {gap} AS INTEGER)) AS BIGINT)
         / nullif(CAST(sum(CAST(is_switch AS INTEGER)) AS BIGINT), 0) AS switch_gap_share
FROM st""")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["dedup_events"] = _with(_raw(), _silver()) + f"\nSELECT {RAW_COLS} FROM dedup"
    q["kst_dates"] = _with(_raw()) + f"""
SELECT event_time, {_ts('t')} AS event_time_utc, {_ts("t + INTERVAL 9 HOUR")} AS event_time_kst,
       strftime(t + INTERVAL 9 HOUR, '%Y-%m-%d') AS event_date
FROM (SELECT event_time, strptime(event_time, '{FMT}') AS t FROM raw)"""
    q["duplicate_rate"] = _with(_raw()) + """
, per_row AS (SELECT *, count(*) AS n FROM raw GROUP BY ALL)
, per_key AS (SELECT user_id, event_time, event_type, product_id, sum(n) AS n, count(*) AS d
              FROM per_row GROUP BY 1, 2, 3, 4)
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n) - sum(d) AS BIGINT) AS exact_duplicates,
       CAST(sum(n) - count(*) AS BIGINT) AS key_duplicates,
       CAST(sum(n) - sum(d) AS BIGINT) / nullif(CAST(sum(n) AS BIGINT), 0) AS exact_rate,
       CAST(sum(n) - count(*) AS BIGINT) / nullif(CAST(sum(n) AS BIGINT), 0) AS key_rate
FROM per_key"""
    q["sessionize"] = _on_silver("SELECT user_id, event_time, event_type, product_id, session_id FROM activity")
    # the same sessions; the Spark side takes the skew-safe / split physical paths
    q["sessionize_two_level"] = q["sessionize"]
    q["sessionize_hot_split"] = q["sessionize"]
    q["silver_activity"] = _on_silver(
        f"""SELECT {RAW_COLS}, {_ts('event_time_utc')} AS event_time_utc, {_ts('event_time_kst')} AS event_time_kst,
       event_date, session_id FROM activity"""
    )
    summary = f"""SELECT user_id, session_id, {_ts('min(event_time_utc)')} AS session_start,
       {_ts('max(event_time_utc)')} AS session_end, count(*) AS events,
       CAST(floor(epoch(max(event_time_utc))) AS BIGINT) - CAST(floor(epoch(min(event_time_utc))) AS BIGINT)
         AS duration_seconds,
       count(DISTINCT event_date) AS dates_touched, min(event_date) AS first_date, max(event_date) AS last_date
FROM activity GROUP BY user_id, session_id"""
    q["session_summary"] = _on_silver(summary)
    q["midnight_sessions"] = _on_silver(
        """SELECT user_id, session_id, count(DISTINCT event_date) AS dates_touched, min(event_date) AS first_date,
       max(event_date) AS last_date, count(*) AS events
FROM activity GROUP BY user_id, session_id HAVING count(DISTINCT event_date) > 1""",
        gap=1800,
    )
    q["session_audit"] = _session_audit()
    q["bronze_daily_counts"] = _with(_raw()) + f"""
SELECT strftime(strptime(event_time, '{FMT}') + INTERVAL 9 HOUR, '%Y-%m-%d') AS event_date, count(*) AS rows
FROM raw GROUP BY 1"""
    q["incremental_day"] = _with(_raw(), _silver("i_", GAP, 1)) + f"""
SELECT {RAW_COLS}, {_ts('event_time_utc')} AS event_time_utc, {_ts('event_time_kst')} AS event_time_kst,
       event_date, session_id FROM i_activity"""
    q["backfill_incremental_diff"] = _incremental_diff(43200, 1)
    nulls = _with(
        _raw().replace("u AS user_id,", "CASE WHEN event_id % 107 <> 0 THEN u END AS user_id,"), _silver("", GAP)
    )
    q["partition_quality"] = nulls + """
, n AS (SELECT event_date, count(*) AS rows, CAST(count(*) FILTER (user_id IS NULL OR event_time_utc IS NULL) AS BIGINT) AS bad
        FROM activity GROUP BY 1)
SELECT event_date, rows, bad AS null_key_rows, bad = 0 AS ok,
       CASE WHEN bad > 0 THEN bad || ' rows without a key' ELSE rows || ' rows, all with a key' END AS message FROM n"""
    q["published_silver"] = q["silver_activity"]
    q["incremental_jobs"] = _with(_raw(FOLDED), _silver("", GAP)) + """
SELECT event_date, count(*) AS backfill_rows, count(*) AS incremental_rows,
       CAST(0 AS BIGINT) AS only_backfill, CAST(0 AS BIGINT) AS only_incremental
FROM activity GROUP BY 1"""
    q["quarantine_split"] = _with(_raw()) + f"""
SELECT {REASON} AS reason, count(*) AS rows FROM lines WHERE {REASON} IS NOT NULL GROUP BY 1"""
    q["conservation_full"] = _with(_raw()) + f"""
, good AS (SELECT count(*) AS n, count(DISTINCT (user_id, event_time, event_type, product_id)) AS keys FROM lines WHERE {REASON} IS NULL)
SELECT (SELECT count(*) FROM lines) AS input_rows, (SELECT count(*) FROM lines) - n AS quarantined_rows, n - keys AS duplicate_rows,
       keys AS output_rows, keys AS published_rows, (SELECT count(*) FROM lines) - n AS quarantine_rows, true AS whole FROM good"""
    q["row_conservation"] = _on_silver(
        """SELECT (SELECT count(*) FROM raw) AS input_rows, (SELECT count(*) FROM activity) AS output_rows,
       (SELECT count(*) FROM activity) <= (SELECT count(*) FROM raw) AS ok"""
    )
    q["quarantine_counts"] = _with(_raw()) + """
, spoilt AS (SELECT event_id % 101 = 0 AS bad_time, event_id % 103 = 0 AS no_time, event_id % 107 = 0 AS no_user FROM lines)
SELECT count(*) AS rows, count(*) FILTER (no_time AND NOT bad_time) AS null_event_time,
       count(*) FILTER (bad_time) AS unparseable_event_time,
       count(*) FILTER (no_user AND NOT no_time AND NOT bad_time) AS null_user_id,
       count(*) FILTER (NOT no_user AND NOT no_time AND NOT bad_time) AS valid_rows
FROM spoilt"""
    # marts
    q["wau_users"] = _on_silver(f"SELECT {WEEK} AS week_start, count(DISTINCT user_id) AS wau_users FROM activity GROUP BY 1")
    q["wau_sessions"] = _on_silver(
        f"SELECT {WEEK} AS week_start, count(DISTINCT session_id) AS wau_sessions FROM activity GROUP BY 1"
    )
    q["fact_daily_activity"] = _on_silver(_fact())
    q["dim_date"] = _on_silver(_dim_date())
    q["mart_dau"] = _on_silver(_dau())
    q["mart_wau"] = _on_silver(_wau())
    q["mart_mau"] = _on_silver(f"SELECT {MONTH} AS month, count(DISTINCT user_id) AS mau_users FROM activity GROUP BY 1")
    q["mart_stickiness"] = _on_silver(_stickiness())
    q["stickiness_full_months"] = _on_silver(
        f"""SELECT date, dau, mau, stickiness FROM ({_stickiness()}) s
WHERE strftime(date, '%Y-%m') IN (SELECT strftime(date, '%Y-%m') FROM ({_stickiness()}) x GROUP BY 1 HAVING count(*) >= 3)""",
        ts=GAPS,
    )
    q["mart_funnel"] = _on_silver(_funnel())
    q["funnel_overall"] = _on_silver(
        f"SELECT *, users_purchase / nullif(users_view, 0) AS view_to_purchase FROM ({_funnel()}) f"
    )
    q["funnel_latest"] = _on_silver(
        f"""SELECT *, users_purchase / nullif(users_view, 0) AS view_to_purchase FROM ({_funnel()}) f
ORDER BY week_start DESC LIMIT 1"""
    )
    q["mart_cvr"] = _on_silver(
        f"SELECT *, cvr - lag(cvr) OVER (ORDER BY week_start) AS cvr_wow_delta FROM ({_cvr_weeks()}) w"
    )
    q["cvr_wow_calendar"] = _on_silver(
        f"""SELECT w.*, w.cvr - p.cvr AS cvr_wow_delta FROM ({_cvr_weeks()}) w
LEFT JOIN ({_cvr_weeks()}) p ON p.week_start + 7 = w.week_start""",
        ts=GAPS,
    )
    q["mart_revenue"] = _on_silver(_revenue())
    q["mart_arppu"] = _on_silver(_arppu())
    q["mart_retention"] = _on_silver(_retention())
    q["retention_orders"] = _with(ORDERS_ACTIVITY) + "\n" + _retention("orders_activity")
    q["retention_matrix"] = _on_silver(_retention_cells())
    q["retention_matrix_orders"] = _with(ORDERS_ACTIVITY) + "\n" + _retention_cells("orders_activity")
    q["sessions_per_user"] = _on_silver(
        f"SELECT *, wau_sessions / nullif(wau_users, 0) AS sessions_per_user FROM ({_wau()}) w"
    )
    q["dau_dense"] = _on_silver(
        f"""SELECT s.date_key AS event_date, coalesce(d.dau_users, 0) AS dau_users,
       coalesce(d.dau_sessions, 0) AS dau_sessions
FROM ({_dim_date()}) s LEFT JOIN ({_dau()}) d ON d.event_date = s.date_key""",
        ts=GAPS,
    )
    q["wau_approx"] = _on_silver(
        f"SELECT *, true AS users_within_bound, true AS sessions_within_bound FROM ({_wau()}) w"
    )
    q["publish_payload"] = _on_silver(_payload())
    q["mau_orders"] = _with(ORDERS_ACTIVITY) + f"""
SELECT {MONTH} AS month, count(DISTINCT user_id) AS mau_users FROM orders_activity GROUP BY 1"""
    return q
