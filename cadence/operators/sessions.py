"""Gap-based sessionization and session analyses.

Semantics (fixed): per user, events ordered by time; an event opens a new
session when it has no predecessor or the whole-second gap to its
predecessor is >= ``gap_seconds``. The session id is
``"<user_id>_<epoch seconds of the session's first event>"``.

Two implementations with identical output, combined by :func:`sessionize`
(hot users take the first, all others the second):

* :func:`sessionize_two_level` (skew-safe). Only whole seconds matter: every
  event after the first one of its second has gap 0 and continues the
  session. So the work runs on the *distinct* ``(user, second)`` pairs
  (a map-side-combined aggregate), split into sort groups of one user and one
  time bucket (at most ``bucket_seconds`` rows each, however hot the user).
  Buckets are stitched through a per-bucket summary of a few rows per user,
  and the session start is joined back to the events on ``(user, second)``.
* :func:`sessionize_window` - the one-window-per-user formulation: one
  shuffle and one sort, but a user holding a third of all rows would be one
  sort task, so it only gets users below the hot threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.functions.timecols import epoch_seconds
from cadence.schema import SESSION_GAP_SECONDS

DAY_SECONDS = 86400


def session_id_col(user: Column, start_epoch: Column) -> Column:
    """``user_start``; a NULL part is skipped (NULL user -> just the start)."""
    return F.concat_ws("_", user.cast("string"), start_epoch.cast("string"))


def _zero(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, T.BooleanType):
        return F.lit(False)
    if isinstance(dt, T.DateType):
        return F.to_date(F.lit("1970-01-01"))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dt)
    return F.lit(0).cast(dt)


def encode_keys(df: DataFrame, cols: Sequence[str]) -> tuple[list[Column], list[str]]:
    """Null-safe stand-ins for grouping keys: a not-null value plus a null flag each.

    NULL keys group together (as in a window or GROUP BY), yet every join
    stays a plain equi-join, so a partitioning on these columns is reused
    instead of being re-shuffled for ``<=>`` expressions.
    """
    exprs: list[Column] = []
    names: list[str] = []
    for i, c in enumerate(cols):
        dt = df.schema[c].dataType
        exprs += [F.coalesce(F.col(c), _zero(dt)).alias(f"_k{i}"), F.col(c).isNull().alias(f"_z{i}")]
        names += [f"_k{i}", f"_z{i}"]
    return exprs, names


def _buckets(
    df: DataFrame, gap_seconds: int, by: Sequence[str], user: str, time_col: str, bucket_seconds: int, seeds: DataFrame | None
) -> tuple[list[str], DataFrame, DataFrame]:
    """The encoded keys, the distinct seconds with what their own bucket tells,
    and one row per (user, bucket) and seed: ``_first``, ``_last`` and the
    latest session start that lies in it (``_start_max``)."""
    exprs, keys = encode_keys(df, [*by, user])
    # Both branches below (per-second rows, per-bucket summary) read this one
    # relation with the same predicates, so its shuffle is planned once and
    # reused. Rows without a time get no start (they keep the bare user id).
    secs = (
        df.select(*exprs, epoch_seconds(time_col).alias("_s"))
        .where(F.col("_s").isNotNull())
        .distinct()
        # not-null by construction, so joins on it infer no extra filter that
        # would reach one branch's scan but not the other's
        .withColumn("_b", F.coalesce(F.floor(F.col("_s") / F.lit(bucket_seconds)), F.lit(0).cast("long")))
    )
    w_local = Window.partitionBy(*keys, "_b").orderBy("_s")
    prev = F.lag("_s").over(w_local)
    secs = secs.select("*", ((F.col("_s") - prev) >= F.lit(gap_seconds)).alias("_brk"))
    # latest internal break at or before each second (same sort: no re-sort)
    secs = secs.select(
        "*",
        F.max(F.when(F.col("_brk"), F.col("_s")))
        .over(w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("_local_start"),
    )
    # One row per (user, bucket): first/last second and the last internal break.
    summary = secs.groupBy(*keys, "_b").agg(
        F.min("_s").alias("_first"),
        F.max("_s").alias("_last"),
        F.max(F.when(F.col("_brk"), F.col("_s"))).alias("_last_brk"),
        F.lit(None).cast("long").alias("_seed_start"),
        F.lit(False).alias("_is_seed"),
    )
    if seeds is not None:
        seed_exprs, _ = encode_keys(seeds, [*by, user])
        summary = summary.unionByName(
            seeds.select(
                *seed_exprs,
                F.lit(None).cast("long").alias("_b"),
                F.col("last_s").cast("long").alias("_first"),
                F.col("last_s").cast("long").alias("_last"),
                F.lit(None).cast("long").alias("_last_brk"),
                F.col("start_s").cast("long").alias("_seed_start"),
                F.lit(True).alias("_is_seed"),
            )
        )
    prev_last = F.lag("_last").over(Window.partitionBy(*keys).orderBy("_first"))
    first_new = prev_last.isNull() | ((F.col("_first") - prev_last) >= F.lit(gap_seconds))
    start_max = F.coalesce("_seed_start", "_last_brk", F.when(first_new, F.col("_first")))
    return keys, secs, summary.select("*", first_new.alias("_first_new"), start_max.alias("_start_max"))


def session_starts(
    df: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    by: Sequence[str] = (),
    user: str = "user_id",
    time_col: str = "event_time_utc",
    bucket_seconds: int = DAY_SECONDS,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """Distinct ``(encoded keys, _s)`` with ``_start``: the session start second.

    Keys are ``(*by, user)`` in the encoded form of :func:`encode_keys`.
    ``seeds`` (optional) carries state from an earlier run: columns
    ``*by, user, last_s, start_s`` = last event second already published and
    the start of its session. Seeds must lie before every new event.
    """
    keys, secs, summary = _buckets(df, gap_seconds, by, user, time_col, bucket_seconds, seeds)
    w_user = Window.partitionBy(*keys).orderBy("_first")
    carry = F.max("_start_max").over(w_user.rowsBetween(Window.unboundedPreceding, -1))
    # the start of the bucket's first second: itself if it opens a session,
    # else the latest start of the earlier buckets (or of the seed)
    summary = (
        summary.select(
            *keys,
            "_b",
            "_is_seed",
            F.when(F.col("_first_new"), F.col("_first")).otherwise(carry).alias("_head"),
        )
        .where(~F.col("_is_seed"))  # a literal per union branch: folds away, nothing pushed down
        .drop("_is_seed")
    )
    joined = secs.join(summary, [*keys, "_b"])
    return joined.select(*keys, "_s", F.coalesce("_local_start", "_head").alias("_start"))


def last_sessions(
    df: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    user: str = "user_id",
    time_col: str = "event_time_utc",
    bucket_seconds: int = DAY_SECONDS,
    seeds: DataFrame | None = None,
) -> DataFrame:
    """The seeds that rows after ``df`` need: per user the last second of ``df``
    and the start of its session (``user, last_s, start_s``).

    The latest start of a user's buckets is that start, so nothing is joined
    back to the seconds. A user who is only in ``seeds`` keeps the seed."""
    keys, _, summary = _buckets(df, gap_seconds, (), user, time_col, bucket_seconds, seeds)
    last = summary.groupBy(*keys).agg(F.max("_last").alias("last_s"), F.max("_start_max").alias("start_s"))
    return last.select(F.when(~F.col(keys[1]), F.col(keys[0])).alias(user), "last_s", "start_s")


# Users with more rows than this take the two-level path; the rest are
# sessionized with one window per user (a sort group of at most this many rows).
HOT_ROWS = 5_000_000


def sessionize(
    df: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    by: Sequence[str] = (),
    user: str = "user_id",
    time_col: str = "event_time_utc",
    bucket_seconds: int = DAY_SECONDS,
    seeds: DataFrame | None = None,
    source: DataFrame | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``session_id`` to every row. Lazy: nothing runs here.

    Rows are counted per ``(*by, user)`` inside the plan (map-side combined; on
    ``source`` when given, which has at least as many rows per user). Users
    above ``hot_rows`` take the two-level path, all others one window per
    user; both give the same ids. There are at most rows / ``hot_rows`` hot
    users (200,000 in 10**12 rows), which bounds the broadcast list; when it
    comes out empty, AQE drops the two-level branch.

    ``hot_rows=None`` sends everyone through the two-level path. ``seeds``
    work on every path (see :func:`session_starts` and :func:`_window_seeded`).
    ``by``: extra keys that split independent runs (e.g. a run date).
    Rows with a NULL time keep a session id of just the user.
    ``source``: optional rows with the same distinct ``(*by, user, second)``
    set as ``df`` (e.g. the input before de-duplication) to compute the
    two-level session starts from; then ``df``'s own upstream runs once.
    """
    df = df.drop("session_id")
    if hot_rows is None:
        return sessionize_two_level(df, gap_seconds, by, user, time_col, bucket_seconds, seeds, source)
    base = df if source is None else source
    b_exprs, keys = encode_keys(base, [*by, user])
    counts = base.select(*b_exprs).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = F.broadcast(counts.where(F.col("_n") > F.lit(hot_rows)).select(*keys))
    exprs, _ = encode_keys(df, [*by, user])
    enc = df.select("*", *exprs)
    cold_part = enc.join(hot, keys, "left_anti").drop(*keys)
    hot_part = enc.join(hot, keys, "left_semi").drop(*keys)
    hot_src = None
    if source is not None:
        hot_src = source.select("*", *b_exprs).join(hot, keys, "left_semi").drop(*keys)
    cold = _window_seeded(cold_part, seeds, gap_seconds, by, user, time_col)
    warm = sessionize_two_level(hot_part, gap_seconds, by, user, time_col, bucket_seconds, seeds, hot_src)
    return cold.unionByName(warm)


def _window_seeded(
    df: DataFrame, seeds: DataFrame | None, gap_seconds: int, by: Sequence[str], user: str, time_col: str
) -> DataFrame:
    """Per-user window with optional seeds: each seed is one pseudo-event at
    the user's last published second carrying its session start as a hint;
    it continues (or not) like any event and is dropped afterwards."""
    if seeds is None:
        return sessionize_window(df, gap_seconds, by, user, time_col)
    cols = df.columns
    pseudo = seeds.select(
        *by,
        user,
        F.timestamp_seconds(F.col("last_s").cast("long")).alias(time_col),
        F.col("start_s").cast("long").alias("_hint"),
        F.lit(True).alias("_seed"),
    )
    both = df.withColumn("_seed", F.lit(False)).unionByName(pseudo, allowMissingColumns=True)
    out = sessionize_window(both, gap_seconds, by, user, time_col, start_hint="_hint")
    return out.where(~F.col("_seed")).select(*cols, "session_id")


def sessionize_two_level(
    df: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    by: Sequence[str] = (),
    user: str = "user_id",
    time_col: str = "event_time_utc",
    bucket_seconds: int = DAY_SECONDS,
    seeds: DataFrame | None = None,
    source: DataFrame | None = None,
) -> DataFrame:
    """Skew-safe form: session starts from distinct ``(user, second)`` pairs in
    ``(user, bucket)`` sort groups, joined back on ``(user, second)``."""
    df = df.drop("session_id")
    src = df if source is None else source
    starts = session_starts(src, gap_seconds, by, user, time_col, bucket_seconds, seeds)
    exprs, keys = encode_keys(df, [*by, user])
    ev = df.select("*", *exprs, epoch_seconds(time_col).alias("_s"))
    out = ev.join(starts, [*keys, "_s"], "left")
    return out.withColumn("session_id", session_id_col(F.col(user), F.col("_start"))).select(
        *df.columns, "session_id"
    )


def sessionize_window(
    df: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    by: Sequence[str] = (),
    user: str = "user_id",
    time_col: str = "event_time_utc",
    start_hint: str | None = None,
) -> DataFrame:
    """One window per user: a row's session start is the latest opening second
    up to it, a running maximum over the one sort.

    ``start_hint``: optional column of epoch seconds that stands in for a
    row's own second as the start it opens (seed pseudo-events)."""
    order = [F.col(time_col)] + [F.col(c) for c in ("event_type", "product_id") if c in df.columns]
    w = Window.partitionBy(*by, user).orderBy(*order)
    own = epoch_seconds(time_col)
    before = F.lag(own).over(w)
    opens = before.isNull() | (own - before >= F.lit(gap_seconds))
    second = F.coalesce(F.col(start_hint), own) if start_hint else own
    opened = df.withColumn("_opened", F.when(opens, second))
    start = F.max("_opened").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return opened.withColumn("session_id", session_id_col(F.col(user), start)).drop("_opened")


# --------------------------------------------------------------------------- analyses


def session_summary(activity: DataFrame) -> DataFrame:
    """One row per session: start, end, events, duration and dates touched."""
    return activity.groupBy("user_id", "session_id").agg(
        F.min("event_time_utc").alias("session_start"),
        F.max("event_time_utc").alias("session_end"),
        F.count(F.lit(1)).alias("events"),
        (epoch_seconds(F.max("event_time_utc")) - epoch_seconds(F.min("event_time_utc"))).alias(
            "duration_seconds"
        ),
        F.countDistinct("event_date").alias("dates_touched"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )


def midnight_sessions(activity: DataFrame) -> DataFrame:
    """Sessions whose events fall on more than one local date (one id, two partitions)."""
    per_date = activity.groupBy("user_id", "session_id", "event_date").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_date.groupBy("user_id", "session_id")
        .agg(
            F.count(F.lit(1)).alias("dates_touched"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
            F.sum("_n").alias("events"),
        )
        .where(F.col("dates_touched") > 1)
    )


def previous_second(
    secs: DataFrame, keys: Sequence[str], bucket_seconds: int = DAY_SECONDS, s: str = "_s"
) -> DataFrame:
    """For distinct ``(*keys, s)`` rows add ``_prev``: the largest earlier second in the group.

    Same two-level shape as :func:`session_starts`: sort groups are one key and
    one bucket; the bucket's predecessor comes from a tiny per-bucket summary.
    """
    exprs, enc = encode_keys(secs, keys)
    secs = secs.select("*", *exprs, F.floor(F.col(s) / F.lit(bucket_seconds)).alias("_b"))
    w_local = Window.partitionBy(*enc, "_b").orderBy(s)
    secs = secs.withColumn("_prev_local", F.lag(s).over(w_local))
    summary = secs.groupBy(*enc, "_b").agg(F.max(s).alias("_blast"))
    summary = summary.withColumn(
        "_prev_bucket", F.lag("_blast").over(Window.partitionBy(*enc).orderBy("_b"))
    ).drop("_blast")
    joined = secs.join(summary, [*enc, "_b"])
    return joined.withColumn("_prev", F.coalesce("_prev_local", "_prev_bucket")).drop(
        *enc, "_b", "_prev_local", "_prev_bucket"
    )


def session_audit(
    activity: DataFrame,
    gap_seconds: int = SESSION_GAP_SECONDS,
    original: str = "user_session",
    staged: str | None = None,
) -> DataFrame:
    """How the source's own session ids relate to the gap rule. One row.

    Both halves read the distinct (user, original session, second) rows.
    ``staged``: a folder of the shared scratch space to write them to first, so
    that ``activity`` is computed once (this runs a job).

    * ``sessions_with_gap_share``: original sessions having an internal gap
      of more than ``gap_seconds`` between consecutive event seconds.
    * ``switch_gap_share``: among original sessions that are not the user's
      first, the share that began less than ``gap_seconds`` after the user's
      previous event (0 when another original session has an event in the
      same second).
    """
    base = activity.where(F.col("event_time_utc").isNotNull() & F.col(original).isNotNull()).select(
        "user_id", original, epoch_seconds("event_time_utc").alias("_s")
    ).distinct()
    if staged is not None:
        base.write.mode("overwrite").parquet(staged)
        base = activity.sparkSession.read.schema(base.schema).parquet(staged)
    # (a) internal gaps per original session
    sess_secs = previous_second(base, ["user_id", original])
    per_sess = sess_secs.groupBy("user_id", original).agg(
        F.max(F.when((F.col("_s") - F.col("_prev")) > F.lit(gap_seconds), 1).otherwise(0)).alias("_gap"),
        F.min("_s").alias("_s0"),
    )
    # (b) gap from the user's previous event to each original session's first second
    user_secs = base.groupBy("user_id", "_s").agg(F.count(original).alias("_nsess"))
    user_prev = previous_second(user_secs, ["user_id"])
    starts = per_sess.alias("p").join(
        user_prev.alias("u"),
        F.col("p.user_id").eqNullSafe(F.col("u.user_id")) & (F.col("p._s0") == F.col("u._s")),
    )
    switch_gap = F.when(F.col("u._nsess") > 1, F.lit(0)).otherwise(F.col("u._s") - F.col("u._prev"))
    is_switch = (F.col("u._nsess") > 1) | F.col("u._prev").isNotNull()
    per_start = starts.select(
        F.col("p._gap").alias("_gap"),
        is_switch.alias("_switch"),
        (is_switch & (switch_gap < F.lit(gap_seconds))).alias("_short"),
    )
    agg = per_start.agg(
        F.count(F.lit(1)).alias("original_sessions"),
        F.sum("_gap").cast("long").alias("sessions_with_gap"),
        F.sum(F.col("_switch").cast("long")).alias("switches"),
        F.sum(F.col("_short").cast("long")).alias("short_switches"),
    )
    return agg.select(
        "original_sessions",
        F.coalesce("sessions_with_gap", F.lit(0)).alias("sessions_with_gap"),
        F.coalesce("switches", F.lit(0)).alias("switches"),
        F.coalesce("short_switches", F.lit(0)).alias("short_switches"),
        (F.col("sessions_with_gap") / F.nullif("original_sessions", F.lit(0))).alias("sessions_with_gap_share"),
        (F.col("short_switches") / F.nullif("switches", F.lit(0))).alias("switch_gap_share"),
    )
