"""Adapters from the shared test tables to the clickstream data model.

``events(event_id, ts, user_id, event_type, value, props)`` stands in for the
raw clickstream; ``orders`` gives a long (1995-2001) activity history for
cohorts and months. The same mapping is written in SQL for the oracle
(``oracle_sql.py``), so both engines see identical input.

The mapping is deterministic (a rule on ``event_id``) and makes the cases that
the operators are for: a user with a fifth of all rows, prices with parts of a
cent, exact copies, copies that differ in the price or only in a later
tie-break column, and a source session id of its own. ``gaps`` moves the later
events, so days, a week and most of a month stay empty; :func:`folded` lays all
events over six local dates; :func:`hostile_text` spoils some lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.schema import RAW, RAW_COLUMNS

# --- fixed values of the mapping --------------------------------------------
# `click` plays the cart stage; other event types keep their names.
EVENT_TYPE_MAP = {"click": "cart"}
# Every 5th event is user 0's; prices get up to 0.0078 more.
HOT_EVERY, SUB_CENT = 5, 0.0013
# Purchases arrive a second time with a different price (|price - 20|) and
# errors a second time with no price: natural-key duplicates for dedup. Every
# 11th event has an exact copy, every 13th one of brand a0.
REDELIVERED_PRICE_SHIFT = 20.0
EXACT_EVERY, OTHER_BRAND_EVERY = 11, 13
# Seconds of a source session.
SOURCE_SESSION = 5400
# With gaps: from each time on, events move by so many days (the last that applies).
GAPS = (("2024-01-12", 18), ("2024-01-27", 45), ("2024-01-30", 100))
# Spoilt lines: every n-th event has no time, a bad time, no user, a price NaN, a product that is no number.
BAD_TIME, NO_TIME, NO_USER, NAN_PRICE, BAD_PRODUCT = 101, 103, 107, 109, 113
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def numbered_clickstream(spark: SparkSession, sf_dir: str, gaps: bool = False, fold: bool = False) -> DataFrame:
    """The raw columns (time as ``... UTC`` text, whole seconds) and event_id."""
    ev = table(spark, sf_dir, "events")
    etype = F.col("event_type")
    for src, dst in EVENT_TYPE_MAP.items():
        etype = F.when(F.col("event_type") == src, F.lit(dst)).otherwise(etype)
    ts = F.col("ts").cast("timestamp")
    if gaps:
        days = F.lit(0)
        for since, n in GAPS:
            days = F.when(ts >= F.lit(since).cast("timestamp"), F.lit(n)).otherwise(days)
        ts = ts + F.make_dt_interval(days)
    if fold:
        ts = F.timestamp_seconds(F.unix_seconds(F.lit("2024-03-01 00:00:00").cast("timestamp")) + F.unix_seconds(ts) % (5 * 86400))
    user = F.when(_every(HOT_EVERY), F.lit(0)).otherwise(F.col("user_id")).cast("long")
    cols = {
        "event_time": F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'"),
        "event_type": etype,
        "product_id": F.get_json_object("props", "$.k").cast("long"),
        "category_id": (F.col("event_id") % 9).cast("long"),
        "brand": F.concat(F.lit("b"), (F.col("event_id") % 4).cast("string")),
        "price": F.col("value") + (F.col("event_id") % 7) * F.lit(SUB_CENT),
        "user_id": user,
        "user_session": F.concat_ws("-", user.cast("string"), F.floor(F.unix_seconds(ts) / SOURCE_SESSION).cast("string")),
    }
    raw = ev.select(
        "event_id",
        *[cols[f.name].alias(f.name) if f.name in cols else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW],
    )
    price = F.when(F.col("event_type") == "purchase", F.abs(F.col("price") - F.lit(REDELIVERED_PRICE_SHIFT)))
    return (
        raw.unionByName(raw.where(F.col("event_type").isin("purchase", "error")).withColumn("price", price))
        .unionByName(raw.where(_every(EXACT_EVERY)))
        .unionByName(raw.where(_every(OTHER_BRAND_EVERY)).withColumn("brand", F.lit("a0")))
    )


def clickstream(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """The raw clickstream used by the registered queries."""
    return numbered_clickstream(spark, sf_dir, gaps).drop("event_id")


def hostile_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream as lines of text, some of them spoilt."""
    raw = numbered_clickstream(spark, sf_dir)
    text = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    text["event_time"] = F.when(_every(BAD_TIME), F.lit("no time")).when(~_every(NO_TIME), F.col("event_time"))
    text["user_id"] = F.when(~_every(NO_USER), text["user_id"])
    text["price"] = F.when(_every(NAN_PRICE), F.lit("NaN")).otherwise(text["price"])
    text["product_id"] = F.when(_every(BAD_PRODUCT), F.concat(F.lit("x"), text["product_id"])).otherwise(text["product_id"])
    return raw.select(*[text[c].alias(c) for c in RAW_COLUMNS])


def nullable_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clickstream with some NULL users (they fail their dates)."""
    raw = numbered_clickstream(spark, sf_dir)
    return raw.withColumn("user_id", F.when(~_every(NO_USER), F.col("user_id"))).drop("event_id")


def orders_as_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as purchase activity: customer = user, order date = local date."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("user_id"),
        F.concat_ws("-", F.lit("o"), F.col("o_orderkey").cast("string")).alias("session_id"),
        F.lit("purchase").alias("event_type"),
        F.col("o_totalprice").alias("price"),
        F.date_format(F.col("o_orderdate"), "yyyy-MM-dd").alias("event_date"),
    )
