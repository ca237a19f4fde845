"""Table schemas and the fixed values the results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must stay as they are for matching results) -------------
# Source time text carries a literal " UTC" suffix.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss 'UTC'"
# Local business zone; partition dates and marts are in this zone.
LOCAL_ZONE = "Asia/Seoul"
# A new session starts when the whole-second gap to the previous event is >= this.
SESSION_GAP_SECONDS = 300
# Natural key of an event and the tie-break order (each ascending, nulls last).
NATURAL_KEY = ("user_id", "event_time", "event_type", "product_id")
DEDUP_TIEBREAK = ("price", "brand", "category_id", "category_code", "user_session")
# Funnel stage names in order.
STAGES = ("view", "cart", "purchase")
# Money is summed as a decimal with more digits after the point than a price
# has, then reported as DOUBLE.
MONEY_TYPE = "decimal(38,18)"
# A price at or beyond this (or NaN, or infinite) is not money: jobs quarantine it.
PRICE_LIMIT = 1e12
# Column in which the CSV reader keeps lines that do not fit the schema.
CORRUPT_COLUMN = "_corrupt_record"
# Readiness marker written last into every published date folder.
SUCCESS_MARKER = "_SUCCESS"
# ---------------------------------------------------------------------------

RAW = T.StructType(
    [
        T.StructField("event_time", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("category_code", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("user_session", T.StringType()),
    ]
)
RAW_COLUMNS = tuple(f.name for f in RAW.fields)

# Silver `activity` as stored: raw columns + derived times + session id.
# `event_date` is the partition column and lives in the folder name.
ACTIVITY_DATA = T.StructType(
    RAW.fields
    + [
        T.StructField("event_time_utc", T.TimestampType()),
        T.StructField("event_time_kst", T.TimestampType()),
        T.StructField("session_id", T.StringType()),
    ]
)
ACTIVITY = T.StructType(ACTIVITY_DATA.fields + [T.StructField("event_date", T.StringType())])
ACTIVITY_COLUMNS = tuple(f.name for f in ACTIVITY.fields)
