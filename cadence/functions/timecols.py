"""Column expressions for time handling (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.schema import EVENT_TIME_FORMAT, LOCAL_ZONE, MONEY_TYPE, PRICE_LIMIT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(c: str | Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Source text -> instant. Malformed text gives NULL instead of failing the job."""
    return F.try_to_timestamp(_c(c), F.lit(fmt))


def to_local_clock(ts: str | Column, zone: str = LOCAL_ZONE) -> Column:
    """Instant -> local wall clock (a shifted timestamp). Apply exactly once."""
    return F.from_utc_timestamp(_c(ts), zone)


def local_date_text(local_ts: str | Column) -> Column:
    return F.date_format(_c(local_ts), "yyyy-MM-dd")


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since the epoch (floors sub-second input)."""
    return F.unix_timestamp(_c(ts))


def with_local_time(
    df: DataFrame, zone: str = LOCAL_ZONE, src: str = "event_time", fmt: str = EVENT_TIME_FORMAT
) -> DataFrame:
    """Add ``event_time_utc``, ``event_time_kst`` and the local ``event_date`` text."""
    utc = parse_utc(src, fmt)
    kst = to_local_clock(utc, zone)
    return df.withColumns({"event_time_utc": utc, "event_time_kst": kst, "event_date": local_date_text(kst)})


def week_start(date_text: str | Column) -> Column:
    """Monday of the ISO week of a ``yyyy-MM-dd`` text date, as DATE."""
    return F.date_trunc("week", F.to_date(_c(date_text))).cast("date")


def month_of(date_text: str | Column) -> Column:
    return F.date_format(F.to_date(_c(date_text)), "yyyy-MM")


def safe_div(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as DOUBLE, NULL when the denominator is 0 or NULL."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def odd_price(c: str | Column) -> Column:
    """NaN, infinite or beyond the limit: no amount of money."""
    return F.isnan(_c(c)) | (F.abs(_c(c)) >= F.lit(PRICE_LIMIT))


def exact_money(c: str | Column) -> Column:
    """A price as a decimal, nothing rounded; NULL for odd prices."""
    return F.when(~odd_price(c), _c(c)).try_cast(MONEY_TYPE)


def odd_money(c: str | Column) -> Column:
    """An odd price as it is, NULL for all others."""
    return F.when(odd_price(c), _c(c))


def money_total(exact: Column, odd: Column) -> Column:
    """DOUBLE total of two sums. A sum of decimals does not depend on the order
    of addition; an odd price shows in the total as it would in a plain sum."""
    return F.when(odd.isNull(), exact.cast("double")).otherwise(F.coalesce(exact.cast("double"), F.lit(0.0)) + odd)


def money_sum(c: str | Column) -> Column:
    """Total of a price column as DOUBLE."""
    return money_total(F.try_sum(exact_money(c)), F.sum(odd_money(c)))
