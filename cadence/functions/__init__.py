from cadence.functions.timecols import (
    epoch_seconds,
    exact_money,
    local_date_text,
    money_sum,
    money_total,
    month_of,
    odd_money,
    odd_price,
    parse_utc,
    safe_div,
    to_local_clock,
    week_start,
    with_local_time,
)

__all__ = [
    "epoch_seconds",
    "local_date_text",
    "exact_money",
    "money_sum",
    "money_total",
    "month_of",
    "odd_money",
    "odd_price",
    "parse_utc",
    "safe_div",
    "to_local_clock",
    "week_start",
    "with_local_time",
]
