"""Column functions shared by the operators."""

from clickmetrics.functions.columns import (
    count_when,
    day_of,
    day_text,
    hour_of,
    money,
    percent,
    safe_divide,
    sum_when,
    time_text,
    to_event_time,
    whole_days_between,
)

__all__ = [
    "count_when",
    "day_of",
    "day_text",
    "hour_of",
    "money",
    "percent",
    "safe_divide",
    "sum_when",
    "time_text",
    "to_event_time",
    "whole_days_between",
]
