"""Column functions, all built from Spark's own expressions so that they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clickmetrics.config import TIMESTAMP_FORMAT


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """Quotient, null where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, two decimals rounded half up; null for an empty whole."""
    return F.round(safe_divide(part * F.lit(100.0), whole), 2)


def money(amount: Column, digits: int | None) -> Column:
    """A reported money value, rounded so that the order of a double sum does not show."""
    return amount if digits is None else F.round(amount, digits)


def count_when(condition: Column, weight: Column) -> Column:
    """Number of rows, or of the events they stand for, that meet ``condition``."""
    return F.sum(F.when(condition, weight).otherwise(F.lit(0).cast("bigint")))


def sum_when(condition: Column, value: Column) -> Column:
    """Sum of ``value`` where ``condition`` holds; other rows add zero, null values nothing."""
    return F.sum(F.when(condition, value).otherwise(F.lit(0.0)))


def day_of(moment: Column) -> Column:
    """Start of the day as a timestamp."""
    return F.date_trunc("DAY", moment)


def hour_of(moment: Column) -> Column:
    """Start of the hour as a timestamp."""
    return F.date_trunc("HOUR", moment)


def day_text(moment: Column) -> Column:
    """The day as ``yyyy-MM-dd`` text."""
    return F.date_format(moment, "yyyy-MM-dd")


def whole_days_between(start: Column, end: Column) -> Column:
    """Full 24-hour periods from ``start`` to ``end``, not calendar days crossed."""
    return F.timestamp_diff("DAY", start, end)


def time_text(moment: Column, fmt: str | None = None) -> Column:
    """An event time as text, by default with fractions of a second where there are any."""
    return moment.cast("string") if fmt is None else F.date_format(moment, fmt)


def to_event_time(text: Column, strict: bool = True) -> Column:
    """Parse event-time text; text that does not parse fails, or gives null if not strict."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    fmt = TIMESTAMP_FORMAT if strict else F.lit(TIMESTAMP_FORMAT)
    return parse(text, fmt)
