"""Mergeable measures of user activity.

Counts, sums, minima and maxima can be taken over events or over partial results of the
same kind. An *activity* frame holds such partial results: one row per event to begin with,
or one row per user and event type after the rollup. A metric written over activity gives
the same answer at either grain, so a pipeline reads the event log once for several metrics
while a single query goes straight to the events with one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.schema import DAY_COLUMN, LOAD_COLUMN

# Measures of an activity frame next to user_id and event_type.
EVENTS = "events"  # rows
DATED_EVENTS = "dated_events"  # rows with a timestamp
AMOUNT = "amount"  # sum of amounts, null when there is none
FIRST_AT = "first_at"
LAST_AT = "last_at"
#: In the stored rollup: the hour of purchases, null for other events.
PURCHASE_HOUR = "purchase_hour"
#: In the state by user: the days with a dated event.
ACTIVE_DAYS = "active_day_list"
ACTIVITY_COLUMNS = ("user_id", "event_type", EVENTS, DATED_EVENTS, AMOUNT, FIRST_AT, LAST_AT)


def as_activity(frame: DataFrame) -> DataFrame:
    """View events as activity; an activity frame passes through unchanged."""
    if set(ACTIVITY_COLUMNS) <= set(frame.columns):
        return frame
    return frame.selectExpr(
        "user_id",
        "event_type",
        f"1L AS {EVENTS}",
        f"if(timestamp IS NULL, 0L, 1L) AS {DATED_EVENTS}",
        f"amount AS {AMOUNT}",
        f"timestamp AS {FIRST_AT}",
        f"timestamp AS {LAST_AT}",
    )


def user_event_rollup(frame: DataFrame) -> DataFrame:
    """Activity at one row per user and event type.

    Map-side partial aggregation leaves each task at most one row per key to shuffle, so
    a user with a large share of all events costs no more than any other.
    """
    return as_activity(frame).groupBy("user_id", "event_type").agg(*_merged_measures())


def merged_rollup(rows: DataFrame) -> DataFrame:
    """Rows of the stored rollup, or events in their shape, added up by user, type, purchase hour, day
    and load."""
    keys = ("user_id", "event_type", PURCHASE_HOUR, DAY_COLUMN, LOAD_COLUMN)
    return rows.groupBy(*keys).agg(*_merged_measures())


def user_state(rollup: DataFrame) -> DataFrame:
    """Rows of the stored rollup, or of earlier states, by user and event type, with the days of
    the user's dated events. A user has a row per type and a day at most once in each."""
    if ACTIVE_DAYS not in rollup.columns:
        rollup = rollup.withColumn(ACTIVE_DAYS, F.array_compact(F.array(DAY_COLUMN)))
    days = F.array_distinct(F.flatten(F.collect_set(ACTIVE_DAYS))).alias(ACTIVE_DAYS)
    return rollup.groupBy("user_id", "event_type").agg(*_merged_measures(), days)


def _merged_measures() -> list[Column]:
    sums = [F.sum(name).alias(name) for name in (EVENTS, DATED_EVENTS, AMOUNT)]
    return [*sums, F.min(FIRST_AT).alias(FIRST_AT), F.max(LAST_AT).alias(LAST_AT)]


def known_user_events() -> Column:
    """Events of a row that carry a user id."""
    return F.expr(f"if(user_id IS NULL, 0L, {EVENTS})")
