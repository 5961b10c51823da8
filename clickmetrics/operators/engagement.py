"""How much, and on how many days, users act."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.config import AnalyticsConfig
from clickmetrics.functions import day_of, percent
from clickmetrics.operators.activity import ACTIVE_DAYS, DATED_EVENTS, as_activity
from clickmetrics.schema import DAY_COLUMN


def user_engagement(events: DataFrame) -> DataFrame:
    """Distinct event types and dated events per user."""
    return as_activity(events).groupBy("user_id").agg(
        F.count_distinct("event_type").alias("unique_actions"),
        F.sum(DATED_EVENTS).alias("total_interactions"),
    )


def retention_summary(
    events: DataFrame,
    config: AnalyticsConfig = AnalyticsConfig(),
    row_without_users: bool = True,
) -> DataFrame:
    """Share of users with more events than the threshold, in one row.

    Without any user the row reads (0, 0, null), or is left out if ``row_without_users``
    is false.
    """
    per_user = as_activity(events).groupBy("user_id").agg(
        F.sum(DATED_EVENTS).alias("total_interactions")
    )
    counts = per_user.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.count_if(F.col("total_interactions") > config.retained_above_events).alias(
            "retained_users"
        ),
    )
    summary = counts.withColumn(
        "retention_rate", percent(F.col("retained_users"), F.col("total_users"))
    )
    return summary if row_without_users else summary.filter(F.col("total_users") > 0)


def user_daily_activity(events: DataFrame) -> DataFrame:
    """Days on which each user acted: how many, the first and the last.

    The first grouping removes repeats of a day map-side, so what a user sends over the
    network is bounded by the number of days, not of events. The stored rollup, which has its
    rows by day, does as well as events, and so does the state by user, which has lists of days.
    """
    if ACTIVE_DAYS in events.columns:
        days = F.array_distinct(F.flatten(F.collect_list(ACTIVE_DAYS)))
        return events.groupBy("user_id").agg(days.alias("days")).select(
            "user_id",
            F.size("days").cast("bigint").alias("active_days"),
            F.array_min("days").cast("timestamp").alias("first_active"),
            F.array_max("days").cast("timestamp").alias("last_active"),
        )
    by_day = "timestamp" not in events.columns
    day = F.col(DAY_COLUMN).cast("timestamp") if by_day else day_of(F.col("timestamp"))
    days = events.select("user_id", day.alias("activity_date")).distinct()
    return days.groupBy("user_id").agg(
        F.count("activity_date").alias("active_days"),
        F.min("activity_date").alias("first_active"),
        F.max("activity_date").alias("last_active"),
    )
