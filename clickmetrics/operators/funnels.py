"""Conversion funnels. Stages are independent: reaching one does not require another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.config import AnalyticsConfig
from clickmetrics.operators.activity import as_activity, known_user_events


def funnel_fixed(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Distinct users of each configured stage, in stage order, zero for an unused stage.

    A row without a user stands for each stage in the grouping, which counts users only, so a
    stage that nobody reached comes out as zero. Other event types are filtered out in the scan.
    """
    stages = list(config.funnel_stages)
    every_stage = events.sparkSession.range(1, numPartitions=1).select(
        F.lit(None).cast("string").alias("user_id"),
        F.explode(F.array(*map(F.lit, stages))).alias("event_type"),
    )
    reached = events.filter(F.col("event_type").isin(stages)).select("user_id", "event_type")
    counts = reached.union(every_stage).groupBy(F.col("event_type").alias("stage")).agg(
        F.count_distinct("user_id").alias("user_count")
    )
    return counts.orderBy(F.array_position(F.array(*map(F.lit, stages)), F.col("stage")))


def funnel_users(events: DataFrame) -> DataFrame:
    """Distinct users per event type found in the data, unknown types included."""
    return as_activity(events).groupBy(F.col("event_type").alias("stage")).agg(
        F.count_distinct("user_id").alias("user_count")
    )


def funnel_volume(events: DataFrame) -> DataFrame:
    """Events and distinct users per event type found in the data."""
    return as_activity(events).groupBy(F.col("event_type").alias("stage")).agg(
        F.sum(known_user_events()).alias("total_events"),
        F.count_distinct("user_id").alias("unique_users"),
    )
