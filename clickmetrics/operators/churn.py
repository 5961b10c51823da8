"""Rule-based churn risk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.config import PURCHASE, AnalyticsConfig
from clickmetrics.functions import count_when
from clickmetrics.operators.activity import DATED_EVENTS, EVENTS, as_activity


def churn_features(events: DataFrame) -> DataFrame:
    """Dated events and purchases per user."""
    return as_activity(events).groupBy("user_id").agg(
        F.sum(DATED_EVENTS).alias("event_count"),
        count_when(F.col("event_type") == PURCHASE, F.col(EVENTS)).alias("purchase_count"),
    )


def churn_risk(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Every user, flagged 1 if they did little and never bought, else 0."""
    at_risk = (F.col("event_count") <= config.at_risk_max_events) & (F.col("purchase_count") == 0)
    return churn_features(events).withColumn("is_at_risk", F.when(at_risk, 1).otherwise(0))
