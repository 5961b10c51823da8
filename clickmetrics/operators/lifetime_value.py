"""Lifetime value per user, in its two meanings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.config import PURCHASE, AnalyticsConfig
from clickmetrics.functions import (
    count_when,
    money,
    safe_divide,
    sum_when,
    whole_days_between,
)
from clickmetrics.operators.activity import (
    AMOUNT,
    EVENTS,
    FIRST_AT,
    LAST_AT,
    as_activity,
    known_user_events,
)


def ltv_basic(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Amounts of *all* event types per user, users with a positive total only."""
    totals = as_activity(events).groupBy("user_id").agg(
        F.sum(AMOUNT).alias("total_ltv"),
        F.sum(known_user_events()).alias("event_count"),
    )
    return totals.filter(F.col("total_ltv") > 0).withColumn(
        "total_ltv", money(F.col("total_ltv"), config.money_digits)
    )


def ltv_detail(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Amounts of *purchases* per user, with the time span of all the user's events."""
    is_purchase = F.col("event_type") == PURCHASE
    totals = as_activity(events).groupBy("user_id").agg(
        F.min(FIRST_AT).alias("first_order_date"),
        F.max(LAST_AT).alias("last_order_date"),
        count_when(is_purchase, F.col(EVENTS)).alias("total_orders"),
        sum_when(is_purchase, F.col(AMOUNT)).alias("total_ltv"),
    )
    return (
        totals.filter(F.col("total_ltv") > 0)
        .withColumn("total_ltv", money(F.col("total_ltv"), config.money_digits))
        .withColumn("avg_order_value", safe_divide(F.col("total_ltv"), F.col("total_orders")))
        .withColumn(
            "customer_lifespan_days",
            whole_days_between(F.col("first_order_date"), F.col("last_order_date")),
        )
    )
