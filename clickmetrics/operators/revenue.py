"""Revenue over time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.config import PURCHASE, AnalyticsConfig
from clickmetrics.functions import hour_of, money
from clickmetrics.operators.activity import EVENTS, PURCHASE_HOUR


def revenue_hourly(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Purchases and their amounts per hour; hours without a purchase are absent.

    The type filter reaches the Parquet scan. An hour whose amounts are all null has a null
    sum. The stored rollup, which has purchases by hour, does as well as events.
    """
    purchases = events.filter(F.col("event_type") == PURCHASE)
    by_hour = PURCHASE_HOUR in events.columns
    hour = F.col(PURCHASE_HOUR) if by_hour else hour_of(F.col("timestamp"))
    return purchases.groupBy(hour.alias("revenue_hour")).agg(
        (F.sum(EVENTS) if by_hour else F.count(F.lit(1))).alias("purchase_count"),
        money(F.sum("amount"), config.money_digits).alias("total_revenue"),
    )
