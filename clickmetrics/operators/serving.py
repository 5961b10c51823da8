"""Summaries that a dashboard shows, computed from metric tables and the event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickmetrics.config import FUNNEL_STAGES, PURCHASE, AnalyticsConfig
from clickmetrics.functions import money, percent
from clickmetrics.operators.activity import AMOUNT, EVENTS, as_activity

LOGIN = FUNNEL_STAGES[0]

# Stages that come first, in this order, when the volume funnel is read; others follow.
VOLUME_STAGES = FUNNEL_STAGES[1:]


def kpi_global(events: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Distinct users, total amount and number of events, in one row; zeros for no events. Totals by
    user do as well as events."""
    totals = events if EVENTS in events.columns else as_activity(events)
    return totals.agg(
        F.count_distinct("user_id").alias("total_users"),
        F.coalesce(money(F.sum(AMOUNT), config.money_digits), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum(EVENTS), F.lit(0).cast("bigint")).alias("total_events"),
    )


def top_customers(ltv: DataFrame, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """The customers with the highest lifetime value, ranked from 1; ties by user id.

    The limit is the report; each task keeps only its own best rows, and the rank is
    numbered over what is left.
    """
    by_value = [F.col("total_ltv").desc(), F.col("user_id")]
    best = ltv.select("user_id", "total_ltv").orderBy(*by_value).limit(config.top_customers)
    rank = F.row_number().over(Window.orderBy(*by_value))
    return best.select(rank.alias("rank"), "user_id", "total_ltv")


def funnel_display(funnel: DataFrame) -> DataFrame:
    """The funnel with upper-case stage names."""
    return funnel.select(F.upper("stage").alias("stage"), "user_count")


def cohort_series(cohorts: DataFrame) -> DataFrame:
    """The cohorts in order of their day."""
    return in_read_order(cohorts.select("cohort_day", "user_count"), "cohort_metrics")


def retention_row(retention: DataFrame) -> DataFrame:
    """The stored retention row, or zeros if there is none."""
    counts = [
        F.coalesce(F.first(name), F.lit(0).cast("bigint")).alias(name)
        for name in ("total_users", "retained_users")
    ]
    rate = F.coalesce(F.first("retention_rate"), F.lit(0.0)).alias("retention_rate")
    return retention.limit(1).agg(*counts, rate)


def churn_summary(churn: DataFrame) -> DataFrame:
    """Users at risk, users evaluated and their ratio in percent; zeros for no users."""
    none = F.lit(0).cast("bigint")
    totals = churn.agg(
        F.coalesce(F.sum("is_at_risk"), none).alias("at_risk_count"),
        F.count(F.lit(1)).alias("total_evaluated"),
    )
    rate = percent(F.col("at_risk_count"), F.col("total_evaluated"))
    return totals.withColumn("churn_rate", F.coalesce(rate, F.lit(0.0)))


def conversion_rate(funnel: DataFrame) -> DataFrame:
    """Purchasing users per logged-in user in percent; null if nobody logged in.

    The stages are independent, so the rate can exceed 100.
    """
    stages = funnel.filter(F.col("stage").isin(LOGIN, PURCHASE)).agg(
        F.max(F.when(F.col("stage") == LOGIN, F.col("user_count"))).alias("login_users"),
        F.max(F.when(F.col("stage") == PURCHASE, F.col("user_count"))).alias("purchase_users"),
    )
    return stages.select(
        percent(F.col("purchase_users"), F.col("login_users")).alias("conversion_rate")
    )


def in_read_order(metric: DataFrame, table: str) -> DataFrame:
    """A metric in the order it is read in. Saved tables stay unsorted: order is for readers."""
    match table:
        case "ltv_metrics" | "ltv_detail":
            keys = [F.col("total_ltv").desc(), F.col("user_id")]
        case "user_daily_activity":
            keys = [F.col("active_days").desc(), F.col("user_id")]
        case "cohort_metrics":
            keys = [F.col("cohort_day").asc()]
        case "funnel_metrics":
            keys = [_position(FUNNEL_STAGES), F.col("stage")]
        case "funnel_volume":
            keys = [_position(VOLUME_STAGES), F.col("stage")]
        case "revenue_trend":
            keys = [F.col("revenue_hour").desc()]
        case _:
            raise ValueError(f"no read order for {table}")
    return metric.orderBy(*keys)


def _position(stages: tuple[str, ...]) -> Column:
    """Place of the row's stage among ``stages``, after them all if it is none of them."""
    position = F.lit(len(stages))
    for index, stage in enumerate(stages):
        position = F.when(F.col("stage") == stage, index).otherwise(position)
    return position
