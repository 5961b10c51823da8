"""Metric operators: DataFrame in, lazy DataFrame out.

Operators that only need counts, sums and first/last times per user and event type accept
either the events themselves or the smaller rollup of them (see ``activity``).
"""

from clickmetrics.operators.activity import as_activity, user_event_rollup
from clickmetrics.operators.churn import churn_features, churn_risk
from clickmetrics.operators.cohorts import cohort_daily, user_signup
from clickmetrics.operators.engagement import (
    retention_summary,
    user_daily_activity,
    user_engagement,
)
from clickmetrics.operators.funnels import funnel_fixed, funnel_users, funnel_volume
from clickmetrics.operators.lifetime_value import ltv_basic, ltv_detail
from clickmetrics.operators.revenue import revenue_hourly
from clickmetrics.operators.segments import (
    SegmentModel,
    fit_segments,
    segment_check,
    segment_distribution,
    segment_features,
    segment_features_scaled,
)
from clickmetrics.operators.serving import (
    churn_summary,
    cohort_series,
    conversion_rate,
    funnel_display,
    in_read_order,
    kpi_global,
    retention_row,
    top_customers,
)

__all__ = [
    "SegmentModel",
    "as_activity",
    "churn_features",
    "churn_risk",
    "churn_summary",
    "cohort_daily",
    "cohort_series",
    "conversion_rate",
    "fit_segments",
    "funnel_display",
    "funnel_fixed",
    "funnel_users",
    "funnel_volume",
    "in_read_order",
    "kpi_global",
    "ltv_basic",
    "ltv_detail",
    "retention_row",
    "retention_summary",
    "revenue_hourly",
    "segment_check",
    "segment_distribution",
    "segment_features",
    "segment_features_scaled",
    "top_customers",
    "user_daily_activity",
    "user_engagement",
    "user_event_rollup",
    "user_signup",
]
