"""Customer-event analytics on Spark.

One append-only event log (user, event type, amount, time) goes in; lifetime value,
retention, cohort, funnel, revenue, churn and segment tables come out. Every operator
takes and returns a lazy DataFrame, so operators compose and Catalyst plans the whole.
"""

from clickmetrics.config import AnalyticsConfig
from clickmetrics.session import build_session

__all__ = ["AnalyticsConfig", "build_session"]
