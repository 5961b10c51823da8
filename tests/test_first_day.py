"""The SQL twins on the first day of the given events.

Over the whole span every user has many events of every type, so that nobody is at risk and
everybody is retained. One day has users on both sides of each threshold.
"""

from __future__ import annotations

from datetime import datetime

import pytest

from __spark_entry__ import GIVEN_EVENTS, REPORT, oracle_sql
from clickmetrics import operators as op
from clickmetrics.sources import events_between, map_events
from compare import assert_same, duckdb_over

DAY_END = datetime(2024, 1, 2)

METRICS = {
    "ltv_basic": lambda e: op.ltv_basic(e, REPORT),
    "ltv_detail": lambda e: op.ltv_detail(e, REPORT),
    "user_engagement": op.user_engagement,
    "retention_summary": op.retention_summary,
    "user_daily_activity": op.user_daily_activity,
    "user_signup": op.user_signup,
    "cohort_daily": op.cohort_daily,
    "funnel_fixed": op.funnel_fixed,
    "funnel_users": op.funnel_users,
    "funnel_volume": op.funnel_volume,
    "revenue_hourly": lambda e: op.revenue_hourly(e, REPORT),
    "churn_risk": op.churn_risk,
    "churn_summary": lambda e: op.churn_summary(op.churn_risk(e)),
    "conversion_rate": lambda e: op.conversion_rate(op.funnel_users(e)),
    "segment_features": lambda e: op.segment_features(e, REPORT),
    "kpi_global": lambda e: op.kpi_global(e, REPORT),
    "top_customers": lambda e: op.top_customers(op.ltv_basic(e, REPORT)),
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    with duckdb_over(sf_dir) as connection:
        yield connection


@pytest.fixture(scope="module")
def first_day(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/events.parquet")
    bounded = events_between(given, until=DAY_END, timestamp="ts")
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(ts" in plan
    return map_events(bounded, GIVEN_EVENTS)


@pytest.mark.parametrize("key", sorted(METRICS))
def test_first_day_equals_sql(first_day, duck, key):
    sql = oracle_sql()[key].replace("FROM events", f"FROM events WHERE ts < '{DAY_END}'", 1)
    assert_same(METRICS[key](first_day), duck, sql)


def test_first_day_is_on_both_sides_of_the_thresholds(first_day):
    total, retained, _ = op.retention_summary(first_day).first()
    at_risk, evaluated, _ = op.churn_summary(op.churn_risk(first_day)).first()
    assert 0 < retained < total == evaluated > at_risk > 0
