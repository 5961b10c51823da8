"""Operators on the edge fixture, with results worked out by hand.

Each operator that accepts a rollup is checked on events and on their rollup.
"""

from __future__ import annotations

import pytest

from clickmetrics import AnalyticsConfig
from clickmetrics import operators as op
from fixtures import EDGE_EVENTS, at, events_of, value_set, values


@pytest.fixture(scope="module")
def events(spark):
    return events_of(spark, EDGE_EVENTS).coalesce(2).persist()


@pytest.fixture(scope="module", params=["events", "rollup"])
def activity(request, events):
    return events if request.param == "events" else op.user_event_rollup(events).persist()


def test_ltv_basic(activity):
    assert values(op.ltv_basic(activity)) == [("u1", 150.5, 5)]


def test_ltv_detail(activity):
    assert values(op.in_read_order(op.ltv_detail(activity), "ltv_detail")) == [
        ("u1", at("01-01 23:00:00"), at("01-03 22:59:59"), 2, 150.5, 75.25, 1),
        ("u5", at("01-03 12:00:00"), at("01-03 12:30:00"), 1, 20.0, 20.0, 0),
    ]


def test_user_engagement(activity):
    assert value_set(op.user_engagement(activity)) == {
        ("u1", 4, 5), ("u2", 2, 2), ("u3", 3, 3), ("u4", 1, 1), ("u5", 2, 2)
    }


def test_user_signup(activity):
    assert value_set(op.user_signup(activity)) == {
        ("u1", at("01-01 23:00:00")),
        ("u2", at("01-01 10:00:00")),
        ("u3", at("01-02 09:00:00")),
        ("u4", at("01-02 09:30:00")),
        ("u5", at("01-03 12:00:00")),
    }


def test_retention_summary(activity):
    assert values(op.retention_summary(activity)) == [(5, 1, 20.0)]


def test_user_daily_activity(events):
    daily = op.in_read_order(op.user_daily_activity(events), "user_daily_activity")
    assert values(daily) == [
        ("u1", 3, at("01-01 00:00"), at("01-03 00:00")),
        ("u2", 1, at("01-01 00:00"), at("01-01 00:00")),
        ("u3", 1, at("01-02 00:00"), at("01-02 00:00")),
        ("u4", 1, at("01-02 00:00"), at("01-02 00:00")),
        ("u5", 1, at("01-03 00:00"), at("01-03 00:00")),
    ]


@pytest.mark.parametrize("null_policy", ["drop_null_day", "keep_null_day"])
def test_cohort_daily(activity, null_policy):
    cohorts = op.in_read_order(op.cohort_daily(activity, null_policy), "cohort_metrics")
    assert values(cohorts) == [("2024-01-01", 2), ("2024-01-02", 2), ("2024-01-03", 1)]


FIXED_FUNNEL = [("login", 3), ("product_view", 3), ("add_to_cart", 2), ("purchase", 3)]


def test_funnel_fixed(activity):
    assert values(op.funnel_fixed(activity)) == FIXED_FUNNEL


def test_funnel_fixed_shows_an_unused_stage(activity):
    config = AnalyticsConfig(funnel_stages=("checkout", "login"))
    assert values(op.funnel_fixed(activity, config)) == [("checkout", 0), ("login", 3)]


def test_funnel_users(activity):
    funnel = op.in_read_order(op.funnel_users(activity), "funnel_metrics")
    assert values(funnel) == [*FIXED_FUNNEL, ("refund", 1)]


def test_funnel_volume(activity):
    volume = op.in_read_order(op.funnel_volume(activity), "funnel_volume")
    assert values(volume) == [
        ("product_view", 3, 3),
        ("add_to_cart", 2, 2),
        ("purchase", 4, 3),
        ("login", 3, 3),
        ("refund", 1, 1),
    ]


def test_funnel_display(activity):
    shown = op.funnel_display(op.funnel_fixed(activity))
    assert values(shown) == [(stage.upper(), users) for stage, users in FIXED_FUNNEL]


def test_revenue_hourly(events):
    assert values(op.in_read_order(op.revenue_hourly(events), "revenue_trend")) == [
        (at("01-03 22:00"), 1, 50.5),
        (at("01-03 12:00"), 1, 20.0),
        (at("01-02 09:00"), 1, None),
        (at("01-02 01:00"), 1, 100.0),
    ]


CHURN = {("u1", 5, 2, 0), ("u2", 2, 0, 1), ("u3", 3, 0, 0), ("u4", 1, 1, 0), ("u5", 2, 1, 0)}


def test_churn_risk(activity):
    assert value_set(op.churn_risk(activity)) == CHURN


def test_churn_summary(activity):
    assert values(op.churn_summary(op.churn_risk(activity))) == [(1, 5, 20.0)]


def test_segment_features(activity):
    assert value_set(op.segment_features(activity)) == {
        ("u1", 5, 150.5), ("u2", 2, 0.0), ("u3", 3, 0.0), ("u4", 1, None), ("u5", 2, 0.0)
    }


def test_segment_features_scaled(activity):
    scaled = op.segment_features_scaled(op.segment_features(activity), digits=6)
    assert value_set(scaled) == {
        ("u1", 1.769303, 2.0),
        ("u2", -0.442326, -0.5),
        ("u3", 0.294884, -0.5),
        ("u4", -1.179536, -0.5),
        ("u5", -0.442326, -0.5),
    }


def test_scaled_feature_that_never_varies_is_zero(spark):
    rows = [("a", "login", 0.0, at("01-01 10:00")), ("b", "login", 0.0, at("01-01 11:00"))]
    scaled = op.segment_features_scaled(op.segment_features(events_of(spark, rows)))
    assert value_set(scaled) == {("a", 0.0, 0.0), ("b", 0.0, 0.0)}


def test_kpi_global(activity):
    assert values(op.kpi_global(activity)) == [(5, 150.5, 13)]


def test_top_customers(activity):
    assert values(op.top_customers(op.ltv_basic(activity))) == [(1, "u1", 150.5)]


def test_top_customers_ranks_ties_by_user(spark):
    ltv = spark.createDataFrame(
        [("c", 5.0, 1), ("b", 9.0, 1), ("a", 5.0, 1), ("d", 1.0, 1)],
        "user_id string, total_ltv double, event_count bigint",
    )
    top = op.top_customers(ltv, AnalyticsConfig(top_customers=3))
    assert values(top) == [(1, "b", 9.0), (2, "a", 5.0), (3, "c", 5.0)]


def test_conversion_rate(activity):
    assert values(op.conversion_rate(op.funnel_users(activity))) == [(100.0,)]


def test_conversion_rate_without_logins_is_undefined(events):
    others = events.filter("event_type <> 'login'")
    assert values(op.conversion_rate(op.funnel_users(others))) == [(None,)]
    assert values(op.conversion_rate(op.funnel_fixed(others))) == [(None,)]


def test_no_events(spark):
    none = events_of(spark, [])
    assert values(op.funnel_fixed(none)) == [(stage, 0) for stage, _ in FIXED_FUNNEL]
    assert values(op.retention_summary(none)) == [(0, 0, None)]
    assert values(op.retention_summary(none, row_without_users=False)) == []
    assert values(op.kpi_global(none)) == [(0, 0.0, 0)]
    assert values(op.churn_summary(op.churn_risk(none))) == [(0, 0, 0.0)]
    for metric in (op.cohort_daily, op.ltv_basic, op.ltv_detail, op.revenue_hourly):
        assert values(metric(none)) == []


NULL_KEYS = [
    ("u1", "login", 0.0, at("01-01 10:00")),
    (None, "login", 1.0, at("01-01 11:00")),
    ("u2", "login", 0.0, None),
]


@pytest.fixture(scope="module", params=["events", "rollup"])
def with_nulls(request, spark):
    events = events_of(spark, NULL_KEYS)
    return events if request.param == "events" else op.user_event_rollup(events)


def test_null_user_and_null_time(with_nulls):
    assert value_set(op.cohort_daily(with_nulls)) == {("2024-01-01", 2)}
    assert value_set(op.cohort_daily(with_nulls, "keep_null_day")) == {
        ("2024-01-01", 1),
        (None, 1),
    }
    assert values(op.retention_summary(with_nulls))[0][0] == 3
    assert value_set(op.ltv_basic(with_nulls)) == {(None, 1.0, 0)}
    assert value_set(op.funnel_volume(with_nulls)) == {("login", 2, 2)}
    assert values(op.kpi_global(with_nulls)) == [(2, 1.0, 3)]
    assert ("u2", 0, 0, 1) in value_set(op.churn_risk(with_nulls))


def test_purchase_without_amount(spark):
    """A user's purchase sum is null if that is their only event, zero if there are others."""
    only = ("u1", "purchase", None, at("01-01 10:00"))
    other = ("u2", "purchase", None, at("01-01 10:00")), ("u2", "login", 0.0, at("01-01 11:00"))
    for events in (events_of(spark, [only, *other]),):
        assert values(op.ltv_detail(events)) == []
        assert value_set(op.segment_features(events)) == {("u1", 1, None), ("u2", 2, 0.0)}


def test_money_digits(spark):
    rows = [("u1", "purchase", 0.1, at("01-01 10:00"))] * 3
    events = events_of(spark, rows)
    rounded = AnalyticsConfig(money_digits=2)
    assert values(op.ltv_basic(events, rounded)) == [("u1", 0.3, 3)]
    assert values(op.ltv_basic(events)) == [("u1", 0.1 * 3, 3)]
    tiny = events_of(spark, [("u1", "purchase", 0.001, at("01-01 10:00"))])
    assert values(op.ltv_basic(tiny, rounded)) == [("u1", 0.0, 1)]


def test_unknown_names_fail(events):
    with pytest.raises(ValueError):
        op.cohort_daily(events, "other")
    with pytest.raises(ValueError):
        op.in_read_order(events, "other")
