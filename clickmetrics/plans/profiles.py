"""The two batch runs: each adds new loads to the stored state and replaces its metric tables.

Metrics come first, several side by side, segments and churn after them; each is a Spark job spread
over the whole cluster. An error stops the run and is raised.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date
from multiprocessing.pool import ThreadPool
from typing import Literal

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from clickmetrics import operators as op
from clickmetrics.config import AnalyticsConfig
from clickmetrics.plans.rollup import days_between, refresh_rollup, run_rollup
from clickmetrics.plans.user_state import refresh_user_state
from clickmetrics.schema import EventSchemaError, require_event_columns
from clickmetrics.sinks.events import create_events_table
from clickmetrics.sinks.metrics import save_metric
from clickmetrics.sources.tables import current_table, events_table

OnEmpty = Literal["keep", "replace"]
Build = Callable[[DataFrame, AnalyticsConfig], DataFrame]

#: Metrics per user, built from a run's rollup by user.
USER_METRICS: dict[str, Build] = {
    "ltv_metrics": op.ltv_basic,
    "ltv_detail": op.ltv_detail,
    "retention_metrics": lambda rollup, config: op.retention_summary(
        rollup, config, row_without_users=False
    ),
    "cohort_metrics": lambda rollup, config: op.cohort_daily(rollup, "drop_null_day"),
    "cohort_metrics_keep_null_day": lambda rollup, config: op.cohort_daily(rollup, "keep_null_day"),
    "funnel_metrics": op.funnel_fixed,
    "funnel_observed": lambda rollup, config: op.funnel_users(rollup),
    "funnel_volume": lambda rollup, config: op.funnel_volume(rollup),
    "churn_metrics": op.churn_risk,
}
#: Metrics by day, and those by hour.
DAY_METRICS: dict[str, Build] = {
    "user_daily_activity": lambda by_day, config: op.user_daily_activity(by_day)
}
HOUR_METRICS: dict[str, Build] = {"revenue_trend": op.revenue_hourly}
SEGMENTS = "user_segments"

LOCAL_RUN = ("ltv_metrics", "retention_metrics", "cohort_metrics", "funnel_metrics")
WAREHOUSE_RUN = ("ltv_detail", "funnel_volume", "user_daily_activity", "revenue_trend")
#: The warehouse's models in their third form: detailed values, retention in one row, cohorts with
#: an unknown day, and the funnel of the types found.
SQL_RUN = ("ltv_detail", "retention_metrics", "cohort_metrics_keep_null_day", "funnel_observed")


def run_local_profile(
    spark: SparkSession,
    config: AnalyticsConfig = AnalyticsConfig(),
    model_path: str | None = None,
    since: date | None = None,
    until: date | None = None,
) -> list[str]:
    """Lifetime value, retention, cohorts and funnel, then segments and churn.

    A metric without rows leaves its old table. ``since`` and ``until`` limit the run to days.
    Returns the names of the tables replaced.
    """
    create_events_table(spark, config)
    return _run(spark, config, LOCAL_RUN, "keep", model_path, since, until)


def run_warehouse_profile(
    spark: SparkSession,
    config: AnalyticsConfig = AnalyticsConfig(),
    model_path: str | None = None,
    since: date | None = None,
    until: date | None = None,
) -> list[str]:
    """Check the events, then detailed lifetime value, volume funnel, daily activity and
    hourly revenue, then segments and churn.

    A metric without rows empties its table. Returns the names of the tables replaced.
    """
    verify_events(spark, config)
    return _run(spark, config, WAREHOUSE_RUN, "replace", model_path, since, until)


def run_metrics(
    spark: SparkSession,
    names: list[str],
    config: AnalyticsConfig = AnalyticsConfig(),
    on_empty: OnEmpty = "keep",
    since: date | None = None,
    until: date | None = None,
    more: dict[str, Build] | None = None,
) -> list[str]:
    """Replace single metrics, such as one of a run that failed, or ``SQL_RUN``, or one's own.

    ``more`` has further metrics by name: functions of the rollup by user and the settings.
    """
    user_metrics = USER_METRICS | (more or {})
    unknown = set(names) - {*user_metrics, *DAY_METRICS, *HOUR_METRICS}
    if unknown:
        raise ValueError(f"no such metric: {', '.join(sorted(unknown))}")
    create_events_table(spark, config)
    with run_inputs(spark, config, since, until) as inputs:
        return _save_all(_built(names, inputs, user_metrics, config), config, on_empty)


def verify_events(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """The stored events, or an error if they have another schema or there are none."""
    require_event_columns(current_table(spark, config.table(config.events_table)))
    events = events_table(spark, config)
    if events.isEmpty():
        raise EventSchemaError(f"{config.table(config.events_table)} holds no events")
    return events


def _run(
    spark: SparkSession,
    config: AnalyticsConfig,
    names: tuple[str, ...],
    on_empty: OnEmpty,
    model_path: str | None,
    since: date | None,
    until: date | None,
) -> list[str]:
    with run_inputs(spark, config, since, until) as inputs:
        saved = _save_all(_built(names, inputs, USER_METRICS, config), config, on_empty)
        return saved + _save_models(inputs.by_user, config, model_path)


@dataclass(frozen=True)
class RunInputs:
    """What the metrics of a run are built from: activity by user, by day and by hour."""

    by_user: DataFrame
    by_day: DataFrame
    by_hour: DataFrame


@contextmanager
def run_inputs(
    spark: SparkSession, config: AnalyticsConfig, since: date | None = None, until: date | None = None
) -> Iterator[RunInputs]:
    """A run over all days reads the state, to which new loads are added first. One over some days
    has those days of the stored rollup, and a rollup by user of its own."""
    state = refresh_user_state(spark, config) if since is None and until is None else None
    if state is not None:
        yield RunInputs(state.activity, state.activity, state.hours)
        return
    rollup = days_between(refresh_rollup(spark, config), since, until)
    with run_rollup(rollup, config) as by_user:
        yield RunInputs(by_user, rollup, rollup)


def _built(
    names, inputs: RunInputs, user_metrics: dict[str, Build], config: AnalyticsConfig
) -> dict[str, DataFrame]:
    kinds = ((DAY_METRICS, inputs.by_day), (HOUR_METRICS, inputs.by_hour), (user_metrics, inputs.by_user))
    return {
        name: next(metrics[name](frame, config) for metrics, frame in kinds if name in metrics)
        for name in names
    }


def _save_all(
    metrics: dict[str, DataFrame], config: AnalyticsConfig, on_empty: OnEmpty
) -> list[str]:
    """Save metrics, several at a time; the names of those replaced, in their order."""
    if not metrics:
        return []
    spark = next(iter(metrics.values())).sparkSession
    save = inheritable_thread_target(spark)(
        lambda item: save_metric(item[1], item[0], config, on_empty)
    )
    with ThreadPool(min(config.metric_parallelism, len(metrics))) as pool:
        replaced = pool.map(save, metrics.items(), chunksize=1)
    return [name for name, done in zip(metrics, replaced) if done]


def _save_models(by_user: DataFrame, config: AnalyticsConfig, model_path: str | None) -> list[str]:
    tables = {"churn_metrics": op.churn_risk(by_user, config)}
    segmentation = op.fit_segments(op.segment_features(by_user, config), config)
    if segmentation is not None:
        tables[SEGMENTS] = segmentation.users
        if model_path is not None:
            segmentation.model.save(model_path)
    return _save_all(tables, config, "keep")
