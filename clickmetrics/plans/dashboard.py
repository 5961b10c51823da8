"""What a dashboard reads, one small frame per part."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmetrics import operators as op
from clickmetrics.config import AnalyticsConfig
from clickmetrics.plans.user_state import current_totals
from clickmetrics.schema import EVENT_SCHEMA, METRIC_SCHEMAS
from clickmetrics.sources.tables import metric_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class DashboardPartError:
    """Stands for a part that failed."""

    part: str
    reason: str


def dashboard_snapshot(
    spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()
) -> dict[str, DataFrame]:
    """All parts of the dashboard. The key figures are counted from the totals by user and the
    events since, the rest is read from the tables of the last run.

    A part whose table is missing or has another shape shows its default and does not disturb
    the others.
    """

    def part(
        table: str, build: Callable[[DataFrame], DataFrame], schema: T.StructType | str | None = None
    ) -> DataFrame:
        schema = schema or METRIC_SCHEMAS[table]
        try:
            return build(metric_table(spark, config.table(table), schema=schema))
        except AnalysisException as error:
            log.warning("table %s cannot be shown: %s", table, error)
            return build(spark.createDataFrame([], schema))

    def stats() -> DataFrame:
        if not spark.catalog.tableExists(config.table(config.events_table)):
            return op.kpi_global(spark.createDataFrame([], EVENT_SCHEMA), config)
        return op.kpi_global(current_totals(spark, config), config)

    return {
        "stats": stats(),
        "top_customers": part("ltv_metrics", lambda ltv: op.top_customers(ltv, config)),
        "funnel": part("funnel_metrics", op.funnel_display),
        "conversion": part("funnel_metrics", op.conversion_rate),
        "segments": part("user_segments", op.segment_distribution),
        "cohorts": part("cohort_metrics", op.cohort_series),
        "retention": part("retention_metrics", op.retention_row),
        "churn": part("churn_metrics", op.churn_summary),
    }


def dashboard_records(
    spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()
) -> dict[str, list[dict] | DashboardPartError]:
    """The snapshot as plain records. Parts have a row per stage, label or day at most.

    A part that cannot be computed is an error value in its place, not an empty list.
    """
    records: dict[str, list[dict] | DashboardPartError] = {}
    for name, frame in dashboard_snapshot(spark, config).items():
        try:
            records[name] = [row.asDict() for row in frame.collect()]
        except PySparkException as error:
            log.warning("part %s cannot be read: %s", name, error)
            records[name] = DashboardPartError(name, str(error))
    return records
