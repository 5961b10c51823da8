"""Metrics, replaced as a whole on every run."""

from __future__ import annotations

import logging
import time
from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.config import AnalyticsConfig

log = logging.getLogger(__name__)

VERSION_MARK = "__v"


def save_metric(
    metric: DataFrame,
    name: str,
    config: AnalyticsConfig = AnalyticsConfig(),
    on_empty: Literal["keep", "replace"] = "keep",
) -> bool:
    """Replace metric ``name``, rows and schema, with ``metric``; tell whether it was replaced.

    The metric is computed once, into a table of its own, and ``name`` is a view that then turns to
    it in one step. A reader sees the old or the new rows at any time, and the old ones stay if the
    computation or the process fails. With ``keep`` an empty result leaves them as well. The
    version before the last is dropped, so that whoever still reads the last one can finish.
    """
    spark = metric.sparkSession
    target = config.table(name)
    version = new_version(name)
    metric.write.format("parquet").saveAsTable(config.table(version))
    if on_empty == "keep" and spark.table(config.table(version)).isEmpty():
        log.warning("no rows for %s, left as it was", target)
        spark.sql(f"DROP TABLE {config.table(version)}")
        return False
    if _is_plain_table(spark, config, name):
        # As stored before metrics had versions.
        spark.sql(f"ALTER TABLE {target} RENAME TO {config.table(f'{name}{VERSION_MARK}{0:020d}')}")
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {config.table(version)}")
    drop_old_versions(spark, config, name)
    return True


def drop_old_versions(spark: SparkSession, config: AnalyticsConfig, name: str) -> None:
    """Drop all versions but the last two."""
    for old in versions(spark, config, name)[:-2]:
        spark.sql(f"DROP TABLE IF EXISTS {config.table(old)}")


def new_version(name: str) -> str:
    """A name for the next version of a table, after all earlier ones in order."""
    return f"{name}{VERSION_MARK}{time.time_ns():020d}"


def versions(spark: SparkSession, config: AnalyticsConfig, name: str) -> list[str]:
    """Tables that hold versions of a metric or state, the oldest first."""
    rows = spark.sql(f"SHOW TABLES IN {config.database} LIKE '{name}{VERSION_MARK}*'").collect()
    return sorted(row.tableName for row in rows)


def _is_plain_table(spark: SparkSession, config: AnalyticsConfig, name: str) -> bool:
    target = config.table(name)
    return spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType != "VIEW"
