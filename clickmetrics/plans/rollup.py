"""The rollups that metrics are built from: one that is kept, and one for each run."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.config import PURCHASE, AnalyticsConfig
from clickmetrics.functions import hour_of
from clickmetrics.operators.activity import (
    ACTIVITY_COLUMNS,
    AMOUNT,
    DATED_EVENTS,
    EVENTS,
    FIRST_AT,
    LAST_AT,
    PURCHASE_HOUR,
    as_activity,
    merged_rollup,
    user_event_rollup,
)
from clickmetrics.schema import DAY_COLUMN, EVENT_COLUMNS, LOAD_COLUMN, STORED_ROLLUP
from clickmetrics.sinks.events import drop_partitions
from clickmetrics.sources.tables import (
    Partition,
    current_table,
    hidden_partitions,
    in_partitions,
    stored_partitions,
)

ROLLUP_TABLE = "user_event_rollup"
#: Rows of a bucket at least, where there are buckets for all cores.
FEWEST_PER_BUCKET = 500_000


def refresh_rollup(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Bring the stored rollup up to date with the events, and return it.

    It has one row per day, load, user and event type, purchases also by hour, in partitions like
    those of the events. Only partitions that it does not have yet are read; those of loads
    that are gone, or were loaded again, were dropped. A run that breaks off while it writes
    leaves whole partitions, and the next one reads the others.
    """
    table = config.table(STORED_ROLLUP)
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {table} (
            user_id STRING, event_type STRING, {EVENTS} BIGINT, {DATED_EVENTS} BIGINT,
            {AMOUNT} DOUBLE, {FIRST_AT} TIMESTAMP, {LAST_AT} TIMESTAMP, {PURCHASE_HOUR} TIMESTAMP,
            {DAY_COLUMN} DATE, {LOAD_COLUMN} STRING
        )
        USING parquet
        OPTIONS (partitionOverwriteMode 'dynamic')
        PARTITIONED BY ({DAY_COLUMN}, {LOAD_COLUMN})
        """
    )
    there = set(stored_partitions(spark, table))
    drop_partitions(spark, table, sorted(there - visible_parts(spark, config), key=str))
    new = new_events(spark, config)
    if new is not None:
        rolled = merged_rollup(as_stored_rows(new))
        stored = rolled.select(*spark.table(table).columns)
        stored.hint("rebalance", DAY_COLUMN, LOAD_COLUMN).write.insertInto(table, overwrite=True)
    return current_table(spark, table)


def new_events(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame | None:
    """Events of the partitions that are not rolled up yet, with day and load; None if there are
    none. Other partitions are not read."""
    rolled = set()
    if spark.catalog.tableExists(config.table(STORED_ROLLUP)):
        rolled = set(stored_partitions(spark, config.table(STORED_ROLLUP)))
    return events_of_partitions(spark, visible_parts(spark, config) - rolled, config)


def events_of_partitions(
    spark: SparkSession, partitions: set[Partition], config: AnalyticsConfig
) -> DataFrame | None:
    """Events of some partitions, None for no partitions."""
    if not partitions:
        return None
    return current_table(spark, config.table(config.events_table)).filter(in_partitions(partitions))


def as_stored_rows(events: DataFrame) -> DataFrame:
    """Events in the shape of the stored rollup, one row each."""
    hour = F.when(F.col("event_type") == PURCHASE, hour_of(F.col(FIRST_AT)))
    placed = events.select(*EVENT_COLUMNS, DAY_COLUMN, LOAD_COLUMN)
    return placed.select(
        "user_id",
        "event_type",
        F.lit(1).cast("bigint").alias(EVENTS),
        F.when(F.col("timestamp").isNull(), 0).otherwise(1).cast("bigint").alias(DATED_EVENTS),
        F.col("amount").alias(AMOUNT),
        F.col("timestamp").alias(FIRST_AT),
        F.col("timestamp").alias(LAST_AT),
        DAY_COLUMN,
        LOAD_COLUMN,
    ).withColumn(PURCHASE_HOUR, hour)


def current_activity(
    spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()
) -> DataFrame:
    """All activity so far without writing anything: the stored rollup and the events since."""
    new = new_events(spark, config)
    if not spark.catalog.tableExists(config.table(STORED_ROLLUP)):
        events = current_table(spark, config.table(config.events_table))
        return as_activity(events.select(*EVENT_COLUMNS) if new is None else new)
    there = set(stored_partitions(spark, config.table(STORED_ROLLUP)))
    gone = there - visible_parts(spark, config)
    stored = current_table(spark, config.table(STORED_ROLLUP))
    if gone:
        stored = stored.filter(~F.coalesce(in_partitions(gone), F.lit(False)))
    stored = stored.select(*ACTIVITY_COLUMNS)
    return stored if new is None else stored.unionByName(as_activity(new).select(*ACTIVITY_COLUMNS))


def days_between(rollup: DataFrame, since: date | None, until: date | None) -> DataFrame:
    """The rollup's days from ``since`` up to but not at ``until``."""
    if since is not None:
        rollup = rollup.filter(F.col(DAY_COLUMN) >= F.lit(since))
    if until is not None:
        rollup = rollup.filter(F.col(DAY_COLUMN) < F.lit(until))
    return rollup


@contextmanager
def run_rollup(
    activity: DataFrame, config: AnalyticsConfig = AnalyticsConfig()
) -> Iterator[DataFrame]:
    """A run's own rollup, one row per user and event type, bucketed by user, dropped at the end.

    Each metric per user that is built on it needs no shuffle of its own, and a lost executor costs
    a re-read of it and not of the log. Only the rollup is bucketed: a user who holds a large part
    of the log has a handful of rows in it. Buckets of the log itself would put all of
    that user's events into one task. Runs at the same time have tables of their own.
    """
    spark = activity.sparkSession
    table = config.table(f"{ROLLUP_TABLE}_{uuid.uuid4().hex}")
    try:
        yield store_rollup(activity, table, config)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def store_rollup(
    activity: DataFrame, table: str, config: AnalyticsConfig = AnalyticsConfig()
) -> DataFrame:
    """Write the rollup of events or activity by user into ``table`` and return it."""
    spark = activity.sparkSession
    buckets = buckets_for(activity, config)
    (
        user_event_rollup(activity)
        .repartition(buckets, "user_id")
        .write.format("parquet")
        .bucketBy(buckets, "user_id")
        .saveAsTable(table)
    )
    return spark.table(table)


def buckets_for(activity: DataFrame, config: AnalyticsConfig) -> int:
    """How many buckets activity by user is to be kept in: one per core, more for more rows up to the
    shuffle partitions, and beyond that one per ``rollup_bucket_rows``.

    Every bucket is a task and a file of each table and metric, and a task costs the shuffles of a
    metric one block per shuffle partition, so buckets of a few rows would cost more than their rows.
    """
    if config.rollup_buckets is not None:
        return config.rollup_buckets
    spark, rows = activity.sparkSession, activity.count()
    spread = max(spark.sparkContext.defaultParallelism, -(-rows // FEWEST_PER_BUCKET))
    enough = min(spread, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return max(enough, -(-rows // config.rollup_bucket_rows))


def visible_parts(spark: SparkSession, config: AnalyticsConfig) -> set[Partition]:
    """Partitions of the events that readers see."""
    table = config.table(config.events_table)
    if not spark.catalog.tableExists(table):
        return set()
    return set(stored_partitions(spark, table)) - set(hidden_partitions(spark, config))
