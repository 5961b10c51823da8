"""What all stored events come to, by user and by hour, kept up to date load by load.

A version of the state is three tables: activity by user and event type, totals by user, and purchases by
hour. The first two are bucketed by user. A run adds the partitions that are not in the state yet: their
rows are dealt to the state's buckets and merged there, so the state itself is not shuffled and the history
not read. A version is valid once the list of its partitions is written, which is the last step; a run
that breaks off leaves the version before.

Minima and maxima cannot be taken back. If a partition that the state holds is gone or was loaded again,
the state is built anew from the stored rollup, which holds every partition apart.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.config import PURCHASE, AnalyticsConfig
from clickmetrics.operators.activity import (
    AMOUNT,
    EVENTS,
    PURCHASE_HOUR,
    as_activity,
    user_state,
)
from clickmetrics.plans.rollup import (
    buckets_for,
    current_activity,
    events_of_partitions,
    refresh_rollup,
    visible_parts,
)
from clickmetrics.schema import DAY_COLUMN, LOAD_COLUMN, STATE_PARTS, STATE_TABLES, STORED_ROLLUP
from clickmetrics.sinks.events import save_state_parts
from clickmetrics.sinks.metrics import VERSION_MARK, drop_old_versions, new_version, versions
from clickmetrics.sources.tables import Partition, in_partitions, stored_partitions


@dataclass(frozen=True)
class UserState:
    """A version of the state: its tables, their number of buckets, and the partitions in it."""

    activity: DataFrame
    users: DataFrame
    hours: DataFrame
    buckets: int
    parts: frozenset[Partition]


def stored_state(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> UserState | None:
    """The valid version, None if there is none."""
    current = versions(spark, config, STATE_PARTS)[-1:]
    if not current:
        return None
    rows = spark.table(config.table(current[0])).select(
        F.col(DAY_COLUMN).cast("string").alias("day"), LOAD_COLUMN, "version"
    )
    parts = rows.collect()
    names = [config.table(f"{name}{VERSION_MARK}{parts[0].version}") for name in STATE_TABLES]
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {names[0]}").filter("col_name = 'Num Buckets'")
    return UserState(
        *[spark.table(name) for name in names],
        buckets=int(described.first().data_type),
        parts=frozenset((row.day, row[LOAD_COLUMN]) for row in parts),
    )


def refresh_user_state(
    spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()
) -> UserState | None:
    """Bring the stored rollup and the state up to date and return the state, None without events.

    With nothing new nothing is written. The state keeps its number of buckets until it has
    outgrown them twice over.
    """
    rollup = refresh_rollup(spark, config)
    rolled = frozenset(stored_partitions(spark, config.table(STORED_ROLLUP)))
    state = stored_state(spark, config)
    if state is not None and not state.parts <= rolled:
        state = None
    if not rolled or state is not None and state.parts == rolled:
        return state
    if state is None:
        return _save(user_state(rollup), _by_hour(rollup), buckets_for(rollup, config), rolled, config)
    activity, hours = merged_state(state, rollup.filter(in_partitions(rolled - state.parts)))
    buckets = state.buckets
    if config.rollup_buckets is None:
        wanted = buckets_for(state.activity, config)
        buckets = wanted if wanted > 2 * buckets else buckets
    return _save(activity, hours, buckets, rolled, config, bucketed=buckets == state.buckets)


def merged_state(state: UserState, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The state's activity and hours with new rows of the rollup added. The new rows are added up and
    dealt to the state's buckets; the state stays where it is."""
    dealt = user_state(new).repartition(state.buckets, "user_id")
    activity = user_state(state.activity.unionByName(dealt))
    return activity, _by_hour(state.hours.unionByName(_by_hour(new)))


def current_totals(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Activity for totals over all events so far, a row a user at most, without writing anything:
    the state and the events of partitions that are not in it yet."""
    visible = visible_parts(spark, config)
    state = stored_state(spark, config)
    if state is None or not state.parts <= visible:
        return current_activity(spark, config)
    new = events_of_partitions(spark, visible - state.parts, config)
    if new is None:
        return state.users
    dealt = _totals(as_activity(new)).repartition(state.buckets, "user_id")
    return _totals(state.users.unionByName(dealt))


def _totals(activity: DataFrame) -> DataFrame:
    return activity.groupBy("user_id").agg(F.sum(EVENTS).alias(EVENTS), F.sum(AMOUNT).alias(AMOUNT))


def _by_hour(rows: DataFrame) -> DataFrame:
    purchases = rows.filter(F.col("event_type") == PURCHASE)
    return purchases.groupBy("event_type", PURCHASE_HOUR).agg(
        F.sum(EVENTS).alias(EVENTS), F.sum(AMOUNT).alias(AMOUNT)
    )


def _save(
    activity: DataFrame,
    hours: DataFrame,
    buckets: int,
    parts: frozenset[Partition],
    config: AnalyticsConfig,
    bucketed: bool = False,
) -> UserState:
    """Write a version of the state and make it the valid one."""
    spark = activity.sparkSession
    version = new_version("").removeprefix(VERSION_MARK)
    activity_table, users_table, hours_table = (
        config.table(f"{name}{VERSION_MARK}{version}") for name in STATE_TABLES
    )
    placed = activity if bucketed else activity.repartition(buckets, "user_id")
    placed.write.format("parquet").bucketBy(buckets, "user_id").saveAsTable(activity_table)
    users = _totals(spark.table(activity_table))
    users.write.format("parquet").bucketBy(buckets, "user_id").saveAsTable(users_table)
    hours.coalesce(1).write.format("parquet").saveAsTable(hours_table)
    save_state_parts(spark, set(parts), version, config)
    for name in STATE_TABLES:
        drop_old_versions(spark, config, name)
    return stored_state(spark, config)
