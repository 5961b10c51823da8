"""The stored events table, partitioned by day and by load."""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmetrics.config import AnalyticsConfig
from clickmetrics.operators.activity import merged_rollup
from clickmetrics.schema import (
    DAY_COLUMN,
    DAY_ZONE_PROPERTY,
    EVENT_COLUMNS,
    LOAD_COLUMN,
    STATE_PARTS,
    STORED_ROLLUP,
)
from clickmetrics.session import in_shared_folder
from clickmetrics.sinks.metrics import drop_old_versions, new_version, save_metric, versions
from clickmetrics.sources.tables import (
    FOLDED_PREFIX,
    Ledger,
    Partition,
    check_day_zone,
    current_table,
    events_ledger,
    folded_days,
    hidden_partitions,
    in_partitions,
    stored_partitions,
)



#: The loads of days, None for events without a time.
LoadsOfDays = dict[str | None, list[str]]


def create_events_table(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> None:
    """Create the events table if it does not exist yet.

    The table option makes every overwriting insert replace only the partitions it has rows
    for, whatever the session is set to, and stages each insert in a folder of its own, so that
    loads may run side by side.
    """
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {config.table(config.events_table)} (
            user_id STRING, event_type STRING, amount DOUBLE, timestamp TIMESTAMP,
            {DAY_COLUMN} DATE, {LOAD_COLUMN} STRING
        )
        USING parquet
        OPTIONS (partitionOverwriteMode 'dynamic')
        PARTITIONED BY ({DAY_COLUMN}, {LOAD_COLUMN})
        TBLPROPERTIES ('{DAY_ZONE_PROPERTY}' '{spark.conf.get("spark.sql.session.timeZone")}')
        """
    )


class ClosedLoadError(ValueError):
    """The load was folded together with others by a compaction and cannot be replaced any more."""


def load_events(
    events: DataFrame, load_id: str, config: AnalyticsConfig = AnalyticsConfig()
) -> None:
    """Add one load of events to the table, creating the table if needed.

    Loading again under the same ``load_id`` replaces what that load wrote before, so a retry
    does not duplicate; other loads are never touched. The new rows are written before
    anything is dropped: a load that fails leaves the table as it was, and ``events`` may be read
    from the table itself. One that fails between writing and dropping leaves days of the earlier
    attempt behind that the new one does not have; the next try removes them.

    Rows are gathered by day before the write, to keep files few. The rebalance hint lets
    adaptive execution split a day that is much larger than others and merge small ones.
    Within a file rows are sorted by event type, so that a filter on the type skips row groups.
    """
    if not re.fullmatch(r"[\w.-]+", load_id):
        raise ValueError(f"a load id is made of letters, digits, '_', '.' and '-': {load_id!r}")
    spark = events.sparkSession
    table = config.table(config.events_table)
    create_events_table(spark, config)
    check_day_zone(spark, table)
    if is_folded(spark, load_id, config):
        raise ClosedLoadError(f"load {load_id} was compacted with others")
    earlier = stored_partitions(spark, table, load_id)
    placed = events.select(
        *EVENT_COLUMNS,
        F.to_date("timestamp").alias(DAY_COLUMN),
        F.lit(load_id).alias(LOAD_COLUMN),
    )
    if earlier:
        # The days of the new attempt are read from what will be stored, computed once.
        placed = in_shared_folder(placed, "reload")
        days = {row[0] for row in placed.select(F.col(DAY_COLUMN).cast("string")).distinct().collect()}
    forget_rollup(spark, load_id, config)
    _by_day(placed).write.insertInto(table, overwrite=True)
    if earlier:
        drop_partitions(spark, table, [part for part in earlier if part[0] not in days])
    forget_rollup(spark, load_id, config)


def _by_day(placed: DataFrame, within: str = "event_type") -> DataFrame:
    return placed.hint("rebalance", DAY_COLUMN).sortWithinPartitions(DAY_COLUMN, LOAD_COLUMN, within)


def drop_partitions(spark: SparkSession, table: str, partitions: list[Partition]) -> None:
    """Drop partitions given as (day, load)."""
    if partitions:
        specs = ", ".join(
            f"PARTITION ({DAY_COLUMN} = {_day_literal(day)}, {LOAD_COLUMN} = '{load}')"
            for day, load in partitions
        )
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")


def _day_literal(day: str | None) -> str:
    return "null" if day is None else f"'{day}'"


def is_folded(
    spark: SparkSession, load_id: str, config: AnalyticsConfig, ledger: Ledger | None = None
) -> bool:
    """Whether a load was closed by a compaction."""
    name = config.table((ledger or events_ledger(config)).closed)
    if not spark.catalog.tableExists(name):
        return False
    source, number = _place(load_id)
    closed = current_table(spark, name)
    return not closed.filter((F.col("source") == source) & (F.col("number") >= number)).isEmpty()


def _place(load_id: str) -> tuple[str, int]:
    """A load's source and its number there: a stream counts its batches, others are one load."""
    batch = re.fullmatch(r"(.+-[0-9a-f]{32})-(\d{12})", load_id)
    return (batch[1], int(batch[2])) if batch else (load_id, 0)


def close_loads(
    spark: SparkSession, loads: list[str], config: AnalyticsConfig, ledger: Ledger
) -> None:
    """Refuse these loads from now on. A stream's batches come in order, so the last one's number
    stands for all before it."""
    last: dict[str, int] = {}
    for source, number in map(_place, loads):
        last[source] = max(last.get(source, 0), number)
    closed = spark.createDataFrame(list(last.items()), "source string, number bigint")
    if spark.catalog.tableExists(config.table(ledger.closed)):
        closed = current_table(spark, config.table(ledger.closed)).unionByName(closed)
    closed = closed.groupBy("source").agg(F.max("number").alias("number"))
    save_metric(closed, ledger.closed, config, "replace")


def forget_rollup(spark: SparkSession, load_id: str, config: AnalyticsConfig) -> None:
    """Drop what is rolled up of a load, so that the next run reads the load anew. What was
    added up by user cannot be taken out of there: it is built again from the rollup."""
    rollup = config.table(STORED_ROLLUP)
    if spark.catalog.tableExists(rollup):
        drop_partitions(spark, rollup, stored_partitions(spark, rollup, load_id))
    for parts in versions(spark, config, STATE_PARTS):
        if not spark.table(config.table(parts)).filter(F.col(LOAD_COLUMN) == load_id).isEmpty():
            spark.sql(f"DROP TABLE IF EXISTS {config.table(parts)}")


def compact_events(
    spark: SparkSession, before: date, config: AnalyticsConfig = AnalyticsConfig()
) -> int:
    """Fold the loads of each day before ``before``, and those without a day, into one partition
    each; returns how many such partitions were written.

    Streams add a partition per batch and day; folding closed days bounds how many there are. The
    partitions to fold are listed once and just these are read, so a load that lands meanwhile stays
    as it is. Their rows are written to a partition that readers do not see, the loads are closed,
    and a new version of ``folded_days`` is the moment readers change over; only then the old
    partitions are dropped. A compaction that breaks off loses and doubles nothing, and the
    next one cleans up. Of closed loads a stream batch that is replayed counts as stored, any
    other is refused. Do not replace a load while its days are folded, and run one compaction at a time.

    What is rolled up of the folded loads is folded with them, so that no run reads them again.
    """
    def fold_more(folded: LoadsOfDays, into: str) -> None:
        fold_rollup(spark, folded, into, config)

    folded, into = fold_loads(spark, before, config, events_ledger(config), EVENT_COLUMNS, "event_type", fold_more)
    if folded:
        old = [(day, load) for day, loads in folded.items() for load in loads]
        if spark.catalog.tableExists(config.table(STORED_ROLLUP)):
            drop_partitions(spark, config.table(STORED_ROLLUP), old)
        fold_state_parts(spark, folded, into, config)
    return len(folded)


def fold_loads(
    spark: SparkSession,
    before: date,
    config: AnalyticsConfig,
    ledger: Ledger,
    columns: Sequence[str],
    within: str,
    fold_more: Callable[[LoadsOfDays, str], None] = lambda folded, into: None,
) -> tuple[LoadsOfDays, str]:
    """Fold the loads of a table as ``compact_events`` does; what was folded, and into which load.

    Rows are sorted by the column ``within``. ``fold_more`` is called before readers change over.
    """
    table = config.table(ledger.table)
    drop_partitions(spark, table, hidden_partitions(spark, config, ledger))
    loads_of = defaultdict(list)
    for day, load in stored_partitions(spark, table):
        if day is None or day < before.isoformat():
            loads_of[day].append(load)
    many = {day: loads for day, loads in loads_of.items() if len(loads) > 1}
    into = f"{FOLDED_PREFIX}{uuid.uuid4().hex}"
    if not many:
        return {}, into
    old = [(day, load) for day, loads in many.items() for load in loads]
    rows = (
        current_table(spark, table)
        .filter(in_partitions(old))
        .select(*columns, DAY_COLUMN, F.lit(into).alias(LOAD_COLUMN))
    )
    _by_day(rows, within).write.insertInto(table, overwrite=True)
    fold_more(many, into)
    close_loads(spark, [load for _, load in old if not load.startswith(FOLDED_PREFIX)], config, ledger)
    announce(spark, many, into, config, ledger)
    drop_partitions(spark, table, old)
    announce(spark, {day: [] for day in many}, into, config, ledger)
    return many, into


def announce(
    spark: SparkSession, folded: LoadsOfDays, into: str, config: AnalyticsConfig, ledger: Ledger
) -> None:
    """Turn readers to the folded rows of days, and away from loads that are not dropped yet."""
    others = [row for row in folded_days(spark, config, ledger) if row.day not in folded]
    rows = [(row.day, row.into, row.pending) for row in others]
    rows += [(day, into, loads) for day, loads in folded.items()]
    frame = spark.createDataFrame(rows, "day string, into string, pending array<string>")
    frame = frame.withColumn("day", F.col("day").cast("date")).coalesce(1)
    save_metric(frame, ledger.folded, config, "replace")


def fold_rollup(spark: SparkSession, folded: LoadsOfDays, into: str, config: AnalyticsConfig) -> None:
    """Roll folded loads up together, of days of which each load is rolled up. It is not read
    before the folded partition is announced."""
    rollup = config.table(STORED_ROLLUP)
    if not spark.catalog.tableExists(rollup):
        return
    there = set(stored_partitions(spark, rollup))
    whole = [(day, load) for day, loads in folded.items() for load in loads if {(day, x) for x in loads} <= there]
    if whole:
        stored = current_table(spark, rollup).filter(in_partitions(whole))
        merged = merged_rollup(stored.withColumn(LOAD_COLUMN, F.lit(into))).select(*spark.table(rollup).columns)
        merged.hint("rebalance", DAY_COLUMN).write.insertInto(rollup, overwrite=True)


def fold_state_parts(spark: SparkSession, folded: LoadsOfDays, into: str, config: AnalyticsConfig) -> None:
    """Tell the state by user that it has the folded partitions in place of the loads' own, where it
    has all of a day's. Otherwise it is found to hold what is gone, and is built again."""
    current = versions(spark, config, STATE_PARTS)[-1:]
    if not current:
        return
    parts = spark.table(config.table(current[0])).withColumn("day", F.col(DAY_COLUMN).cast("string")).collect()
    has = {(row.day, row[LOAD_COLUMN]) for row in parts}
    for day, loads in folded.items():
        own = {(day, load) for load in loads}
        if own <= has:
            has = has - own | {(day, into)}
    save_state_parts(spark, has, parts[0].version, config)


def save_state_parts(
    spark: SparkSession, parts: set[Partition], version: str, config: AnalyticsConfig
) -> None:
    """Make a version of the state by user the valid one, with the partitions that it holds."""
    rows = [(day, load, version) for day, load in sorted(parts, key=str)]
    frame = spark.createDataFrame(rows, f"{DAY_COLUMN} string, {LOAD_COLUMN} string, version string")
    frame = frame.withColumn(DAY_COLUMN, F.col(DAY_COLUMN).cast("date")).coalesce(1)
    frame.write.format("parquet").saveAsTable(config.table(new_version(STATE_PARTS)))
    drop_old_versions(spark, config, STATE_PARTS)
