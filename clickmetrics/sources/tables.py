"""Events and metrics in catalog tables, and SQL text over them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmetrics.config import AnalyticsConfig
from clickmetrics.schema import DAY_COLUMN, DAY_ZONE_PROPERTY, EVENT_COLUMNS, LOAD_COLUMN

#: A day and a load, which name a partition; the day is None for events without a time.
Partition = tuple[str | None, str]



@dataclass(frozen=True)
class Ledger:
    """The names that go with a table of loads: the table, the one with a row for each day that was
    compacted, see ``folded_days``, and the one of closed loads."""

    table: str
    folded: str = "folded_days"
    closed: str = "closed_loads"


def events_ledger(config: AnalyticsConfig) -> Ledger:
    return Ledger(config.events_table)


def use_events(events: DataFrame, name: str = "events") -> DataFrame:
    """Make events available to ``spark.sql`` under a plain table name."""
    events.createOrReplaceTempView(name)
    return events.sparkSession.table(name)


def events_between(
    events: DataFrame,
    since: datetime | None = None,
    until: datetime | None = None,
    timestamp: str = "timestamp",
) -> DataFrame:
    """Events from ``since`` up to but not at ``until``.

    A bound without a zone is in the session's time zone, as the stored days are; one with a zone
    is converted to it. The bound is compared in the type of the stored column, so that the
    scan can use it, and on the partition day as well where there is one, so that other
    days are not read.
    """
    has_day = DAY_COLUMN in events.columns
    stored = events.schema[timestamp].dataType
    zone = events.sparkSession.conf.get("spark.sql.session.timeZone")
    moment = F.col(timestamp)
    if since is not None:
        since = _in_zone(since, zone)
        events = events.filter(moment >= _text(since).cast(stored))
        if has_day:
            events = events.filter(F.col(DAY_COLUMN) >= F.lit(since.date()))
    if until is not None:
        until = _in_zone(until, zone)
        events = events.filter(moment < _text(until).cast(stored))
        if has_day:
            events = events.filter(F.col(DAY_COLUMN) <= F.lit(_last_day_before(until)))
    return events


def _in_zone(moment: datetime, zone: str) -> datetime:
    """Wall-clock time in the session's zone."""
    return moment if moment.tzinfo is None else moment.astimezone(ZoneInfo(zone)).replace(tzinfo=None)


def _text(moment: datetime) -> Column:
    """As text, which Spark reads in the session's zone, whatever that of the machine."""
    return F.lit(moment.isoformat(sep=" "))


def events_table(
    spark: SparkSession,
    config: AnalyticsConfig = AnalyticsConfig(),
    since: datetime | None = None,
    until: datetime | None = None,
) -> DataFrame:
    """The stored events, all of them or those of a time range.

    A time range needs the session's zone to be the one that the table's days were cut in.
    """
    name = config.table(config.events_table)
    if since is not None or until is not None:
        check_day_zone(spark, name)
    stored = visible_partitions(current_table(spark, name), config)
    return events_between(stored, since, until).select(*EVENT_COLUMNS)


def current_table(spark: SparkSession, name: str) -> DataFrame:
    """A table whose files another session, such as a stream's, may have replaced."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def check_day_zone(spark: SparkSession, table: str) -> None:
    """Fail if the table's days were cut in another time zone than the session's."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    stored = {row["key"]: row["value"] for row in rows}.get(DAY_ZONE_PROPERTY)
    zone = spark.conf.get("spark.sql.session.timeZone")
    if stored is not None and stored != zone:
        raise ValueError(f"the days of {table} are those of {stored}, the session is in {zone}")


def visible_partitions(
    stored: DataFrame, config: AnalyticsConfig, ledger: Ledger | None = None
) -> DataFrame:
    """Leave out partitions that a compaction has folded into another one and not dropped yet, and
    those that one has written and not announced. Told by the partition columns and one row a
    day, without listing partitions."""
    days = folded_days(stored.sparkSession, config, ledger)
    announced = sorted({row.into for row in days})
    stored = stored.filter(~F.col(LOAD_COLUMN).startswith(FOLDED_PREFIX) | F.col(LOAD_COLUMN).isin(announced))
    pending = [(row.day, load) for row in days for load in row.pending]
    return stored.filter(~F.coalesce(in_partitions(pending), F.lit(False))) if pending else stored


def folded_days(
    spark: SparkSession, config: AnalyticsConfig, ledger: Ledger | None = None
) -> list[Row]:
    """One row for each day that was compacted: day, the load that holds its folded rows, and the loads
    that are in there and may not have been dropped yet."""
    name = config.table((ledger or events_ledger(config)).folded)
    if not spark.catalog.tableExists(name):
        return []
    days = current_table(spark, name)
    return days.select(F.col("day").cast("string").alias("day"), "into", "pending").collect()


def hidden_partitions(
    spark: SparkSession, config: AnalyticsConfig, ledger: Ledger | None = None
) -> list[Partition]:
    """(day, load) of the stored partitions that readers must not see."""
    ledger = ledger or events_ledger(config)
    of_day = {row.day: row for row in folded_days(spark, config, ledger)}

    def hidden(day: str | None, load: str) -> bool:
        row = of_day.get(day)
        if row is not None and load in row.pending:
            return True
        return load.startswith(FOLDED_PREFIX) and (row is None or load != row.into)

    stored = stored_partitions(spark, config.table(ledger.table))
    return sorted((part for part in stored if hidden(*part)), key=str)


def in_partitions(partitions: Iterable[Partition]) -> Column:
    """Whether a row is in one of the partitions given as (day, load).

    Plain comparisons of the partition columns, which prune partitions in the catalog. Days with the
    same loads share a comparison, and the tree of comparisons is balanced.
    """
    loads_of: dict[str | None, set[str]] = defaultdict(set)
    for day, load in partitions:
        loads_of[day].add(load)
    days_of: dict[frozenset[str], list[str | None]] = defaultdict(list)
    for day, loads in loads_of.items():
        days_of[frozenset(loads)].append(day)

    def one(loads: frozenset[str], days: list[str | None]) -> Column:
        known = [date.fromisoformat(day) for day in sorted(day for day in days if day is not None)]
        day = F.col(DAY_COLUMN).isin(known) if known else F.lit(False)
        if None in days:
            day = F.col(DAY_COLUMN).isNull() | day if known else F.col(DAY_COLUMN).isNull()
        return day & F.col(LOAD_COLUMN).isin(sorted(loads))

    terms = [one(loads, days) for loads, days in days_of.items()] or [F.lit(False)]
    while len(terms) > 1:
        terms = [a | b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2 :]
    return terms[0]


#: How loads are named that a compaction writes.
FOLDED_PREFIX = "folded."


def stored_partitions(spark: SparkSession, table: str, load: str | None = None) -> list[Partition]:
    """(day, load) of a table's partitions; the day is null for events without a time."""
    only = "" if load is None else f" PARTITION ({LOAD_COLUMN} = '{load}')"
    found = []
    for row in spark.sql(f"SHOW PARTITIONS {table}{only}").collect():
        values = dict(part.split("=", 1) for part in row.partition.split("/"))
        day = values[DAY_COLUMN]
        found.append((None if day == "__HIVE_DEFAULT_PARTITION__" else day, values[LOAD_COLUMN]))
    return found


def metric_table(
    spark: SparkSession,
    name: str,
    default: dict[str, object] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A stored metric. If it was never built: one ``default`` row, or no row, of ``schema``."""
    if spark.catalog.tableExists(name):
        return current_table(spark, name)
    if schema is None:
        raise ValueError(f"table {name} does not exist and no schema was given for a default")
    return spark.createDataFrame([] if default is None else [default], schema)


def _last_day_before(moment: datetime) -> date:
    return (moment - timedelta(microseconds=1)).date()
