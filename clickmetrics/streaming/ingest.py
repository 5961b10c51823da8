"""Messages to the events table, in micro-batches.

The source's offsets and the checkpoint stand in for a buffer and acknowledgements. A batch
that is run again after a failure has the same number and the same rows, and replaces its own
partitions, so every message is stored once.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import Future
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clickmetrics.config import AnalyticsConfig
from clickmetrics.schema import DAY_COLUMN, LOAD_COLUMN
from clickmetrics.sinks.events import ClosedLoadError, fold_loads, is_folded, load_events
from clickmetrics.sources.messages import parse_messages, split_parsed
from clickmetrics.sources.tables import (
    Ledger,
    current_table,
    stored_partitions,
    visible_partitions,
)

log = logging.getLogger(__name__)

#: Messages set aside, by the day they were and by batch.
QUARANTINE = Ledger("events_quarantine", "folded_quarantine", "closed_quarantine")
QUARANTINE_COLUMNS = ("value", "reason")


#: How far behind the newest file a file may be dated and still be read. Spark's own default of a
#: week silently skips late and restored files; a century reads them all.
MAX_FILE_AGE = "36500d"


def file_messages(
    spark: SparkSession, path: str, max_files_per_batch: int = 1000, archive: str | None = None
) -> DataFrame:
    """Stream of messages landing in a folder, one per line.

    A backlog is worked off in several batches, each of a size the cluster can hold. Files of any
    date are read. The checkpoint lists the files that are done, on the driver too; ``archive``
    names a folder, outside of ``path``, that Spark moves them to, which keeps the landing
    folder short to list.
    """
    reader = spark.readStream.format("text").options(
        maxFilesPerTrigger=max_files_per_batch, maxFileAge=MAX_FILE_AGE
    )
    if archive is not None:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return reader.load(path)


def kafka_messages(spark: SparkSession, **options: str) -> DataFrame:
    """Stream of messages from Kafka; needs Spark's Kafka package on the cluster."""
    return spark.readStream.format("kafka").options(**options).load().select("value")


def ingest_messages(
    messages: DataFrame,
    stream_name: str,
    checkpoint: str,
    config: AnalyticsConfig = AnalyticsConfig(),
    available_now: bool = False,
) -> StreamingQuery:
    """Start storing a stream of messages; returns the running query.

    Good events go to the events table. Text that is not an event goes to a quarantine table
    with the reason, and does not hold up its batch. ``available_now`` stores what is there
    and stops, otherwise a batch runs every flush interval. Loads are named by ``stream_name``,
    by the id that the checkpoint keeps, and by batch, so a stream with another checkpoint never
    takes the place of this one's loads.
    """

    def store(batch: DataFrame, load_id: str) -> None:
        parsed = parse_messages(batch).persist()
        try:
            good, bad = split_parsed(parsed)
            load_batch(good, load_id, config)
            _set_aside(bad, load_id, config)
        finally:
            parsed.unpersist()

    def trigger(writer: DataStreamWriter) -> DataStreamWriter:
        return _trigger(writer, config, available_now)

    return start_loading(messages, stream_name, checkpoint, store, trigger)


def start_loading(
    stream: DataFrame,
    stream_name: str,
    checkpoint: str,
    store: Callable[[DataFrame, str], None],
    trigger: Callable[[DataStreamWriter], DataStreamWriter],
) -> StreamingQuery:
    """Start a query that stores each batch under a load id of its own."""
    identity: Future[str] = Future()

    def store_batch(batch: DataFrame, batch_id: int) -> None:
        store(batch, f"{stream_name}-{identity.result()}-{batch_id:012d}")

    query = (
        trigger(stream.writeStream.foreachBatch(store_batch))
        .option("checkpointLocation", checkpoint)
        .queryName(stream_name)
        .start()
    )
    # The same for every run with this checkpoint; the first batch waits for it.
    identity.set_result(str(query.id).replace("-", ""))
    return query


def load_batch(events: DataFrame, load_id: str, config: AnalyticsConfig) -> None:
    """Store a batch. One that was compacted since is stored already, and is replayed only."""
    try:
        load_events(events, load_id, config)
    except ClosedLoadError:
        log.info("load %s is stored and compacted", load_id)


def quarantined(spark: SparkSession, config: AnalyticsConfig = AnalyticsConfig()) -> DataFrame:
    """Messages set aside so far: text and reason."""
    stored = current_table(spark, config.table(QUARANTINE.table))
    return visible_partitions(stored, config, QUARANTINE).select(*QUARANTINE_COLUMNS)


def compact_quarantine(
    spark: SparkSession, before: date, config: AnalyticsConfig = AnalyticsConfig()
) -> int:
    """Fold what was set aside on each day before ``before`` into one partition per day, as
    ``compact_events`` does for events; returns the days. A folded batch that is replayed is not
    stored again."""
    if not spark.catalog.tableExists(config.table(QUARANTINE.table)):
        return 0
    folded, _ = fold_loads(spark, before, config, QUARANTINE, QUARANTINE_COLUMNS, "reason")
    return len(folded)


def _trigger(
    writer: DataStreamWriter, config: AnalyticsConfig, available_now: bool
) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=config.flush_interval)


def _set_aside(bad: DataFrame, load_id: str, config: AnalyticsConfig) -> None:
    """Store a batch's bad messages under the day of its first try."""
    if bad.isEmpty():
        return
    spark, table = bad.sparkSession, config.table(QUARANTINE.table)
    spark.sql(
        f"""
        CREATE TABLE IF NOT EXISTS {table} (
            value STRING, reason STRING, {DAY_COLUMN} DATE, {LOAD_COLUMN} STRING
        )
        USING parquet
        OPTIONS (partitionOverwriteMode 'dynamic')
        PARTITIONED BY ({DAY_COLUMN}, {LOAD_COLUMN})
        """
    )
    if is_folded(spark, load_id, config, QUARANTINE):
        return
    tried = stored_partitions(spark, table, load_id)
    day = F.lit(tried[0][0]).cast("date") if tried else F.current_date()
    placed = bad.select(*QUARANTINE_COLUMNS, day.alias(DAY_COLUMN), F.lit(load_id).alias(LOAD_COLUMN))
    placed.write.insertInto(table, overwrite=True)
