"""Staged CSV files to the events table, each file once."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.config import AnalyticsConfig
from clickmetrics.schema import EVENT_SCHEMA
from clickmetrics.sources.files import CSV_OPTIONS, read_options
from clickmetrics.streaming.ingest import MAX_FILE_AGE, load_batch, start_loading


def load_staged_csv(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    load_name: str,
    config: AnalyticsConfig = AnalyticsConfig(),
    after_load: Literal["keep", "archive", "delete"] = "keep",
    archive: str | None = None,
    max_files_per_batch: int = 1000,
) -> None:
    """Load the CSV files that were added since the last run, then return.

    The checkpoint remembers the files that are done, which replaces emptying the staging file.
    ``after_load`` can have Spark move done files to ``archive`` or delete them as well; Spark
    does that with the batch after the one that read them. Texts may hold line breaks, so a file is
    read by one task; ``append_csv`` keeps files to a size. A record that does not fit fails
    the run, and the files are tried again on the next one.
    """
    reader = spark.readStream.schema(EVENT_SCHEMA).options(
        maxFilesPerTrigger=max_files_per_batch,
        maxFileAge=MAX_FILE_AGE,
        **CSV_OPTIONS,
        **read_options("strict"),
        multiLine=True,
    )
    if after_load == "archive":
        if archive is None:
            raise ValueError("archive needs a folder")
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    elif after_load == "delete":
        reader = reader.option("cleanSource", "delete")

    start_loading(
        reader.csv(path),
        load_name,
        checkpoint,
        lambda batch, load_id: load_batch(batch, load_id, config),
        lambda writer: writer.trigger(availableNow=True),
    ).awaitTermination()
