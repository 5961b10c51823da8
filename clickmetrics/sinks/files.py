"""Event files for staging and for message streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmetrics.functions import time_text
from clickmetrics.schema import EVENT_COLUMNS
from clickmetrics.sources.messages import encode_messages

# Text comes back as it was: quotes doubled, blanks kept, an empty text told from a null.
WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

#: Rows of a staging file, some tens of megabytes.
ROWS_PER_FILE = 1_000_000


def append_csv(
    events: DataFrame,
    path: str,
    timestamp_format: str | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Add events to a CSV staging folder, every file with a header.

    A frame without an ``amount`` column is written with amount 0.0; a null amount stays null. Times
    keep their fractions of a second unless a format says otherwise. A text with line breaks is
    quoted and comes back as it was from ``load_staged_csv``, or ``csv_events`` with
    ``multi_line``. These read a file as a whole, so files are kept to ``rows_per_file`` rows.
    """
    if "amount" not in events.columns:
        events = events.withColumn("amount", F.lit(0.0))
    text = time_text(F.col("timestamp"), timestamp_format).alias("timestamp")
    events.select(*EVENT_COLUMNS[:-1], text).write.mode("append").options(
        **WRITE_OPTIONS, maxRecordsPerFile=rows_per_file
    ).csv(path)


def append_messages(events: DataFrame, path: str, timestamp_format: str | None = None) -> None:
    """Add events to a landing folder as JSON lines, one message per line."""
    encode_messages(events, timestamp_format=timestamp_format).write.mode("append").text(path)
