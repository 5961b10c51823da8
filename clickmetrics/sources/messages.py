"""Events as JSON message text, the form they have on a message stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmetrics.functions import time_text
from clickmetrics.schema import CORRUPT_COLUMN, EVENT_COLUMNS, REQUIRED_COLUMNS
from clickmetrics.sources.files import TOLERANT_SCHEMA, read_options

VALUE = "value"
REASON = "reason"


def encode_messages(
    events: DataFrame, binary: bool = False, timestamp_format: str | None = None
) -> DataFrame:
    """One JSON object per event in column ``value``; nulls are written out.

    ``binary`` gives UTF-8 bytes, as message brokers carry them. Times keep their fractions of a
    second unless a format says otherwise.
    """
    events = events.withColumn("timestamp", time_text(F.col("timestamp"), timestamp_format))
    message = F.to_json(F.struct(*EVENT_COLUMNS), {"ignoreNullFields": "false"})
    return events.select((F.encode(message, "UTF-8") if binary else message).alias(VALUE))


def parse_messages(messages: DataFrame, value: str = VALUE) -> DataFrame:
    """Parse text or UTF-8 bytes in column ``value``, keeping the text next to the fields.

    ``reason`` is null for a good event. It says ``malformed`` where the text is not a JSON
    object or a field has the wrong type, and ``missing field`` where a required field is
    absent or null.
    """
    if dict(messages.dtypes)[value] == "binary":
        text = F.decode(F.col(value), "UTF-8")
    else:
        text = F.col(value)
    parsed = messages.select(text.alias(VALUE)).withColumn(
        "event", F.from_json(VALUE, TOLERANT_SCHEMA, read_options("tolerant"))
    )
    malformed = F.col("event").isNull() | F.col(f"event.{CORRUPT_COLUMN}").isNotNull()
    reason = F.when(malformed, "malformed").when(_missing_field(), "missing field")
    return parsed.select(
        VALUE, reason.alias(REASON), *[F.col(f"event.{name}") for name in EVENT_COLUMNS]
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good events, and the text of the others with the reason they were set aside."""
    good = parsed.filter(F.col(REASON).isNull()).select(*EVENT_COLUMNS)
    bad = parsed.filter(F.col(REASON).isNotNull()).select(VALUE, REASON)
    return good, bad


def _missing_field() -> Column:
    missing = [F.col(f"event.{name}").isNull() for name in REQUIRED_COLUMNS]
    return reduce(lambda left, right: left | right, missing)
