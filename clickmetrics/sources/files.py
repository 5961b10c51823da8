"""Event files. All readers take the schema as given, so an all-digit user id stays text."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmetrics.config import TIMESTAMP_FORMAT
from clickmetrics.schema import CORRUPT_COLUMN, EVENT_SCHEMA

ReadMode = Literal["strict", "tolerant"]

TOLERANT_SCHEMA = T.StructType([*EVENT_SCHEMA, T.StructField(CORRUPT_COLUMN, T.StringType())])


# Quotes inside quoted text are doubled, blanks belong to the text, and a quoted empty text is no
# null: a field without anything reads as the null mark, which no text is taken to hold.
CSV_OPTIONS = {
    "nullValue": "\ue000null\ue000",
    "header": True,
    "enforceSchema": False,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_options(mode: ReadMode) -> dict[str, str]:
    if mode == "strict":
        return {"mode": "FAILFAST", "timestampFormat": TIMESTAMP_FORMAT}
    if mode == "tolerant":
        return {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_COLUMN,
            "timestampFormat": TIMESTAMP_FORMAT,
        }
    raise ValueError(f"unknown read mode: {mode}")


def read_schema(mode: ReadMode) -> T.StructType:
    return EVENT_SCHEMA if mode == "strict" else TOLERANT_SCHEMA


def csv_events(
    spark: SparkSession, path: str, mode: ReadMode = "strict", multi_line: bool = False
) -> DataFrame:
    """Headed CSV events, split by Spark into tasks by size.

    Texts may hold line breaks with ``multi_line``; each file is then one task's. Without it
    such a record does not fit.
    ``strict`` fails on a record that does not fit, ``tolerant`` keeps it as text in the
    corrupt-record column. The header of every file must name the columns in order.
    """
    return (
        spark.read.schema(read_schema(mode))
        .options(**CSV_OPTIONS, **read_options(mode), multiLine=multi_line)
        .csv(path)
    )


def json_events(spark: SparkSession, path: str, mode: ReadMode = "strict") -> DataFrame:
    """Events as JSON lines; modes as for CSV."""
    return spark.read.schema(read_schema(mode)).options(**read_options(mode)).json(path)


def parquet_events(spark: SparkSession, path: str) -> DataFrame:
    """Events as Parquet, partition columns of the path left out."""
    return spark.read.parquet(path).select(*EVENT_SCHEMA.names)
