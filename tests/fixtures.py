"""The thirteen-row edge fixture: midnight crossings, null and negative amounts, exact
thresholds, an event type that is no stage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clickmetrics.schema import EVENT_SCHEMA


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-{text}")


EDGE_EVENTS = [
    ("u1", "login", 0.0, at("01-01 23:00:00")),
    ("u1", "product_view", 0.0, at("01-02 00:30:00")),
    ("u1", "add_to_cart", 0.0, at("01-02 00:45:00")),
    ("u1", "purchase", 100.0, at("01-02 01:00:00")),
    ("u1", "purchase", 50.5, at("01-03 22:59:59")),
    ("u2", "login", 0.0, at("01-01 10:00:00")),
    ("u2", "product_view", 0.0, at("01-01 10:05:00")),
    ("u3", "login", 0.0, at("01-02 09:00:00")),
    ("u3", "product_view", 0.0, at("01-02 09:01:00")),
    ("u3", "add_to_cart", 0.0, at("01-02 09:02:00")),
    ("u4", "purchase", None, at("01-02 09:30:00")),
    ("u5", "refund", -20.0, at("01-03 12:00:00")),
    ("u5", "purchase", 20.0, at("01-03 12:30:00")),
]


def events_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def values(frame: DataFrame) -> list[tuple]:
    return [tuple(row) for row in frame.collect()]


def value_set(frame: DataFrame) -> set[tuple]:
    rows = values(frame)
    assert len(rows) == len(set(rows))
    return set(rows)
