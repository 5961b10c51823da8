"""Streaming ingestion with Structured Streaming."""

from clickmetrics.streaming.ingest import (
    compact_quarantine,
    file_messages,
    ingest_messages,
    kafka_messages,
    quarantined,
)
from clickmetrics.streaming.staging import load_staged_csv

__all__ = [
    "compact_quarantine",
    "file_messages",
    "ingest_messages",
    "kafka_messages",
    "load_staged_csv",
    "quarantined",
]
