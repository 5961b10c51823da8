"""Where events come from: files, tables, message text, and tables of another shape."""

from clickmetrics.sources.files import csv_events, json_events, parquet_events
from clickmetrics.sources.mapping import EventMapping, map_events
from clickmetrics.sources.messages import encode_messages, parse_messages, split_parsed
from clickmetrics.sources.tables import events_between, events_table, metric_table, use_events

__all__ = [
    "EventMapping",
    "csv_events",
    "encode_messages",
    "events_between",
    "events_table",
    "json_events",
    "map_events",
    "metric_table",
    "parquet_events",
    "parse_messages",
    "split_parsed",
    "use_events",
]
