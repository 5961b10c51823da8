"""Where events and metrics are written."""

from clickmetrics.sinks.events import (
    ClosedLoadError,
    compact_events,
    create_events_table,
    load_events,
)
from clickmetrics.sinks.files import append_csv, append_messages
from clickmetrics.sinks.metrics import save_metric

__all__ = [
    "ClosedLoadError",
    "append_csv",
    "append_messages",
    "compact_events",
    "create_events_table",
    "load_events",
    "save_metric",
]
