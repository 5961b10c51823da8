"""Schemas of the event log and of the metric tables built from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

EVENT_COLUMNS = ("user_id", "event_type", "amount", "timestamp")

#: Columns a stored event must have a value for; ``amount`` may be null.
REQUIRED_COLUMNS = ("user_id", "event_type", "timestamp")

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

#: Column that text parsers put a record into when it does not fit the schema.
CORRUPT_COLUMN = "_corrupt_record"

#: Partition columns of the stored events table: the day, for pruning, and the load that
#: wrote the rows, so that a repeated load replaces its own rows and nothing else.
DAY_COLUMN = "event_date"
LOAD_COLUMN = "load_id"

#: Table of the rollup that runs keep, partitioned like the events.
STORED_ROLLUP = "event_rollup"

#: Tables that hold what all stored events come to by user, see ``plans.user_state``: by user and
#: type, by user, by hour, and the partitions that are in them, whose newest version is the valid one.
STATE_TABLES = ("state_activity", "state_users", "state_hours")
STATE_PARTS = "state_parts"

#: Table property with the time zone in which the days of stored events were cut.
DAY_ZONE_PROPERTY = "clickmetrics.day_zone"

METRIC_SCHEMAS = {
    "ltv_metrics": "user_id string, total_ltv double, event_count bigint",
    "ltv_detail": (
        "user_id string, first_order_date timestamp, last_order_date timestamp, "
        "total_orders bigint, total_ltv double, avg_order_value double, "
        "customer_lifespan_days bigint"
    ),
    "retention_metrics": "total_users bigint, retained_users bigint, retention_rate double",
    "user_daily_activity": (
        "user_id string, active_days bigint, first_active timestamp, last_active timestamp"
    ),
    "cohort_metrics": "cohort_day string, user_count bigint",
    "funnel_metrics": "stage string, user_count bigint",
    "funnel_volume": "stage string, total_events bigint, unique_users bigint",
    "revenue_trend": "revenue_hour timestamp, purchase_count bigint, total_revenue double",
    "churn_metrics": "user_id string, event_count bigint, purchase_count bigint, is_at_risk int",
    "user_segments": (
        "user_id string, frequency bigint, monetary double, segment_id int, segment_label string"
    ),
}


class EventSchemaError(ValueError):
    """The frame or table does not hold events of the expected shape."""


def require_event_columns(frame: DataFrame) -> DataFrame:
    """Return ``frame`` cut down to the event columns, or fail if they differ in type."""
    found = {field.name: field.dataType for field in frame.schema}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, "
        f"found {found[field.name].simpleString() if field.name in found else 'no column'}"
        for field in EVENT_SCHEMA
        if found.get(field.name) != field.dataType
    ]
    if problems:
        raise EventSchemaError("not an event frame; " + "; ".join(problems))
    return frame.select(*EVENT_COLUMNS)
