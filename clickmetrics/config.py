"""Settings of an analytics run, passed explicitly to whatever needs them."""

from __future__ import annotations

from dataclasses import dataclass

# The funnel stages in lifecycle order, the event type that carries money,
# the text format that event times are read in, fractions of a second optional, the segment names
# from the lowest mean spend up, and the thresholds of the two per-user rules.
FUNNEL_STAGES = ("login", "product_view", "add_to_cart", "purchase")
PURCHASE = "purchase"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
SEGMENT_LABELS = ("Low Value", "Medium Value", "High Value")
RETAINED_ABOVE_EVENTS = 3
AT_RISK_MAX_EVENTS = 2


@dataclass(frozen=True)
class AnalyticsConfig:
    """Tunable parameters; the defaults give the standard metric definitions."""

    funnel_stages: tuple[str, ...] = FUNNEL_STAGES
    retained_above_events: int = RETAINED_ABOVE_EVENTS
    at_risk_max_events: int = AT_RISK_MAX_EVENTS

    # Decimals that reported money sums are rounded to, so that a double sum does not
    # depend on the order of rows and partitions. None reports the plain sum.
    money_digits: int | None = None

    # Text format of event times in CSV and messages; None writes them as Spark shows them,
    # with fractions of a second where there are any, which TIMESTAMP_FORMAT reads.
    timestamp_format: str | None = None

    segment_count: int = 3
    segment_labels: tuple[str, ...] = SEGMENT_LABELS
    segment_seed: int = 42
    segment_starts: int = 10
    segment_max_iterations: int = 300

    top_customers: int = 5

    # Stream micro-batch interval.
    flush_interval: str = "20 seconds"

    # Buckets of a run's per-user rollup: None takes one per so many rows of the stored rollup
    # at least, and more to use all cores, see ``plans.rollup.buckets_for``.
    rollup_buckets: int | None = None
    rollup_bucket_rows: int = 5_000_000

    # Metrics of a run that are computed side by side.
    metric_parallelism: int = 4

    database: str = "default"
    events_table: str = "events"

    def table(self, name: str) -> str:
        """Name of a table inside the configured database."""
        return f"{self.database}.{name}"
