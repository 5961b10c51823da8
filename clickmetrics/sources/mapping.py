"""Read a table of another shape as events."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class EventMapping:
    """Which columns of a source table hold the event fields, and how its types are named.

    Types missing from ``type_names`` keep their name. With ``money_types`` set, events of
    any other type read as amount 0.0.
    """

    user_id: str = "user_id"
    event_type: str = "event_type"
    amount: str = "amount"
    timestamp: str = "timestamp"
    type_names: dict[str, str] = field(default_factory=dict)
    money_types: tuple[str, ...] | None = None

    def source_names(self, types: tuple[str, ...]) -> list[str]:
        """The source's names of ``types``."""
        renamed = [old for old, new in self.type_names.items() if new in types]
        return renamed + [name for name in types if name not in self.type_names]


def map_events(
    source: DataFrame, mapping: EventMapping, only_types: tuple[str, ...] | None = None
) -> DataFrame:
    """Project ``source`` onto the event columns.

    An operator that filters on the renamed type cannot have its filter pushed through the
    renaming. Naming the types it wants in ``only_types`` filters on the source's own names
    instead, which the scan can use.
    """
    if only_types is not None:
        wanted = mapping.source_names(only_types)
        source = source.filter(F.col(mapping.event_type).isin(*wanted))
    source_type = F.col(mapping.event_type)
    amount = F.col(mapping.amount).cast("double")
    if mapping.money_types is not None:
        has_amount = source_type.isin(*mapping.source_names(mapping.money_types))
        amount = F.when(has_amount, amount).otherwise(F.lit(0.0))
    return source.select(
        F.col(mapping.user_id).cast("string").alias("user_id"),
        _renamed(source_type, mapping.type_names).alias("event_type"),
        amount.alias("amount"),
        F.col(mapping.timestamp).cast("timestamp").alias("timestamp"),
    )


def _renamed(source_type: Column, names: dict[str, str]) -> Column:
    renamed = source_type
    for old, new in names.items():
        renamed = F.when(source_type == old, F.lit(new)).otherwise(renamed)
    return renamed
