"""Column expressions shared by the operators; all run inside the JVM."""

from .expressions import (
    epoch_ms_to_timestamp,
    is_uuid,
    item_count,
    items_total,
    location_text,
    moment,
    seconds_between,
    topic_matches,
)

__all__ = [
    "epoch_ms_to_timestamp",
    "is_uuid",
    "item_count",
    "items_total",
    "location_text",
    "moment",
    "seconds_between",
    "topic_matches",
]
