from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the textual form of an identifier.
UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"


def epoch_ms_to_timestamp(ms: Column) -> Column:
    """Epoch milliseconds as a timestamp, exact to the millisecond."""
    return F.timestamp_millis(ms)


def is_uuid(text: Column) -> Column:
    return text.rlike(UUID_PATTERN)


def item_count(items: Column) -> Column:
    """Number of items, -1 for a missing list (independent of the ANSI setting)."""
    return F.coalesce(F.size(items), F.lit(-1))


def items_total(items: Column) -> Column:
    """Sum of quantity times price over an order's items, rounded to cents."""
    total = F.aggregate(
        items, F.lit(0.0), lambda acc, item: acc + item["quantity"] * item["price"]
    )
    return F.round(total, 2)


def location_text(latitude: Column, longitude: Column) -> Column:
    """A point as ``"lat,lon"``; a missing coordinate is left out, as the text join does."""
    return F.concat_ws(",", latitude, longitude)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds with microsecond precision, not the seconds field of the gap."""
    return (_micros(later) - _micros(earlier)) / F.lit(1e6)


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def topic_matches(topic: Column, topic_filter: str) -> Column:
    """Whether ``topic`` matches a filter in which ``+`` stands for exactly one level, empty or not."""
    if "#" in topic_filter:
        raise ValueError(f"only the one-level wildcard + is supported: {topic_filter!r}")
    levels = topic_filter.split("/")
    if any("+" in level and level != "+" for level in levels):
        raise ValueError(f"+ must fill a whole level: {topic_filter!r}")
    if "+" not in levels:
        return topic == F.lit(topic_filter)
    pattern = "/".join("[^/]*" if level == "+" else re.escape(level) for level in levels)
    return topic.rlike(rf"^{pattern}\z")


def moment(value: datetime | Column) -> Column:
    """A point in time without a zone (UTC), whatever zone the driver runs in."""
    if isinstance(value, datetime):
        value = F.lit(value.isoformat(sep=" "))
    return value.cast("timestamp_ntz")
