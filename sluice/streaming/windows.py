"""The reports that need event time on a stream. Messages older than the delay are late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.reports import events_tumbling

# Fixed value: how late a message may be.
DELAY = "24 hours"


def watermarked(df: DataFrame, time: str, delay: str) -> DataFrame:
    """``df`` with a watermark on ``time``."""
    # Event time without a zone means UTC; watermarks need a zoned timestamp.
    return df.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def windowed_counts(events: DataFrame, width: str = "1 hour", delay: str = DELAY) -> DataFrame:
    """User events per type and window; in append mode a window appears once it is closed."""
    return events_tumbling(watermarked(events, "event_timestamp", delay), width)


def dedup_stream(rows: DataFrame, key: str, time: str, delay: str = DELAY) -> DataFrame:
    """Drop repeated keys that arrive within ``delay`` of the first.

    This only saves work: it forgets keys once the watermark has passed them, so the
    table's own key check stays in charge. Rows without a key all stay.
    """
    own = F.when(F.col(key).isNull(), F.expr("uuid()"))
    marked = watermarked(rows, time, delay).withColumn("_own", own)
    kept = marked.dropDuplicatesWithinWatermark([key, "_own"]).drop("_own")
    return kept.withColumn(time, F.col(time).cast("timestamp_ntz"))
