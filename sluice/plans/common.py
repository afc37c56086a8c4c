from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import moment


def now_of(df: DataFrame, time: str, as_of: datetime | Column | None) -> Column:
    """``as_of``, or the newest ``time`` in ``df`` as a scalar subquery (no join)."""
    if as_of is None:
        return df.agg(F.max(time)).scalar()
    return moment(as_of)


def recent(df: DataFrame, time: str, interval: str, as_of: datetime | Column | None) -> DataFrame:
    """Rows whose ``time`` is later than ``as_of`` minus ``interval``.

    A table that is partitioned by ``event_date`` is only read from the start on: the
    partition is the day of ``time``, or the first day of its month or year.
    """
    start = now_of(df, time, as_of) - F.expr(f"INTERVAL {interval}")
    if "event_date" in df.columns:
        date, first = F.col("event_date"), start.cast("date")
        df = df.where(
            (date >= first) | (date == F.trunc(first, "month")) | (date == F.trunc(first, "year"))
        )
    return df.where(F.col(time) > start)
