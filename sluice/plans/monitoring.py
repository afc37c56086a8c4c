"""Volume, freshness, size and lag of the landed tables and their topics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import moment, seconds_between
from .common import recent


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def counts_per_hour(df: DataFrame, time: str = "recorded_at") -> DataFrame:
    """Rows per hour, of all hours that have any."""
    return df.groupBy(F.date_trunc("hour", time).cast("timestamp_ntz").alias("hour")).agg(
        F.count(F.lit(1)).alias("message_count")
    )


def hourly_counts(df: DataFrame, time: str = "recorded_at", newest: int = 24) -> DataFrame:
    """Rows per hour, the ``newest`` hours that have any."""
    return counts_per_hour(df, time).orderBy(F.desc("hour")).limit(newest)


def volume_trend(
    df: DataFrame, time: str = "recorded_at", as_of: datetime | None = None
) -> DataFrame:
    """Rows per hour over the last 24 hours, newest first."""
    return (
        recent(df, time, "24 hours", as_of)
        .groupBy(F.date_trunc("hour", time).cast("timestamp_ntz").alias("hour"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("hour"))
    )


def processing_lag(df: DataFrame, time: str = "recorded_at") -> DataFrame:
    """Average and longest time from event to table, in seconds."""
    lag = seconds_between(F.col("ingested_at"), F.col(time))
    return df.agg(F.avg(lag).alias("avg_lag_seconds"), F.max(lag).alias("max_lag_seconds"))


def data_freshness(tables: Mapping[str, DataFrame], as_of: datetime | None = None) -> DataFrame:
    """Newest row of each table and how long before ``as_of``, by default the current time,
    that was; empty tables have no row."""
    newest = _union(
        [
            df.agg(F.max("ingested_at").alias("latest_data")).select(
                F.lit(name).alias("table_name"), "latest_data"
            )
            for name, df in tables.items()
        ]
    ).where(F.col("latest_data").isNotNull())
    now = moment(F.current_timestamp() if as_of is None else as_of)
    return newest.withColumn("lag_seconds", seconds_between(now, F.col("latest_data")))


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def table_counts_long(tables: Mapping[str, DataFrame], schema_name: str = "iot") -> DataFrame:
    """Row count per table, ordered by table."""
    return _union(
        [
            count_rows(df).select(
                F.lit(schema_name).alias("schema_name"), F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    ).orderBy("table_name")


def table_counts_row(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of all tables side by side in one row."""
    counts = _union(
        [count_rows(df).select(F.lit(name).alias("name"), "row_count") for name, df in tables.items()]
    )
    return counts.agg(
        *[F.max(F.when(F.col("name") == name, F.col("row_count"))).alias(name) for name in tables]
    )


def latest_rows(df: DataFrame, key: str, n: int = 3) -> DataFrame:
    """The ``n`` rows that were ingested last."""
    return df.orderBy(F.desc("ingested_at"), F.desc(key)).limit(n)


def max_ingested(df: DataFrame) -> DataFrame:
    return df.agg(F.max("ingested_at").alias("max_ingested_at"))


def table_sizes(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Bytes and files per table, largest first; lists the files without reading them."""
    sizes = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select(F.lit(name).alias("table_name"), "length")
        for name, path in paths.items()
    ]
    return (
        _union(sizes)
        .groupBy("table_name")
        .agg(F.sum("length").alias("total_bytes"), F.count(F.lit(1)).alias("files"))
        .orderBy(F.desc("total_bytes"), "table_name")
    )


def offsets_by_partition(messages: DataFrame) -> DataFrame:
    """First and next offset, and messages between them, per topic partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        (F.max("offset") + 1 - F.min("offset")).alias("message_count"),
    )


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per column, from one pass."""
    measures = {
        "n": F.count,
        # Sums of integers and decimals are exact, so the mean can be repeated.
        "mean": lambda c: F.sum(c).cast("double") / F.count(c),
        "stddev": F.stddev_samp,
        "min": lambda c: F.min(c).cast("double"),
        "max": lambda c: F.max(c).cast("double"),
    }
    wide = df.agg(
        *[measure(F.col(c)).alias(f"{c}_{m}") for c in columns for m, measure in measures.items()]
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}_{m}").alias(m) for m in measures])
            for c in columns
        ]
    )
    return wide.select(F.inline(rows))


def with_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose ``column`` starts with ``prefix``; sources evaluate this themselves."""
    return df.where(F.col(column).startswith(prefix))
