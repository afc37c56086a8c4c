from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

_SCHEMA = "metric_name string, metric_value long, recorded_at timestamp_ntz"


class StatsLog:
    """Counts per batch: rows of (name, value, time), one folder per query and batch."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(
        self,
        spark: SparkSession,
        metrics: Mapping[str, int],
        recorded_at: datetime,
        query_id: str,
        batch_id: int,
    ) -> None:
        rows = [(name, int(value), recorded_at) for name, value in metrics.items()]
        spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.path}/query_id={query_id}/batch_id={batch_id}"
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path)
