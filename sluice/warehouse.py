"""Where the tables, checkpoints and logs of all datasets lie under one folder."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from .sinks.buckets import BucketTable
from .sinks.parquet import AppendTable, Quarantine
from .sinks.stats import StatsLog
from .sinks.upsert import BUCKETS, StateTable
from .specs import DatasetSpec, all_specs
from .streaming.ingest import IngestJob


class Warehouse:
    """The landed tables under ``root``, a folder all executors can reach.

    With ``buckets``, tables that keep the first row of a key are bucketed by it, which
    suits keys looked up in very large tables; else they are cut by date, and ``settings``
    go to them (``probe_days``, ``grain``, ``null_key``). Tables that keep the latest row are
    in buckets either way.
    """

    def __init__(
        self, spark: SparkSession, root: str, buckets: int | None = None, **settings
    ) -> None:
        if buckets and settings:
            raise ValueError(f"not for bucketed tables: {sorted(settings)}")
        self.spark, self.root = spark, root.rstrip("/")
        self.buckets, self.settings = buckets, settings

    def table(self, spec: DatasetSpec) -> AppendTable | BucketTable | StateTable:
        path = f"{self.root}/tables/{spec.table}"
        if spec.policy == "update":
            return StateTable(self.spark, path, spec, buckets=self.buckets or BUCKETS)
        if self.buckets:
            return BucketTable(self.spark, path, spec, self.buckets)
        return AppendTable(self.spark, path, spec, **self.settings)

    def quarantine(self, spec: DatasetSpec) -> Quarantine:
        return Quarantine(f"{self.root}/quarantine/{spec.name}")

    def stats(self, spec: DatasetSpec) -> StatsLog:
        return StatsLog(f"{self.root}/ingest_stats/{spec.name}")

    def checkpoint(self, spec: DatasetSpec) -> str:
        return f"{self.root}/checkpoints/{spec.name}"

    def job(self, spec: DatasetSpec, messages: DataFrame, **settings) -> IngestJob:
        """The stream that lands ``messages`` here."""
        return IngestJob(
            spec,
            messages,
            self.table(spec),
            self.checkpoint(spec),
            self.quarantine(spec),
            self.stats(spec),
            **settings,
        )

    def tables(self, specs: Iterable[DatasetSpec] | None = None) -> dict[str, DataFrame]:
        """All tables that have been written, by table name."""
        found = {spec.table: self.table(spec).read() for spec in specs or all_specs()}
        return {name: rows for name, rows in found.items() if rows is not None}

    def create_views(self) -> list[str]:
        """Make the tables available to ``spark.sql`` under their names."""
        tables = self.tables()
        for name, rows in tables.items():
            rows.createOrReplaceTempView(name)
        return sorted(tables)
