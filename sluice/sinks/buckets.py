"""A keyed table in buckets by key, for inserts into tables of any size.

Spark's own bucketed tables do the work: the folder is declared as one in the session's
catalog, rows are added with ``insertInto``, and the look-up of a batch's keys is a join
that finds the table already spread and needs to shuffle the batch alone.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import first_per_key, require_key
from ..specs import DatasetSpec
from .parquet import POSITION, _read

# Buckets of a new table. Pick it for the size expected: a bucket is read by one task.
BUCKETS = 64


class BucketTable:
    """Insert-if-absent: the first row of a key stays, whenever a copy comes back.

    Unlike ``AppendTable`` without ``probe_days``, an insert moves the batch only: its
    rows go to the task that reads the key column of their bucket. The table is not cut
    by date; reports on a span of time skip row groups by their statistics.

    A write adds at most one file per bucket. There is one writer and any number of
    readers. Rows without a key fail the write. ``buckets`` must stay the same for the life
    of the folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, spec: DatasetSpec, buckets: int = BUCKETS
    ) -> None:
        self.spark, self.path, self.spec, self.buckets = spark, path, spec, buckets

    def read(self) -> DataFrame | None:
        """The table, or None before the first write."""
        stored = _read(self.spark, self.path)
        return None if stored is None else self.spark.table(self._declare(stored))

    def write(self, batch: DataFrame) -> None:
        """Add the first row of each key the table does not hold yet."""
        key = self.spec.key
        position = [name for name in POSITION if name in batch.columns]
        order = [self.spec.event_time, *position]
        rows = first_per_key(require_key(batch, key), key, order, nullable=False).drop(*position)
        new = self.absent(rows)
        stored = _read(self.spark, self.path)
        name = self._declare(new if stored is None else stored)
        new.select(*self.spark.table(name).columns).write.insertInto(name)

    def absent(self, rows: DataFrame) -> DataFrame:
        """The rows, one per key, whose key the table does not hold, spread like its buckets."""
        key, table = self.spec.key, self.read()
        rows = rows.repartition(self.buckets, key)
        if table is None:
            return rows
        # A merge join leaves the rows where the buckets are, whatever the sizes. An anti
        # join would be moved before the reduction to one row per key.
        present = table.select(F.col(key).alias("_present")).hint("merge")
        joined = rows.join(present, F.col(key) == F.col("_present"), "left")
        return joined.where(F.col("_present").isNull()).drop("_present")

    def _declare(self, like: DataFrame) -> str:
        """The folder as a bucketed table of the session's catalog; gives its name."""
        name = "sluice_" + hashlib.md5(f"{self.path} {self.buckets}".encode()).hexdigest()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        key, place = f"`{self.spec.key}`", self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
            f" CLUSTERED BY ({key}) SORTED BY ({key}) INTO {self.buckets} BUCKETS"
            f" LOCATION '{place}'"
        )
        self.spark.catalog.refreshTable(name)
        return name
