"""Append tables, rejected messages and exports as plain Parquet folders.

An ``AppendTable`` has one writer (a stream or a batch job) and any number of readers, and is
the same table when a batch is written again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import first_per_key, require_key
from ..specs import DatasetSpec

DATE = "event_date"
POSITION = ("source_offset", "source_partition")
# The folder Spark writes rows without a date to.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
# Keys of one batch are broadcast to the scan of the table up to this many bytes, each
# key counted with this much beside its text.
BROADCAST_BYTES = 32 << 20
ROW_BYTES = 40
# Bits per key of the Bloom filter for larger batches (2 % of other keys pass), and the size
# it never exceeds (64 MB, good for 67 million keys; beyond that more keys pass).
FILTER_BITS, MOST_FILTER_BITS = 8, 1 << 29
# Up to this many date folders are opened one by one; for more the table is listed.
LISTED_DATES = 366


@contextmanager
def kept(df: DataFrame):
    """``df`` cached while it is used more than once; lost parts are recomputed."""
    cached = df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


@contextmanager
def _settings(spark: SparkSession, values: dict[str, object]):
    """The session with these settings for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _bloom_filter(keys: int) -> dict[str, object]:
    """Settings under which Spark filters a scan by the keys it is joined with by shuffling."""
    bits = min(max(keys, 1) * FILTER_BITS, MOST_FILTER_BITS)
    runtime = {
        "enabled": "true",
        "applicationSideScanSizeThreshold": 0,
        "creationSideThreshold": 1 << 40,  # the filter is small, however many keys make it
        "expectedNumItems": keys,
        "maxNumItems": keys,
        "numBits": bits,
        "maxNumBits": bits,
    }
    return {
        # The keys were measured: they are not to be broadcast on an estimate.
        "spark.sql.autoBroadcastJoinThreshold": -1,
        **{f"spark.sql.optimizer.runtime.bloomFilter.{name}": v for name, v in runtime.items()},
    }


def _read(spark: SparkSession, path: str, **options) -> DataFrame | None:
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        # Nothing written yet, or only batches without rows.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _files(spark: SparkSession, path: str):
    """Hadoop's file classes and the file system ``path`` is on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    return hadoop, hadoop.Path(path).getFileSystem(configuration)


class AppendTable:
    """Insert-if-absent: the first row of a key stays, later ones are ignored.

    The folder is partitioned by event date, cut to its ``grain`` (``"day"``, ``"month"``
    or ``"year"``; coarser for little data over a long time).

    Before an insert, the batch's keys are looked up in the table. By default the key
    column of all dates is read, which finds every earlier copy but grows with the
    table. ``probe_days=n`` is inexact: it misses a key that comes back with a time
    more than ``n`` days off, and stores it twice. It reads only the dates of the batch
    and ``n`` days around them, and rows without a time if the batch has any: 0 finds
    all redelivered messages, since a copy carries the same event time.

    The keys of a batch are sent to that scan, up to ``broadcast_bytes`` of them. A larger
    batch is joined by shuffling, and its keys go to the scan as a Bloom filter of bounded
    size, so that of the table only the keys that may be in the batch are shuffled.

    ``null_key`` says what to do with rows without a key: ``"reject"`` fails the
    write, ``"append"`` adds them each time, as a nullable unique column would.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: DatasetSpec,
        probe_days: int | None = None,
        null_key: str = "reject",
        grain: str = "day",
        broadcast_bytes: int = BROADCAST_BYTES,
    ) -> None:
        if probe_days is not None and probe_days < 0:
            raise ValueError("probe_days must not be negative")
        if null_key not in ("reject", "append"):
            raise ValueError(f"unknown null_key {null_key!r}")
        if grain not in ("day", "month", "year"):
            raise ValueError(f"unknown grain {grain!r}")
        self.spark, self.path, self.spec = spark, path, spec
        self.probe_days, self.null_key = probe_days, null_key
        self.grain, self.broadcast_bytes = grain, broadcast_bytes
        self._date = F.date_trunc(grain, spec.event_time).cast("date")

    def read(self) -> DataFrame | None:
        """The table, or None before the first write."""
        rows = _read(self.spark, self.path)
        return None if rows is None else rows.withColumn(DATE, F.col(DATE).cast("date"))

    def write(self, batch: DataFrame) -> None:
        """Add the first row of each key the table does not hold yet."""
        key = self.spec.key
        position = [name for name in POSITION if name in batch.columns]
        order = [self.spec.event_time, *position]
        if self.null_key == "append":
            without = batch.where(F.col(key).isNull())
            batch = batch.where(F.col(key).isNotNull())
        else:
            batch = require_key(batch, key)
        rows = first_per_key(batch, key, order, nullable=False).withColumn(DATE, self._date)
        with kept(rows) as rows, self._looking_up(rows) as new:
            if self.null_key == "append":
                new = new.unionByName(without.withColumn(DATE, self._date))
            # Rebalancing gathers each date into few files and splits a large date.
            new.drop(*position).hint("rebalance", F.col(DATE)).write.mode("append").partitionBy(
                DATE
            ).parquet(self.path)

    @contextmanager
    def _looking_up(self, rows: DataFrame):
        """The rows whose key the table does not hold, to be used inside the block."""
        key = self.spec.key
        present = self._keys_near(rows)
        length = F.octet_length(F.col(key).cast("string")) + ROW_BYTES
        size, n, least, most = rows.agg(
            F.sum(length), F.count(key), F.min(key), F.max(key)
        ).first()
        if present is None or not n:
            yield rows
        elif size <= self.broadcast_bytes:
            # Few keys: send them to the table's scan instead of shuffling the table.
            present = present.join(F.broadcast(rows.select(key)), key, "left_semi")
            yield rows.join(present, key, "left_anti")
        else:
            # All keys lie between their bounds. The bounds skip row groups where keys ascend,
            # and being a filter they make Spark build a Bloom filter for the other side.
            keys = rows.select(key).where(F.col(key).between(least, most))
            present = present.join(keys, key, "left_semi")
            with _settings(rows.sparkSession, _bloom_filter(n)):
                yield rows.join(present, key, "left_anti")

    def _keys_near(self, rows: DataFrame) -> DataFrame | None:
        """The table's keys, as far as they are looked up, or None if there are none."""
        key = self.spec.key
        dates = None if self.probe_days is None else self._probed_dates(rows)
        if dates is None or len(dates) > LISTED_DATES:
            table = self.read()
            if table is None:
                return None
            if dates is not None:
                near = F.col(DATE).isin([date for date in dates if date is not None])
                table = table.where(near | F.col(DATE).isNull() if None in dates else near)
            return table.select(key)
        # Going to the folders themselves saves listing all others.
        folders = [f"{self.path}/{DATE}={date or NO_DATE}" for date in dates]
        hadoop, files = _files(self.spark, self.path)
        folders = [folder for folder in folders if files.exists(hadoop.Path(folder))]
        if not folders:
            return None
        schema = rows.select(key).schema
        return self.spark.read.schema(schema).parquet(*folders).select(key)

    def _probed_dates(self, rows: DataFrame) -> list:
        """The partitions to look up: at most one per calendar day the batch covers, and
        None for rows without a time."""
        day = F.col("_day")
        nearby = F.sequence(F.date_sub(day, self.probe_days), F.date_add(day, self.probe_days))
        dates = (
            rows.select(F.to_date(self.spec.event_time).alias("_day"))
            .distinct()
            .select(F.explode_outer(nearby).alias("_day"))
            .select(F.date_trunc(self.grain, day).cast("date"))
            .distinct()
        )
        return [row[0] for row in dates.collect()]


class Quarantine:
    """Rejected messages with the rules they break, in one folder per query and batch.

    A batch that is written again replaces its own folder.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, rejected: DataFrame, query_id: str, batch_id: int) -> None:
        rejected.write.mode("overwrite").parquet(
            f"{self.path}/query_id={query_id}/batch_id={batch_id}"
        )

    def read(self, spark: SparkSession) -> DataFrame | None:
        return _read(spark, self.path)


def export_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """Write a copy of each table, with its column types, under ``path``."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def restore_tables(spark: SparkSession, path: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """The tables written by ``export_tables``."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
