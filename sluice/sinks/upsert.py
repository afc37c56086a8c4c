"""Update-latest tables that rewrite only what a batch touches.

The folder is partitioned by a hash of the key. A write finds the buckets of its keys, reads
those and no others, and replaces them by Spark's dynamic partition overwrite; the files of
all other buckets stay as they are. So a write costs the batch plus the buckets it meets:
few for few keys, all of them for a batch with very many random keys. Pick the number of
buckets so that one is a few hundred MB in the table's expected size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import latest_per_key, require_key
from ..specs import DatasetSpec
from .parquet import POSITION, _files, _read, kept

BUCKET = "key_bucket"
BUCKETS = 64
# Rows on their way into the table. Spark's readers pass over names that start like this.
REDO = "_redo"


class UpsertTable:
    """One row per key, the latest by ``order`` and then by all other columns.

    ``keys`` may be several columns, of which some may be null. An older row never replaces
    a newer one, unless ``guard`` is off: then a batch's row replaces the stored one. The
    same batch written again changes nothing.

    The new content of the touched buckets is first written beside the table, and removed
    once it has been put in place. A writer that dies in between leaves it there, and the
    next one puts it in place before anything else, so no row is lost however far the
    overwrite came. There is one writer. A reader that has listed files which are replaced
    meanwhile fails, and can start over. ``buckets`` must stay the same for the life of
    the folder.
    """

    # A write goes through its batch once, and through all of it in its first job.
    one_pass = True

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        order: Sequence[str],
        buckets: int = BUCKETS,
        guard: bool = True,
    ) -> None:
        self.spark, self.path = spark, path
        self.keys, self.order = list(keys), list(order)
        self.buckets, self.guard = buckets, guard

    def read(self) -> DataFrame | None:
        """One row per key, or None before the first write."""
        stored = _read(self.spark, self.path)
        return None if stored is None else stored.drop(BUCKET)

    def write(self, batch: DataFrame, unique: bool = False) -> None:
        """Put the latest row of each key of ``batch`` in place of older ones.

        Callers whose batch has a row per key at most say ``unique=True``, which saves
        sorting it.
        """
        self._finish_interrupted()
        latest = batch if unique else latest_per_key(batch, self.keys, self.order, nullable=False)
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        latest = latest.withColumn(BUCKET, bucket)
        if _read(self.spark, self.path) is None:
            # Nothing to merge with, so no buckets to look up and no row to hold for that.
            self._replace(latest, [])
            return
        with kept(latest) as rows:
            touched = [row[0] for row in rows.select(BUCKET).distinct().collect()]
            if touched:
                self._replace(rows, touched)

    def _replace(self, rows: DataFrame, touched: list[int]) -> None:
        self.merged(rows, touched).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.path}/{REDO}"
        )
        self._put_in_place()

    def merged(self, rows: DataFrame, touched: list[int]) -> DataFrame:
        """The new content of the ``touched`` buckets, spread by bucket."""
        stored = _read(self.spark, self.path)
        if stored is None:
            return rows.repartition(BUCKET)
        met = stored.where(F.col(BUCKET).isin(touched))
        order = self.order
        if not self.guard:
            rows, met = rows.withColumn("_comes", F.lit(1)), met.withColumn("_comes", F.lit(0))
            order = ["_comes", *order]
        # Spread once: rows of a key are in one bucket, and each side has one per key.
        both = rows.unionByName(met, allowMissingColumns=True).repartition(BUCKET)
        return latest_per_key(both, [BUCKET, *self.keys], order, nullable=False).drop("_comes")

    def _put_in_place(self) -> None:
        redo = f"{self.path}/{REDO}"
        rows = _read(self.spark, redo)
        if rows is not None:  # a first batch without rows leaves nothing to put in place
            rows.write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy(BUCKET).parquet(self.path)
        hadoop, files = _files(self.spark, redo)
        files.delete(hadoop.Path(redo), True)

    def _finish_interrupted(self) -> None:
        hadoop, files = _files(self.spark, self.path)
        if files.exists(hadoop.Path(f"{self.path}/{REDO}/_SUCCESS")):
            self._put_in_place()


class StateTable(UpsertTable):
    """The latest row per key of a dataset, by event time and then message position.

    Rows without a key fail the write.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: DatasetSpec,
        guard: bool = True,
        buckets: int = BUCKETS,
    ) -> None:
        super().__init__(spark, path, [spec.key], [spec.event_time, *POSITION], buckets, guard)
        self.spec = spec

    def read(self) -> DataFrame | None:
        rows = super().read()
        return None if rows is None else rows.drop(*POSITION)

    def write(self, batch: DataFrame) -> None:
        rows = require_key(batch, self.spec.key)
        for name, type_ in zip(POSITION, ("long", "int")):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast(type_))
        super().write(rows)
