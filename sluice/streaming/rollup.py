"""Reports kept up to date by a stream, instead of computed from all rows.

The aggregate runs on the stream in update mode: Spark's state holds each group's totals, and
a batch gives the new totals of the groups it touched. These replace the stored ones by key,
so a write is of the batch's groups, and as they are totals and no differences, writing a
batch again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import configure
from ..sinks.parquet import _settings
from ..sinks.upsert import BUCKETS, UpsertTable

# The batch a group's totals are from.
BATCH = "_batch_id"
# A batch meets most groups: write its changes down instead of the store's files, and do not
# look a group up once more to count them.
_STATE = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


class Rollup:
    """A report's groups, one row each, by the ``keys`` the report groups by.

    Reports of counts, sums, smallest and largest values can be kept. The state grows with the
    number of groups. It lies in the checkpoint: a stream that starts with a new one starts
    its totals over, and needs a new folder.
    """

    def __init__(
        self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS
    ) -> None:
        self.keys = list(keys)
        # Totals of a later batch win, and a batch written again meets its own.
        self.table = UpsertTable(spark, path, self.keys, [BATCH], buckets)

    def write(self, totals: DataFrame, batch_id: int) -> None:
        """Put the batch's ``totals``, a row per group, in place of older ones."""
        self.table.write(totals.withColumn(BATCH, F.lit(batch_id).cast("long")), unique=True)

    def read(self) -> DataFrame | None:
        """The report; None before the first batch."""
        rows = self.table.read()
        return None if rows is None else rows.drop(BATCH)


def keep_report(
    report: DataFrame, rollup: Rollup, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Start a stream that keeps ``report``, an aggregate of a stream by the rollup's keys, in it.

    The stream's metrics do not count the rows of its state.
    """
    spark = configure(report.sparkSession)
    writer = (
        report.writeStream.outputMode("update")
        .foreachBatch(rollup.write)
        .option("checkpointLocation", checkpoint)
    )
    # A stream keeps the settings it is started with.
    with _settings(spark, _STATE):
        return (writer if trigger is None else writer.trigger(**trigger)).start()
