"""Late rows of a stream, kept where they can be found again."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import configure
from ..sinks.parquet import _read
from .windows import DELAY

# Microseconds from 1970 back to the year 10.
_FIRST_YEAR = -61851600000000000


class LateRows:
    """The rows that come in at or behind the watermark, in one folder per batch.

    The watermark of a batch is the newest event time of all earlier batches less ``delay``,
    as it is for windows, running totals and de-duplication on the same stream, which drop
    exactly these rows. The newest time is stored beside the rows for each batch, so a batch
    that is repeated meets the watermark it had, and replaces its own rows.

    A batch is gone through once: what is written and the newest time come from one pass.
    """

    def __init__(self, path: str, time: str, delay: str = DELAY) -> None:
        self.path, self.time, self.delay = path, time, delay

    def write(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = self._newest_before(spark, batch_id)
        # No row of the first batch is late: none is that old.
        after = _FIRST_YEAR if newest is None else newest
        seen = Observation()
        at = F.col(self.time).cast("timestamp")
        rows = batch.observe(seen, F.max(F.unix_micros(at)).alias("newest"))
        passed = F.timestamp_micros(F.lit(after)) - F.expr(f"INTERVAL {self.delay}")
        rows.where(at <= passed).write.mode("overwrite").parquet(
            f"{self.path}/rows/batch_id={batch_id}"
        )
        times = [t for t in (newest, seen.get["newest"]) if t is not None]
        spark.createDataFrame([(max(times, default=None),)], "newest long").coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.path}/newest/batch_id={batch_id}")

    def _newest_before(self, spark: SparkSession, batch_id: int) -> int | None:
        """The newest event time before a batch, in microseconds; None if there is none."""
        if batch_id == 0:
            return None
        return spark.read.parquet(f"{self.path}/newest/batch_id={batch_id - 1}").first()["newest"]

    def read(self, spark: SparkSession) -> DataFrame | None:
        """All late rows, with the batch they came in; None before the first batch."""
        return _read(spark, f"{self.path}/rows")


def keep_late(
    rows: DataFrame, late: LateRows, checkpoint: str, trigger: dict[str, Any] | None = None
) -> StreamingQuery:
    """Start a stream that keeps the late rows of ``rows``."""
    configure(rows.sparkSession)
    writer = rows.writeStream.foreachBatch(late.write).option("checkpointLocation", checkpoint)
    return (writer if trigger is None else writer.trigger(**trigger)).start()
