"""How far streams have come, from their progress reports and their checkpoints."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sinks.parquet import _read

_PROGRESS = """query string, query_id string, batch_id long, input_rows long,
    input_rows_per_second double, processed_rows_per_second double, duration_ms long"""
_LOGGED = f"""run_id string, {_PROGRESS}, recorded_at timestamp, dropped_late long,
    counts map<string, long>"""
_LAG = """query string, topic string, partition int, end_offset long, latest_offset long,
    lag long"""


def _reports(queries: Iterable[StreamingQuery]):
    """(query, report) for every query that has finished a batch."""
    for query in queries:
        if query.lastProgress is not None:
            yield query, json.loads(query.lastProgress.json)


def progress(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """The latest batch of each query: number, rows, speed and duration."""
    rows = [_progress_row(query.name, report) for query, report in _reports(queries)]
    return spark.createDataFrame(rows, _PROGRESS)


def _progress_row(name: str | None, report: Mapping) -> tuple:
    return (
        name,
        report["id"],
        report["batchId"],
        report["numInputRows"],
        report.get("inputRowsPerSecond"),
        report.get("processedRowsPerSecond"),
        report["durationMs"].get("triggerExecution"),
    )


def source_lag(spark: SparkSession, queries: Iterable[StreamingQuery]) -> DataFrame:
    """Messages not yet read, per query and topic partition, for Kafka sources."""
    rows = [
        row
        for query, report in _reports(queries)
        for source in report["sources"]
        for row in partition_lags(query.name, source)
    ]
    return spark.createDataFrame(rows, _LAG)


def partition_lags(name: str, source: Mapping) -> list[tuple]:
    """Rows of :func:`source_lag` for one source of a progress report."""
    ends, latest = source.get("endOffset"), source.get("latestOffset")
    if not isinstance(ends, Mapping) or not isinstance(latest, Mapping):
        return []
    rows = []
    for topic, partitions in latest.items():
        if not isinstance(partitions, Mapping):
            continue
        for partition, newest in partitions.items():
            end = ends.get(topic, {}).get(partition, 0)
            rows.append((name, topic, int(partition), end, newest, newest - end))
    return rows


class ProgressLog(StreamingQueryListener):
    """Rows about every finished batch of a session's streams, not only the latest one.

    Add it with ``spark.streams.addListener`` before streams start. Each batch gives a row of
    progress: speed, duration, rows dropped behind the watermark, and the counts the stream
    observes, which come from the batch's own pass over its rows. Kafka sources also give a
    row of lag per topic partition. Rows are gathered and appended, by the date of the batch,
    every ``every`` batches and when a stream ends; call ``close`` at the end, which waits for
    reports on their way. A stream that dies with the driver loses the rows not yet appended,
    and a batch that is repeated reports again, under another ``run_id``.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100) -> None:
        self.spark, self.path, self.every = spark, path, every
        self._progress: list[tuple] = []
        self._lag: list[tuple] = []
        self._running: set[str] = set()
        self._change = threading.Condition(threading.RLock())

    def onQueryStarted(self, event) -> None:
        with self._change:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        self.record(json.loads(event.progress.json))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._change:
            self._running.discard(str(event.runId))
            self.flush()
            self._change.notify_all()

    def record(self, report: Mapping) -> None:
        """Take one progress report."""
        at = report["timestamp"]
        operators = report.get("stateOperators", [])
        observed = report.get("observedMetrics", {}).values()
        counts = {name: int(n) for row in observed for name, n in row.items() if n is not None}
        row = (
            report["runId"],
            *_progress_row(report["name"], report),
            at,
            sum(o.get("numRowsDroppedByWatermark", 0) for o in operators),
            counts,
        )
        lags = [lag for source in report["sources"] for lag in partition_lags(report["name"], source)]
        with self._change:
            self._progress.append(row)
            self._lag += [(*lag, report["batchId"], at) for lag in lags]
            if len(self._progress) >= self.every:
                self.flush()

    def flush(self) -> None:
        """Append the rows gathered so far."""
        with self._change:
            progress_rows, self._progress = self._progress, []
            lag_rows, self._lag = self._lag, []
        as_text = _LOGGED.replace("recorded_at timestamp", "recorded_at string")
        self._append("progress", progress_rows, as_text)
        self._append("lag", lag_rows, f"{_LAG}, batch_id long, recorded_at string")

    def _append(self, name: str, rows: list[tuple], schema: str) -> None:
        if rows:
            timed = self.spark.createDataFrame(rows, schema).withColumn(
                "recorded_at", F.to_timestamp("recorded_at")
            )
            timed.withColumn("date", F.to_date("recorded_at")).coalesce(1).write.mode(
                "append"
            ).partitionBy("date").parquet(f"{self.path}/{name}")

    def close(self, seconds: float = 30) -> None:
        """Wait until the ends of all started streams are reported, then append the rest."""
        with self._change:
            self._change.wait_for(lambda: not self._running, seconds)
        self.flush()

    def progress(self) -> DataFrame | None:
        """All logged batches; None before the first is appended."""
        return _read(self.spark, f"{self.path}/progress")

    def lag(self) -> DataFrame | None:
        """Messages not yet read after each batch, per query and topic partition."""
        return _read(self.spark, f"{self.path}/lag")


def checkpointed_batches(spark: SparkSession, checkpoints: Mapping[str, str]) -> DataFrame:
    """The newest batch recorded in each job's checkpoint, whether or not it is running."""
    frames = [
        spark.read.format("binaryFile")
        .load(f"{path}/offsets")
        .select(
            F.lit(job).alias("job"),
            F.regexp_extract("path", r"/(\d+)$", 1).try_cast("long").alias("batch_id"),
        )
        for job, path in checkpoints.items()
    ]
    listed = frames[0]
    for frame in frames[1:]:
        listed = listed.unionByName(frame)
    return listed.groupBy("job").agg(F.max("batch_id").alias("latest_batch"))


def open_groups(spark: SparkSession, checkpoint: str, operator: int = 0) -> DataFrame:
    """What a stream's aggregate holds and has not given out, one row per group.

    Reads the state a checkpoint was last committed with, whether or not its stream is
    running. ``operator`` counts the stateful operators of the stream.
    """
    state = spark.read.format("statestore").option("operatorId", operator).load(checkpoint)
    return state.select("key.*", "value.*")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows of ``windowed_counts`` that the watermark has not closed yet."""
    return open_groups(spark, checkpoint).select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"),
        "event_type",
        F.col("count").alias("event_count"),
    )


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a checkpoint: id, name, stores, partitions, batches."""
    return spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId", "operatorName", "stateStoreName", "numPartitions", "minBatchId", "maxBatchId"
    )
