from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from contextlib import nullcontext
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import quality
from ..operators.transform import conform, parse, project
from ..session import configure
from ..sinks.parquet import Quarantine, kept
from ..sinks.stats import StatsLog
from ..specs import DatasetSpec

logger = logging.getLogger(__name__)

# Where a message came from, kept to break ties and to find rejected messages again.
POSITION = ("partition", "offset")
# How long to wait for one stream before looking after the others.
CHECK_SECONDS = 5


class TableSink(Protocol):
    """Where rows go. A sink that goes through its batch once, and through all of it in its
    first job, says so by an attribute ``one_pass``, which saves holding the batch."""

    def write(self, batch: DataFrame) -> None: ...


@dataclass(frozen=True)
class IngestJob:
    """One stream: the messages of a dataset, checked, into a table."""

    spec: DatasetSpec
    messages: DataFrame
    table: TableSink
    checkpoint: str
    quarantine: Quarantine | None = None
    stats: StatsLog | None = None
    as_of: datetime | Column | None = None
    max_age_ms: int | None = quality.MAX_AGE_MS


def batch_writer(job: IngestJob, load: str | None = None) -> Callable[[DataFrame, int], None]:
    """The function that writes one micro-batch of flagged messages.

    ``load`` names what is written outside a stream, which has an id of its own.

    The batch is kept while it feeds the counts, the table and the quarantine, so it is
    evaluated once. For a sink that goes through it once it is not kept but counted on the
    way, as parsed rows take many times the room of what such a sink holds; only a batch with
    rejected rows is then evaluated again, for the quarantine.
    An error is raised on, so the query stops and the batch is repeated on restart.
    """
    spec = job.spec
    one_pass = getattr(job.table, "one_pass", False)
    counts = (F.count(F.lit(1)).alias("total"), F.count_if(F.size("errors") == 0).alias("good"))

    def land(rows: DataFrame) -> None:
        sources = [c for c in rows.columns if c.startswith("source_")]
        landed = conform(project(quality.valid(rows), spec, keep=sources), spec)
        missing = quality.missing_columns(landed, spec.must_have)
        if missing:
            raise ValueError(f"{spec.name}: missing columns {missing}")
        job.table.write(landed)

    def landed_counts(rows: DataFrame) -> tuple[int, int]:
        # A look for a valid row ends at the first one. Without any, nothing would be counted.
        if not one_pass or quality.valid(rows).isEmpty():
            total, good = rows.agg(*counts).first()
            if good:
                land(rows)
            return total, good
        seen = Observation()
        land(rows.observe(seen, *counts))
        return seen.get["total"], seen.get["good"]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = load or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        with nullcontext(batch) if one_pass else kept(batch) as rows:
            total, good = landed_counts(rows)
            if total == 0:
                logger.info("%s batch %s: nothing to write", spec.name, batch_id)
                return
            if job.quarantine is not None and good < total:
                job.quarantine.write(quality.quarantined(rows), query_id, batch_id)
        if job.stats is not None:
            metrics = {f"{spec.name}.read": total, f"{spec.name}.valid": good,
                       f"{spec.name}.rejected": total - good}
            now = datetime.now(timezone.utc).replace(tzinfo=None)
            job.stats.write(spark, metrics, now, query_id, batch_id)
        logger.info("%s batch %s: %s of %s rows valid", spec.name, batch_id, good, total)

    return write


def flagged_messages(job: IngestJob) -> DataFrame:
    """The job's messages, parsed and with the rules each one breaks."""
    keep = [name for name in POSITION if name in job.messages.columns]
    parsed = parse(job.messages, job.spec, keep, diagnose=True)
    return quality.flag(parsed, job.spec, job.as_of, job.max_age_ms)


def ingest_batch(job: IngestJob, load: str) -> None:
    """Land a bounded set of messages in one go, for example a backlog.

    ``load`` names this set: repeating a load replaces its quarantined messages and
    counts, and the table ignores rows it has.
    """
    configure(job.messages.sparkSession)
    batch_writer(job, load)(flagged_messages(job), 0)


def start_ingest(job: IngestJob, trigger: dict[str, Any] | None = None) -> StreamingQuery:
    """Start the stream; it resumes from its checkpoint.

    Without a ``trigger`` the batches follow each other at once; ``{"availableNow":
    True}`` takes what is there and stops.
    """
    spark = configure(job.messages.sparkSession)
    # Streams of one application share the cluster fairly.
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", job.spec.name)
    valid = F.size("errors") == 0
    # Counted in the batch's own pass, for listeners; recomputed parts count again.
    counted = flagged_messages(job).observe(
        "messages",
        F.count(F.lit(1)).alias("read"),
        F.count_if(valid).alias("valid"),
        F.count_if(~valid).alias("rejected"),
    )
    writer = (
        counted.writeStream.queryName(job.spec.name)
        .foreachBatch(batch_writer(job))
        .option("checkpointLocation", job.checkpoint)
    )
    if trigger is not None:
        writer = writer.trigger(**trigger)
    try:
        return writer.start()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)


def run_all(
    jobs: Iterable[IngestJob], trigger: dict[str, Any] | None = None
) -> list[StreamingQuery]:
    """Run several streams until all end, or one fails; then stop the rest and raise.

    Only these streams are watched, not others of the session.
    """
    queries: list[StreamingQuery] = []
    try:
        queries.extend(start_ingest(job, trigger) for job in jobs)
        while active := [query for query in queries if query.isActive]:
            active[0].awaitTermination(CHECK_SECONDS)
            _raise_failure(queries)
        _raise_failure(queries)
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
    return queries


def _raise_failure(queries: Iterable[StreamingQuery]) -> None:
    for query in queries:
        error = query.exception()
        if error is not None:
            raise error

