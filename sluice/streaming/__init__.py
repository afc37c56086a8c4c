"""Streaming ingest of the datasets, reports in event time or kept up to date, and progress."""

from .ingest import IngestJob, ingest_batch, run_all, start_ingest
from .late import LateRows, keep_late
from .progress import (
    ProgressLog,
    checkpointed_batches,
    open_groups,
    open_windows,
    progress,
    source_lag,
    state_operators,
)
from .rollup import Rollup, keep_report
from .running import keep_totals, running_stock_stream, running_totals
from .windows import dedup_stream, windowed_counts

__all__ = [
    "IngestJob",
    "LateRows",
    "ProgressLog",
    "Rollup",
    "checkpointed_batches",
    "dedup_stream",
    "ingest_batch",
    "keep_late",
    "keep_report",
    "keep_totals",
    "open_groups",
    "open_windows",
    "progress",
    "run_all",
    "running_stock_stream",
    "running_totals",
    "source_lag",
    "start_ingest",
    "state_operators",
    "windowed_counts",
]
