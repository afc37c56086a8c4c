"""Where landed rows are written. Every sink may be given the same batch twice."""

from .buckets import BucketTable
from .database import DatabaseTable, upsert_statement
from .jdbc import append_jdbc
from .parquet import AppendTable, Quarantine, export_tables, restore_tables
from .stats import StatsLog
from .upsert import StateTable, UpsertTable

__all__ = [
    "AppendTable",
    "BucketTable",
    "DatabaseTable",
    "Quarantine",
    "StateTable",
    "StatsLog",
    "UpsertTable",
    "append_jdbc",
    "export_tables",
    "restore_tables",
    "upsert_statement",
]
