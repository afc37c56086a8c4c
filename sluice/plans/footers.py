"""Row counts and newest rows of landed tables from the footers of their Parquet files.

Spark answers COUNT, MIN and MAX from footers if it reads Parquet through its second data
source interface; then no column is read, whatever the table holds. That is a setting of
a session, so the tables are opened in a session beside the caller's (same context, own
settings), and every report on them runs there. Other reports are better off with the
tables as ``Warehouse.tables`` opens them.

Times have no order in footers that Spark uses, so ``ingested_at`` is read as the 64-bit
number of microseconds it is stored as. Spark finds a column's statistics by its place, so
all files of a folder must hold the same plain columns in the same order, as a sink writes
them from one record; after a change of a record's columns use ``monitoring`` on the
tables instead. Nested columns are refused.

Defined results: a folder without rows counts 0 and has no newest row; NULL times among
others are passed over. A file in which every ``ingested_at`` is NULL has no newest time
in its footer, and Spark fails on it; sinks write none, as landing stamps each row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StructField, StructType, TimestampNTZType, VariantType

from ..session import configure

_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
INGESTED = "ingested_at"


def _beside(spark: SparkSession) -> SparkSession:
    """A session that answers aggregates from footers."""
    session = configure(spark.newSession())
    for name, value in _SETTINGS.items():
        session.conf.set(name, value)
    return session


def open_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """The landed tables in ``paths`` (folder by table name), for ``count_rows``,
    ``table_counts_row`` and ``table_counts_long`` of ``monitoring`` and ``newest`` here.

    ``ingested_at`` is a number of microseconds in them.
    """
    session = _beside(spark)
    return {name: _open(session, path) for name, path in paths.items()}


def _open(session: SparkSession, path: str) -> DataFrame:
    rows = session.read.parquet(path)
    nested = [f.name for f in rows.schema if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    if nested:
        raise ValueError(f"footers are not used for tables with nested columns: {nested}")
    fields = [
        StructField(f.name, LongType() if f.name == INGESTED and f.dataType == TimestampNTZType() else f.dataType)
        for f in rows.schema
    ]
    table = session.read.schema(StructType(fields)).parquet(path)
    # Of files without any rows, Spark would make the count NULL.
    return session.createDataFrame([], table.schema) if rows.isEmpty() else table


def _moment(micros):
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def max_ingested(df: DataFrame) -> DataFrame:
    """Time of the newest row of a table from ``open_tables``."""
    newest = df.agg(F.max(INGESTED).alias("micros"))
    return newest.select(_moment(F.col("micros")).alias("max_ingested_at"))


def newest(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The newest ``ingested_at`` of each table, as a table of one row: what
    ``monitoring.data_freshness`` needs of them."""
    return {name: max_ingested(df).withColumnRenamed("max_ingested_at", INGESTED) for name, df in tables.items()}
