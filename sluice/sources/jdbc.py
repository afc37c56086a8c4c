from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_column: str | None = None,
    lower: str | int | None = None,
    upper: str | int | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """A database table. Filters and column choices are sent to the database.

    Give ``split_column`` (a number, date or timestamp) with its ``lower`` and
    ``upper`` values to read in ``partitions`` parallel ranges; without it one task
    reads everything.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_column is not None:
        if lower is None or upper is None:
            raise ValueError("split_column needs lower and upper")
        reader = reader.options(
            partitionColumn=split_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()
