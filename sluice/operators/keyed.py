"""One row per key: de-duplication, insert-if-absent and update-latest.

Winners are picked by aggregating a struct that starts with the ordering columns and
goes on with all others. That is a total order, so the result does not depend on how
rows are spread, and each task reduces its rows before the shuffle, so a key holding
a large part of the data costs one row per task.

A row without a key is like no other row: all of them stay. Callers that have seen to
such rows say ``nullable=False``, which leaves the result spread by the key alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], nullable: bool = True
) -> DataFrame:
    """The smallest row per key by ``order``, then by all remaining columns."""
    return _pick(df, key, order, F.min, nullable)


def latest_per_key(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], nullable: bool = True
) -> DataFrame:
    """The largest row per key by ``order``, then by all remaining columns."""
    return _pick(df, key, order, F.max, nullable)


def _pick(
    df: DataFrame, key: str | Sequence[str], order: Sequence[str], choose, nullable: bool
) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [name for name in df.columns if name not in keys and name not in order]
    row: Column = F.struct(*order, *rest)
    columns, groups = df.columns, keys
    if nullable:
        # A number of its own for each row without a key, which also spreads such rows.
        missing = F.array_contains(F.array(*[F.col(name).isNull() for name in keys]), True)
        df = df.withColumn("_own", F.when(missing, F.monotonically_increasing_id()))
        groups = [*keys, "_own"]
    return (
        df.groupBy(*groups)
        .agg(choose(row).alias("_row"))
        .select(*keys, "_row.*")
        .select(*columns)
    )


def insert_if_absent(
    target: DataFrame, batch: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """``target`` plus the first row of each key of ``batch`` it does not hold yet."""
    new = first_per_key(batch, key, order).join(target.select(key), key, "left_anti")
    return target.unionByName(new)


def update_latest(
    target: DataFrame, batch: DataFrame, key: str, order: Sequence[str]
) -> DataFrame:
    """One row per key of both inputs, the latest; an older row never replaces a newer one."""
    return latest_per_key(target.unionByName(batch), key, order)


def require_key(rows: DataFrame, key: str) -> DataFrame:
    """Make the job fail on a row without a key, rather than lose or merge such rows."""
    missing = F.raise_error(F.lit(f"row without {key}")).cast(rows.schema[key].dataType)
    return rows.withColumn(key, F.coalesce(F.col(key), missing))
