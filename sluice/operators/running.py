"""Running totals that survive keys holding a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

# Rows of a key that one task adds up; the rows of a key with more are spread over tasks.
SPLIT_OVER = 1_000_000


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    split_over: int = SPLIT_OVER,
) -> DataFrame:
    """Add ``name``, the sum of ``value`` over the key's rows up to and including this one.

    ``order`` must order the rows of a key totally. As with a window, a NULL value repeats
    the total so far, a key without any value yet has NULL, and NULL keys are one key.

    The rows of each key are counted while this plan is built, which reads the key columns
    alone. Rows of keys with at most ``split_over`` rows are shuffled once, to a window. Those
    of larger keys are added up in pieces, however large a key is; there are at most as many
    such keys as ``split_over`` goes into the number of rows.
    """
    key = F.struct(*keys)  # equal to itself whether or not parts of it are NULL
    counts = df.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    large = cut_lineage(counts.where(F.col("_rows") > split_over).select("_key"))
    if large.isEmpty():
        return _in_windows(df, keys, order, value, name)
    large, rows = F.broadcast(large), df.withColumn("_key", key)
    small = rows.join(large, "_key", "left_anti").select(*df.columns)
    split = rows.join(large, "_key", "left_semi").select(*df.columns)
    return _in_windows(small, keys, order, value, name).union(
        _in_pieces(split, keys, order, value, name)
    )


def _up_to_here(by: Sequence[str], order: Sequence[str]):
    return (
        Window.partitionBy(*by)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _in_windows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """The running total where a task has room for each key's rows."""
    return df.select("*", F.sum(value).over(_up_to_here(keys, order)).alias(name))


def _in_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str
) -> DataFrame:
    """The running total where keys hold many rows.

    Rows are range-partitioned by key and order, so that a key spans as many pieces as its
    share of the rows asks for, summed within each piece, and lifted by the totals of the
    key's earlier pieces. The pieces are written to the checkpoint folder while this plan is
    built, since they are read twice and range boundaries come from a sample that need not
    repeat.
    """
    pieces = cut_lineage(
        df.withColumn("_key", F.struct(*keys))
        .repartitionByRange(*keys, *order)
        .withColumn("_piece", F.spark_partition_id())
    )
    earlier = Window.partitionBy("_key").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        pieces.groupBy("_key", "_piece")
        .agg(F.sum(value).alias("_total"))
        .select("_key", "_piece", F.sum("_total").over(earlier).alias("_before"))
    )
    within = pieces.withColumn("_within", F.sum(value).over(_up_to_here(["_key", "_piece"], order)))
    total = F.coalesce(F.col("_within") + F.col("_before"), "_within", "_before")
    return within.join(before, ["_key", "_piece"]).select(*df.columns, total.alias(name))
