"""What several operators share: words, learning folds, size-checked broadcasts, written tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import cut_lineage, shared_dir

# A word is a run of other characters than these six.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# What may be sent to every executor. Anything larger is joined by shuffling.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The words of ``text`` in order; none if it is null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Without the binding, an expression used inside a lambda is computed again for
    every element the lambda sees.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured rows fit ``limit`` bytes, else as it is.

    Counts ``df``, so it should be cheap to evaluate twice (a checkpoint, a written
    table). Arrays, structs and maps count as their JSON. Without the hint Spark shuffles
    both sides and splits skewed partitions.
    """

    def size(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        if kind.startswith(("array", "struct", "map")):
            value = F.to_json(value)
        elif kind not in ("string", "binary"):
            return F.lit(16)
        return F.coalesce(F.octet_length(value).cast("long"), F.lit(0)) + 16

    sizes = [F.lit(16)] + [size(name, kind) for name, kind in df.dtypes]
    total = df.agg(F.sum(sum(sizes[1:], sizes[0]))).first()[0] or 0
    return F.broadcast(df) if total <= limit else df


def most_frequent(counts: DataFrame, n: str, limit: int) -> DataFrame:
    """The rows of ``counts`` with the largest ``n``, at most ``limit`` of them.

    Whole classes of like frequency (within a sixteenth of a power of two) are taken or
    left, so nothing is sorted and only the sizes of the classes reach the driver.
    """
    frequency = F.floor(F.log2(F.col(n)) * 16)
    classes = counts.groupBy(frequency.alias("class")).agg(F.count(n).alias("rows")).collect()
    total, least = 0, float("inf")
    for row in sorted(classes, key=lambda r: -r["class"]):
        total += row["rows"]
        if total > limit:
            break
        least = row["class"]
    return counts.filter(frequency >= F.lit(least))


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared folder and read from there."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sluice-llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder."""
    return cut_lineage(df)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
