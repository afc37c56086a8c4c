from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Defaults of the ingest streams.
BOOTSTRAP_SERVERS = "kafka:9092"
OFFSETS_PER_BATCH = 50_000


def kafka_options(
    topic: str,
    bootstrap_servers: str = BOOTSTRAP_SERVERS,
    starting_offsets: str = "latest",
    max_offsets: int | None = OFFSETS_PER_BATCH,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the streaming Kafka source for one topic.

    ``min_partitions`` lets one topic partition be read by several tasks, so a topic
    with few partitions, or one large one, does not limit the stream.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "false",
    }
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def stream_kafka(spark: SparkSession, topic: str, **settings) -> DataFrame:
    """Unbounded messages of ``topic``; needs Spark's Kafka package on the classpath."""
    return spark.readStream.format("kafka").options(**kafka_options(topic, **settings)).load()


def bounded_kafka_options(
    topic: str, offsets: Mapping[int, tuple[int, int]] | None = None, **settings
) -> dict[str, str]:
    """Options of a bounded read of one topic; lost messages fail it.

    ``offsets`` gives for each partition the first offset and the one after the last,
    so only that part of the topic is fetched; by default it is all the topic holds.
    """
    first, last = "earliest", "latest"
    if offsets is not None:
        first = json.dumps({topic: {str(p): start for p, (start, _) in offsets.items()}})
        last = json.dumps({topic: {str(p): end for p, (_, end) in offsets.items()}})
    options = kafka_options(topic, starting_offsets=first, max_offsets=None, **settings)
    if offsets is not None:
        # Both bounds have to name every partition read, so only these are assigned.
        del options["subscribe"]
        options["assign"] = json.dumps({topic: sorted(offsets)})
    return options | {"endingOffsets": last, "failOnDataLoss": "true"}


def read_kafka(
    spark: SparkSession,
    topic: str,
    offsets: Mapping[int, tuple[int, int]] | None = None,
    **settings,
) -> DataFrame:
    """The messages ``topic`` holds now, or those between two offsets of each partition."""
    options = bounded_kafka_options(topic, offsets, **settings)
    return spark.read.format("kafka").options(**options).load()


def stream_text(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Unbounded messages from text files appearing in a folder, one per line."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages from text files, one per line."""
    return spark.read.text(path)


def strings(spark: SparkSession, values: Iterable[str | None]) -> DataFrame:
    """A few messages given as strings, for trying things out."""
    return spark.createDataFrame([(v,) for v in values], "value string")


def take_messages(
    messages: DataFrame, n: int, order: Sequence[str] = ("partition", "offset")
) -> DataFrame:
    """The first ``n`` messages in log order, as text, with their position.

    All of ``messages`` is looked through; of a long topic, read only some offsets.
    """
    return (
        messages.orderBy(*order)
        .limit(n)
        .select(*order, F.col("value").cast("string").alias("value"))
    )
