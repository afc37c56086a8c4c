"""Topic routing: which destination each device message is forwarded to."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import topic_matches
from ..specs import DatasetSpec

# Masks of rules are broadcast up to this many bytes, which are measured.
MASK_BYTES = 32 << 20


class Route(NamedTuple):
    """Messages whose topic matches ``topic_filter`` go to ``destination``."""

    topic_filter: str
    destination: str


def exact_routes(specs: Iterable[DatasetSpec]) -> list[Route]:
    """One rule per dataset, for its one device topic."""
    return [Route(s.device_topic, s.topic) for s in specs if s.device_topic]


def wildcard_routes(specs: Iterable[DatasetSpec]) -> list[Route]:
    """One rule per dataset, for every attribute of its kind of device."""
    return [Route(s.device_filter, s.topic) for s in specs if s.device_filter]


def route(messages: DataFrame, routes: Iterable[Route]) -> DataFrame:
    """Forward each message once per matching rule; unmatched messages are left out.

    The rules become expressions over the topic, so there is no join and no shuffle.
    """
    matches = F.array_compact(
        F.array(*[F.when(topic_matches(F.col("topic"), r.topic_filter), F.lit(r.destination))
                  for r in routes])
    )
    return messages.withColumn("destination", F.explode(matches))


def routes_table(spark: SparkSession, routes: Iterable[Route]) -> DataFrame:
    """Rules as a table with the columns of :class:`Route`."""
    return spark.createDataFrame([tuple(r) for r in routes], "topic_filter string, destination string")


def _mask(levels: Column) -> Column:
    """One sign per level: ``+`` where any level will do, ``=`` where it has to be equal."""
    return F.concat_ws("", F.transform(levels, lambda level: F.when(level == "+", "+").otherwise("=")))


def route_by_table(messages: DataFrame, rules: DataFrame) -> DataFrame:
    """Forward each message once per matching rule, for any number of rules.

    ``rules`` has ``topic_filter`` and ``destination``, as may other tables; null filters match
    nothing, and a rule listed twice forwards twice. Rules differ in which levels are ``+``. A
    message gets one key for each such mask that rules of its number of levels have, its topic
    with those levels as ``+``, and meets the rules by equal keys. So a message costs the masks
    in use, not the rules, and both joins are on equal values: by hash if the rules are few, by
    shuffling if they are not, where a busy topic can be split.
    """
    levels = F.split("topic_filter", "/")
    keyed = rules.where(F.col("topic_filter").isNotNull()).select(
        F.size(levels).alias("_levels"),
        _mask(levels).alias("_mask"),
        F.col("topic_filter").alias("_key"),
        "destination",
    )
    # No more masks than there are ways to mark that many levels.
    masks = keyed.groupBy("_levels").agg(F.collect_set("_mask").alias("_masks"))
    size = F.sum((F.col("_levels") + 16) * F.size("_masks"))
    if (masks.agg(size).first()[0] or 0) <= MASK_BYTES:
        masks = F.broadcast(masks)  # else messages would be shuffled by a handful of numbers
    levels = F.split("topic", "/")
    marked = messages.drop("destination").withColumn("_levels", F.size(levels)).join(masks, "_levels")
    signs = F.split("_mask", "")
    # A topic's level under a "+" must not be empty.
    fits = ~F.arrays_overlap(
        F.zip_with(levels, signs, lambda level, sign: F.concat(sign, level)), F.array(F.lit("+"))
    )
    key = F.zip_with(levels, signs, lambda level, sign: F.when(sign == "+", "+").otherwise(level))
    asked = (
        marked.withColumn("_mask", F.explode("_masks"))
        .where(fits)
        .withColumn("_key", F.concat_ws("/", key))
    )
    met = asked.join(keyed.drop("_levels"), ["_mask", "_key"])
    return met.select(*[c for c in messages.columns if c != "destination"], "destination")


def forwarded(routed: DataFrame) -> DataFrame:
    """The part of a message the forwarding rules select, with its destination."""
    return routed.select("destination", "topic", "payload", "qos", "retain")


def envelope(routed: DataFrame) -> DataFrame:
    """Routed messages in the shape the Kafka sink writes.

    The device is the key; device, topic and quality of service also go into headers.
    """
    def header(name: str, column: str):
        return F.struct(
            F.lit(name).alias("key"), F.col(column).cast("string").cast("binary").alias("value")
        )

    return routed.select(
        F.col("destination").alias("topic"),
        F.col("clientid").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"),
        F.col("timestamp"),
        F.array(header("clientid", "clientid"), header("topic", "topic"), header("qos", "qos")).alias(
            "headers"
        ),
    )
