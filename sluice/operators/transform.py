"""From message bytes to landed columns: parse, project, conform.

The three steps only select, so batch and stream use the same functions and Spark
runs them as one stage without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import is_uuid
from ..specs import DatasetSpec, TableColumn

RAW = "raw_value"
CORRUPT = "_corrupt_record"


def parse(
    messages: DataFrame,
    spec: DatasetSpec,
    keep: Sequence[str] = (),
    diagnose: bool = False,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Decode the JSON in ``value`` into the wire fields of ``spec``, or only ``fields``.

    Unknown fields are dropped, missing or wrongly typed ones become NULL. The
    envelope columns named in ``keep`` stay as ``source_<name>``. With ``diagnose``
    the raw text and the parser's verdict on it are kept for validation (and all
    fields are decoded).
    """
    text = F.col("value").cast("string")
    kept = [F.col(name).alias(source_name(name)) for name in keep]
    # The fields come out of a generator, because later filters on plain projected
    # fields would be pushed below the projection and parse the message once per use.
    if not diagnose:
        wanted = [f for f in spec.wire_schema.fields if fields is None or f.name in fields]
        data = F.from_json(text, StructType(wanted))
        return messages.select(F.inline(F.array(data)), *kept)
    schema = StructType(spec.wire_schema.fields + [StructField(CORRUPT, StringType())])
    data = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})
    return messages.select(F.inline(F.array(data)), text.alias(RAW), *kept)


def source_name(name: str) -> str:
    """Name under which the envelope column ``name`` is kept beside the wire fields."""
    return f"source_{name}"


def project(
    parsed: DataFrame,
    spec: DatasetSpec,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename and convert wire fields to the landed columns, in table order.

    ``ingested_at`` defaults to the (per batch constant) current time; columns in
    ``keep`` pass through.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    return parsed.select(
        *[F.expr(c.expression).alias(c.name) for c in spec.columns],
        stamp.cast("timestamp_ntz").alias("ingested_at"),
        *keep,
    )


def ingest(
    messages: DataFrame,
    spec: DatasetSpec,
    ingested_at: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Messages to landed columns in one go, without validation."""
    return project(
        parse(messages, spec, keep), spec, ingested_at, [source_name(name) for name in keep]
    )


def conform(projected: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Narrow the columns to the table's types and add its defaulted columns.

    A value that does not fit becomes NULL; validation reports it beforehand.
    """
    landed = set(spec.column_names)
    rest = [c for c in projected.columns if c not in landed]
    return projected.select(
        *[narrowed(F.col(c.name), c).alias(c.name) for c in spec.columns],
        *[F.expr(c.expression).cast(c.type).alias(c.name) for c in spec.defaults],
        *rest,
    )


def narrowed(value: Column, column: TableColumn) -> Column:
    """``value`` as the table stores it, NULL where it cannot be stored."""
    if column.uuid:
        return F.when(is_uuid(value), F.lower(value))
    if column.max_length is not None:
        return F.when(F.length(value) <= column.max_length, value)
    return value.try_cast(column.type)
