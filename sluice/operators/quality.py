"""Row-level validation: every message gets the list of rules it breaks.

Nothing is dropped here. Rows with an empty list go to the table, the others to
quarantine with their raw text, so a bad message never stops a stream.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions import is_uuid, moment
from ..specs import DatasetSpec
from .transform import CORRUPT, RAW

logger = logging.getLogger(__name__)

# Messages may be at most this old (or this far ahead), and this
# share of a column must be filled.
MAX_AGE_MS = 24 * 60 * 60 * 1000
MIN_RATIO = 0.9


def missing_columns(df: DataFrame, needed: Sequence[str]) -> list[str]:
    """Names in ``needed`` that ``df`` lacks."""
    return [name for name in needed if name not in df.columns]


def validate_required_fields(df: DataFrame, needed: Sequence[str]) -> bool:
    """Whether all needed columns are present; checks names only, at plan time."""
    missing = missing_columns(df, needed)
    if missing:
        logger.warning("missing columns: %s", ", ".join(missing))
    return not missing


def non_null_ratios(
    df: DataFrame, columns: Sequence[str] | None = None, min_ratio: float = MIN_RATIO
) -> DataFrame:
    """One row per column with its share of non-NULL values, from a single pass.

    The ratio of an empty input is 0, so it does not pass.
    """
    names = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(name)).alias(name) for name in names]
    )
    entries = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("non_null")) for name in names]
    )
    ratio = F.when(F.col("total_rows") > 0, F.col("non_null") / F.col("total_rows")).otherwise(0.0)
    return (
        counted.select(F.col("_rows").alias("total_rows"), F.inline(entries))
        .withColumn("ratio", ratio)
        .withColumn("passes", F.col("ratio") >= F.lit(min_ratio))
        .select("column_name", "non_null", "total_rows", "ratio", "passes")
    )


def validate_non_null_count(df: DataFrame, column: str, min_ratio: float = MIN_RATIO) -> bool:
    """Whether ``column`` is filled often enough."""
    row = non_null_ratios(df, [column], min_ratio).first()
    if not row["passes"]:
        logger.warning("column %s: %.2f%% filled", column, 100 * row["ratio"])
    return row["passes"]


def rule_violations(
    spec: DatasetSpec, as_of: datetime | Column | None = None, max_age_ms: int | None = MAX_AGE_MS
) -> list[tuple[str, Column]]:
    """All rules of ``spec`` as (label, condition that is true on a violation).

    ``as_of`` is the moment message age is measured from (default: now);
    ``max_age_ms=None`` switches the age rule off.
    """
    rules: list[tuple[str, Column]] = [("type", F.col(CORRUPT).isNotNull())]
    rules += [(f"required:{name}", F.col(name).isNull()) for name in spec.required]
    rules += range_rules(spec) + domain_rules(spec)
    rules += [(f"check:{name}", ~F.coalesce(F.expr(e), F.lit(False))) for name, e in spec.checks.items()]
    for column in spec.columns:
        value = F.expr(column.expression)
        if column.uuid:
            rules.append((f"uuid:{column.name}", ~is_uuid(value)))
        elif column.max_length is not None:
            rules.append((f"length:{column.name}", F.length(value) > column.max_length))
        elif column.type.startswith("decimal"):
            rules.append(
                (f"fit:{column.name}", value.isNotNull() & value.try_cast(column.type).isNull())
            )
        elif column.name == spec.event_time:
            rules.append((f"fit:{column.name}", F.col("timestamp").isNotNull() & value.isNull()))
    if max_age_ms is not None:
        rules.append(("stale", stale(as_of, max_age_ms)))
    return rules


def range_rules(spec: DatasetSpec) -> list[tuple[str, Column]]:
    return [
        (f"range:{name}", ~F.col(name).between(low, high))
        for name, (low, high) in spec.ranges.items()
    ]


def domain_rules(spec: DatasetSpec) -> list[tuple[str, Column]]:
    """Values outside their lists; of a list of items, each item needs a listed value."""

    def outside(name: str, values: Sequence[str]) -> Column:
        if isinstance(spec.wire_schema[name.split(".")[0]].dataType, ArrayType):
            return F.exists(F.col(name), lambda v: ~F.coalesce(v.isin(*values), F.lit(False)))
        return ~F.col(name).isin(*values)

    return [(f"domain:{name}", outside(name, values)) for name, values in spec.domains.items()]


def stale(as_of: datetime | Column | None = None, max_age_ms: int = MAX_AGE_MS) -> Column:
    """Whether the message's time is further than ``max_age_ms`` from ``as_of``."""
    now = F.unix_millis(F.current_timestamp() if as_of is None else moment(as_of).cast("timestamp"))
    return ~F.col("timestamp").between(now - max_age_ms, now + max_age_ms)


def flag(
    parsed: DataFrame,
    spec: DatasetSpec,
    as_of: datetime | Column | None = None,
    max_age_ms: int | None = MAX_AGE_MS,
) -> DataFrame:
    """Add ``errors``, the labels of all broken rules, to messages parsed with ``diagnose``.

    Text that is not a JSON object at all has the single error ``malformed``.
    """
    nothing_parsed = reduce(and_, [F.col(name).isNull() for name in spec.wire_schema.names])
    malformed = F.col(RAW).isNull() | (F.trim(RAW) == "") | (
        F.col(CORRUPT).isNotNull() & nothing_parsed
    )
    # Joined text, then split: unlike array functions with a lambda this is compiled.
    broken = F.concat_ws(
        ",",
        *[F.when(bad, F.lit(label)) for label, bad in rule_violations(spec, as_of, max_age_ms)],
    )
    labels = F.when(malformed, F.lit("malformed")).otherwise(broken)
    none = F.array().cast("array<string>")
    return parsed.withColumn("errors", F.when(labels == "", none).otherwise(F.split(labels, ",")))


def valid(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("errors") == 0)


def quarantined(flagged: DataFrame) -> DataFrame:
    """Rejected messages with their raw text and the rules they break."""
    source = [name for name in flagged.columns if name.startswith("source_")]
    return flagged.where(F.size("errors") > 0).select(RAW, "errors", *source)


def count_violations(
    parsed: DataFrame, dataset: str, rules: Sequence[tuple[str, Column]]
) -> DataFrame:
    """One row per rule with the number of violating rows, from a single pass."""
    labels = [label for label, _ in rules]
    counted = parsed.agg(*[F.count_if(bad).alias(label) for label, bad in rules])
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("rule"), F.col(f"`{label}`").alias("violations"))
            for label in labels
        ]
    )
    return counted.select(F.lit(dataset).alias("dataset"), F.inline(entries))
