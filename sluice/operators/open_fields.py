"""Messages whose producers add fields before the dataset's record knows them.

A message is read once, as a VARIANT. The known fields come out of it by type, and what the
record does not name is kept beside them as JSON text, so it lands with the row, can be
compared like any column, and can be asked for later without reading messages again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import DatasetSpec
from .transform import source_name

EXTRA = "extra_fields"


def parse_open(messages: DataFrame, spec: DatasetSpec, keep: Sequence[str] = ()) -> DataFrame:
    """The wire fields of ``spec`` and, as JSON text, the object of all others.

    ``extra_fields`` is NULL if there are no others. Missing fields and values that can't be
    cast are NULL; unlike ``parse``, a number in quotes is taken as one. All fields of what is
    no JSON object are NULL. The envelope columns in ``keep`` stay as ``source_<name>``.
    """
    body = F.try_parse_json(F.col("value").cast("string"))
    kept = [F.col(name).alias(source_name(name)) for name in keep]
    # Out of a generator, so that the fields below share one reading of the message.
    read = messages.select(F.inline(F.array(F.struct(body.alias("_body")))), *kept)
    known = [F.lit(field.name) for field in spec.wire_schema.fields]
    is_object = F.schema_of_variant("_body").startswith("OBJECT")
    entries = F.when(is_object, F.expr("TRY_CAST(_body AS MAP<STRING, VARIANT>)"))
    others = F.map_filter(entries, lambda name, _: ~name.isin(known))
    fields = [
        F.when(is_object, F.try_variant_get("_body", f"$.{f.name}", f.dataType.simpleString())).alias(f.name)
        for f in spec.wire_schema.fields
    ]
    extra = F.when(F.size(others) > 0, F.to_json(F.to_variant_object(others)))
    return read.select(*fields, extra.alias(EXTRA), *[source_name(name) for name in keep])


def extra_field(path: str, kind: str) -> Column:
    """One of the kept fields as type ``kind``; ``path`` is its name, or a path like ``a.b[0]``."""
    return F.try_variant_get(F.try_parse_json(F.col(EXTRA)), f"$.{path}", kind)
