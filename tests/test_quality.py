from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from sluice.operators import quality
from sluice.operators.transform import conform, ingest, parse, project
from sluice.sources import strings
from sluice.specs import LOGISTICS, ORDERS, WEATHER, get_spec

from .messages import EDGE_CASES, ORDER, SHIPMENT, WEATHER as WEATHER_MESSAGE, text

AS_OF = datetime(2024, 5, 17, 10, 1)  # the time of the sample messages


@pytest.mark.parametrize("kind", ["orders", "weather", "logistics"])
def test_edge_messages(spark, kind):
    spec = get_spec(kind)
    cases = [(value, errors) for k, value, errors in EDGE_CASES if k == kind]
    numbered = spark.createDataFrame(
        [(i, value) for i, (value, _) in enumerate(cases)], "offset int, value string"
    )
    flagged = quality.flag(parse(numbered, spec, ["offset"], diagnose=True), spec, AS_OF)
    found = {r["source_offset"]: r["errors"] for r in flagged.collect()}
    for i, (value, errors) in enumerate(cases):
        assert found[i] == errors, value
    rejected = quality.quarantined(flagged)
    assert rejected.count() == sum(1 for _, errors in cases if errors)
    assert {r["raw_value"] for r in rejected.collect()} == {v for v, e in cases if e}
    assert quality.valid(flagged).count() == sum(1 for _, errors in cases if not errors)


def test_missing_items_and_coordinates(spark):
    values = [text(ORDER, items=None), text(ORDER, items=[]), text(ORDER)]
    counts = ingest(strings(spark, values), ORDERS).select("item_count").collect()
    assert [r[0] for r in counts] == [-1, 0, 1]
    half = text(SHIPMENT, current_location={"latitude": 40.7})
    none = text(SHIPMENT, current_location=None)
    places = ingest(strings(spark, [half, none]), LOGISTICS).select("current_location").collect()
    assert [r[0] for r in places] == ["40.7", ""]


def test_unstorable_values_become_null(spark):
    values = [text(WEATHER_MESSAGE, temperature=t) for t in (12345.6, 1.005, 2.675)]
    rows = conform(ingest(strings(spark, values), WEATHER), WEATHER).collect()
    assert [None if r["temperature"] is None else str(r["temperature"]) for r in rows] == [
        None, "1.01", "2.68",
    ]


def test_ingestion_time_defaults_to_now(spark):
    row = ingest(strings(spark, [text(WEATHER_MESSAGE)]), WEATHER).first()
    assert abs((row["ingested_at"] - datetime.now(timezone.utc).replace(tzinfo=None)).total_seconds()) < 300
    assert row["recorded_at"] == datetime(2024, 5, 17, 10, 1)


def test_required_columns(spark):
    rows = project(parse(strings(spark, [text(ORDER)]), ORDERS), ORDERS)
    assert quality.validate_required_fields(rows, ORDERS.must_have)
    assert not quality.validate_required_fields(rows.drop("order_id"), ORDERS.must_have)
    assert quality.missing_columns(rows.drop("order_id"), ORDERS.must_have) == ["order_id"]


def test_non_null_ratio(spark):
    df = spark.createDataFrame([(1, None)] * 9 + [(1, 2)], "a int, b int")
    assert quality.validate_non_null_count(df, "a")
    assert not quality.validate_non_null_count(df, "b")
    assert quality.validate_non_null_count(df, "b", min_ratio=0.1)
    assert not quality.validate_non_null_count(df.limit(0), "a")


def test_results_do_not_depend_on_ansi_mode(spark):
    values = [value for kind, value, _ in EDGE_CASES if kind == "orders"]
    rows = {}
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            df = conform(ingest(strings(spark, values), ORDERS, F.lit("2024-01-01")), ORDERS)
            flagged = quality.flag(parse(strings(spark, values), ORDERS, diagnose=True), ORDERS, AS_OF)
            rows[ansi] = (df.collect(), flagged.select("errors").collect())
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert rows["true"] == rows["false"]
