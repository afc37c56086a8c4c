import json
import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice import DatasetSpec, TableColumn, get_spec, register, specs, wire
from sluice.functions import seconds_between, topic_matches
from sluice.operators import keyed, open_fields, quality, routing
from sluice.operators.running import running_total
from sluice.operators.transform import conform, ingest, parse
from sluice.plans import footers, monitoring, reports
from sluice.session import configure, shared_dir
from sluice.sinks import append_jdbc
from sluice.sources import (
    bounded_kafka_options,
    kafka_options,
    read_jdbc,
    stream_text,
    strings,
    take_messages,
)
from sluice.specs import all_specs
from sluice.streaming import start_ingest
from sluice.warehouse import Warehouse
from sluice_checks import testdata
from sluice_checks.queries import MACHINE_METRICS

SMALL = "/root/testdata/sf0.001"
KINDS = ("weather", "orders", "logistics", "inventory", "user_events")


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("kind", KINDS)
def test_landed_tables_equal_ingested_messages(spark, kind):
    """The tables the reports run on are what the messages would have become."""
    spec = get_spec(kind)
    messages = testdata.messages(spark, SMALL, kind)
    ingested = conform(ingest(messages, spec, F.col("source_timestamp"), ["timestamp"]), spec)
    assert rows_of(ingested.drop("source_timestamp")) == rows_of(testdata.landed(spark, SMALL, kind))


@pytest.mark.parametrize("kind", KINDS)
def test_ingest_only_selects(spark, kind):
    text = spark.read.text(f"{SMALL}/events.parquet").select("value")
    plan = plan_of(conform(ingest(text, get_spec(kind)), get_spec(kind)))
    assert "Exchange" not in plan and plan.count("from_json") == 1


def test_only_the_wanted_fields_are_decoded(spark):
    spec = get_spec("orders")
    rows = parse(testdata.messages(spark, SMALL, "orders"), spec, fields=["items", "order_id"])
    assert rows.columns == ["order_id", "items"]
    everything = parse(testdata.messages(spark, SMALL, "orders"), spec)
    assert rows_of(rows) == rows_of(everything.select("order_id", "items"))


def test_validation_parses_once_and_does_not_shuffle(spark):
    text = spark.read.text(f"{SMALL}/events.parquet").select("value")
    spec = get_spec("orders")
    rejected = quality.quarantined(quality.flag(parse(text, spec, diagnose=True), spec))
    plan = plan_of(rejected)
    assert "Exchange" not in plan and plan.count("from_json(") == 1


@pytest.mark.parametrize("hot", ["third", "all", "many"])
def test_running_total_equals_a_window(spark, hot):
    # NULL values, a NULL key, and a key with a third of the rows, all of them, or many hot keys.
    n = F.col("id")
    key = {"third": F.when(n % 3 == 0, 0).otherwise(n % 100), "all": F.lit(1), "many": n % 2000}[hot]
    df = spark.range(8000).select(
        F.when(key != 7, key).alias("k"),
        (n % 7).alias("t"),
        F.md5(n.cast("string")).alias("id"),
        F.when(n % 5 != 0, n % 11 - 5).cast("int").alias("v"),
    )
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows_of(df.withColumn("total", F.sum("v").over(window)))
    assert rows_of(running_total(df, ["k"], ["t", "id"], "v", "total")) == expected


@pytest.mark.parametrize("keys", ["k", "null", "one"])
def test_running_total_splits_the_keys_with_many_rows_alone(spark, keys):
    # Small keys, one with half of the rows (None, or a value), or no other key than that one.
    n = F.col("id")
    many = F.lit(None if keys == "null" else 0).cast("long")
    df = spark.range(6000).select(
        F.when((n % 2 == 0) | F.lit(keys == "one"), many).otherwise(n % 50 + 1).alias("k"),
        F.when(n % 9 != 0, n % 3).alias("t"),
        F.md5(n.cast("string")).alias("id"),
        F.when(n % 5 != 0, n % 11 - 5).cast("int").alias("v"),
    )
    window = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows_of(df.withColumn("total", F.sum("v").over(window)))
    found = running_total(df, ["k"], ["t", "id"], "v", "total", split_over=1000)
    assert found.columns == ["k", "t", "id", "v", "total"] and rows_of(found) == expected
    assert "_piece" in plan_of(found)


def test_running_total_shuffles_ordinary_keys_once(spark):
    df = spark.range(6000).selectExpr("id % 500 AS k", "id AS t", "md5(string(id)) AS id", "id AS v")
    plan = plan_of(running_total(df, ["k"], ["t", "id"], "v", "total"))
    # No piece is written or joined: rows go from where they come from to their window.
    assert plan.count("Exchange") == 1 and "Join" not in plan and "ExistingRDD" not in plan


def test_a_report_reads_only_the_dates_it_needs(spark, tmp_path):
    path = str(tmp_path / "dated")
    weather = testdata.landed(spark, SMALL, "weather").drop("event_date")
    for grain in ("day", "month", "year"):
        date = F.date_trunc(grain, "recorded_at").cast("date")
        weather.withColumn("event_date", date).write.partitionBy("event_date").parquet(path + grain)
        dated = spark.read.parquet(path + grain)
        report = reports.avg_temp_per_device(dated, datetime(2024, 1, 10))
        expected = reports.avg_temp_per_device(weather, datetime(2024, 1, 10))
        assert rows_of(report) == rows_of(expected)
        filters = plan_of(report).split("PartitionFilters: [")[1].split("]")[0]
        assert "event_date" in filters


def test_winner_is_reduced_before_the_shuffle(spark):
    orders = testdata.landed(spark, SMALL, "orders")
    plan = plan_of(keyed.first_per_key(orders, "order_id", ["created_at"]))
    assert plan.count("Exchange") == 1 and "partial_min" in plan


def test_keyed_writes_do_not_depend_on_order(spark):
    rows = testdata.landed(spark, SMALL, "logistics")
    order = ["last_update"]
    expected = rows_of(keyed.latest_per_key(rows, "shipment_id", order))
    for seed in (1, 2, 3):
        first = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) == seed % 3)
        rest = rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(3)) != seed % 3).orderBy(F.rand(seed))
        target = keyed.latest_per_key(first, "shipment_id", order)
        assert rows_of(keyed.update_latest(target, rest, "shipment_id", order)) == expected
        # The other way round, the older batch must not win.
        target = keyed.latest_per_key(rest, "shipment_id", order)
        assert rows_of(keyed.update_latest(target, first, "shipment_id", order)) == expected


@pytest.mark.parametrize(
    "topic, topic_filter, expected",
    [
        ("devices/weather/data", "devices/weather/+", True),
        ("devices/weather/status", "devices/weather/+", True),
        ("devices/weather", "devices/weather/+", False),
        ("devices/weather/", "devices/weather/+", True),
        ("devices/weather/a/b", "devices/weather/+", False),
        ("devices/test/data", "devices/weather/+", False),
        ("devices/test/data", "devices/+/+", True),
        ("xdevices/weather/data", "devices/weather/+", False),
        ("devices/weatherXdata", "devices/weather.data", False),
        ("devices/weather/data", "devices/weather/data", True),
    ],
)
def test_topic_filters(spark, topic, topic_filter, expected):
    df = spark.createDataFrame([(topic,)], "topic string")
    assert df.select(topic_matches(F.col("topic"), topic_filter)).first()[0] is expected


def test_unsupported_topic_filters(spark):
    for bad in ("devices/#", "devices/a+"):
        with pytest.raises(ValueError):
            topic_matches(F.col("topic"), bad)


def test_message_matching_two_rules_goes_to_both(spark):
    df = spark.createDataFrame([("devices/weather/data",)], "topic string")
    routes = [routing.Route("devices/+/+", "all"), routing.Route("devices/weather/data", "weather")]
    assert [r["destination"] for r in routing.route(df, routes).collect()] == ["all", "weather"]


def test_ten_thousand_rules_are_met_by_equal_keys(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(12)]

    def filters(n):
        levels = [draw.choice(words) for _ in range(n)]
        return "/".join("+" if draw.random() < 0.4 else level for level in levels)

    rules = [(filters(draw.randint(1, 5)), f"d{i}") for i in range(10_000)]
    rules += [(rules[0][0], "again"), (None, "none"), ("", "empty"), ("+", "one"), ("a//b", "gap"), ("a/+/b", "any")]
    topics = ["/".join(draw.choice(words) for _ in range(draw.randint(1, 6))) for _ in range(60)]
    topics += ["a//b", "a/x/b", "/", "", "w1/", "+", "a/+/b", None]
    messages = spark.createDataFrame([(t, i, "old") for i, t in enumerate(topics)], "topic string, n int, destination string")
    table = spark.createDataFrame(rules, "topic_filter string, destination string")
    routed = routing.route_by_table(messages, table)
    assert routed.columns == ["topic", "n", "destination"]
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "hashpartitioning(_levels" not in plan.split("BroadcastExchange")[0]  # messages stay

    def matches(rule, topic):
        if rule is None or topic is None:
            return False
        a, b = rule.split("/"), topic.split("/")
        return len(a) == len(b) and all(x == y and x != "+" or x == "+" and y for x, y in zip(a, b))

    expected = sorted((n, d) for n, t in enumerate(topics) for rule, d in rules if matches(rule, t))
    assert sorted((r["n"], r["destination"]) for r in routed.collect()) == expected and len(expected) > 5000
    assert routing.route_by_table(messages, table.limit(0)).count() == 0
    few = routing.routes_table(spark, [routing.Route("a/+/b", "x")])
    found = {topics[r["n"]] for r in routing.route_by_table(messages, few).collect()}
    assert found == {"a/x/b", "a/+/b"}


def test_unknown_fields_are_kept_and_can_be_asked_for(spark):
    spec = get_spec("weather")
    texts = [
        '{"message_id":"m","temperature":1.5,"timestamp":"1000","battery":{"volts":[3.1,3.3]},"note":null}',
        '{"message_id":5,"humidity":"wet"}', "[1]", '"text"', "null", "not json", None, "{}",
    ]
    messages = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, offset int")
    parsed = open_fields.parse_open(messages, spec, ["offset"])
    assert parsed.columns == [*spec.wire_schema.names, "extra_fields", "source_offset"]
    plan = parsed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parse_json") <= 2  # once in the plan's tree, once in its details
    found = {
        r["source_offset"]: r
        for r in parsed.withColumn("volts", open_fields.extra_field("battery.volts[1]", "double")).collect()
    }
    assert (found[0]["message_id"], found[0]["temperature"], found[0]["timestamp"]) == ("m", 1.5, 1000)
    assert json.loads(found[0]["extra_fields"]) == {"battery": {"volts": [3.1, 3.3]}, "note": None}
    assert found[0]["volts"] == 3.3 and found[1]["volts"] is None
    assert found[1]["message_id"] == "5" and found[1]["humidity"] is None is found[1]["extra_fields"]
    assert all(set(found[i].asDict().values()) == {None, i} for i in range(2, len(texts)))


def test_routing_rules_cover_the_datasets():
    pairs = {tuple(r) for r in routing.wildcard_routes(all_specs()) if r.destination.startswith("iot-")}
    assert pairs == {
        ("devices/weather/+", "iot-weather-data"),
        ("devices/orders/+", "iot-orders-events"),
        ("devices/logistics/+", "iot-logistics-dispatch"),
        ("devices/inventory/+", "iot-inventory-changes"),
        ("devices/users/+", "iot-users-activity"),
    }


def test_lag_is_elapsed_time_not_the_seconds_field(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 2, 0, 0, 10), datetime(2024, 1, 1))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert df.select(seconds_between(F.col("a"), F.col("b"))).first()[0] == 86410.0


def test_as_of_can_be_given(spark):
    weather = testdata.landed(spark, SMALL, "weather")
    some = reports.avg_temp_per_device(weather, datetime(2024, 1, 10)).collect()
    count = weather.where("recorded_at > timestamp_ntz'2024-01-09'").count()
    assert sum(r["readings"] for r in some) == count
    orders = testdata.landed(spark, SMALL, "orders")
    assert reports.revenue_top_customers(orders, as_of=datetime(2050, 1, 1)).count() == 0


def test_empty_tables(spark):
    tables = {
        get_spec(kind).table: testdata.landed(spark, SMALL, kind).where("false") for kind in KINDS
    }
    assert monitoring.data_freshness(tables).count() == 0
    assert [r["row_count"] for r in monitoring.table_counts_long(tables).collect()] == [0] * 5
    assert list(monitoring.table_counts_row(tables).first()) == [0] * 5
    assert reports.avg_temp_per_device(tables["weather_data"]).count() == 0


def test_reports_push_down_to_the_table(spark, tmp_path):
    path = str(tmp_path / "weather_data")
    testdata.landed(spark, SMALL, "weather").write.parquet(path)
    weather = spark.read.parquet(path)
    plan = plan_of(reports.avg_temp_per_device(weather, datetime(2024, 1, 10)))
    assert "GreaterThan(recorded_at,2024-01-09T00:00" in plan
    assert "ReadSchema: struct<device_id:string,temperature:decimal(5,2),recorded_at:timestamp_ntz>" in plan
    plan = plan_of(monitoring.with_prefix(weather, "device_id", "weather-sensor-0"))
    assert "StringStartsWith(device_id,weather-sensor-0)" in plan
    assert "TakeOrderedAndProject" in plan_of(monitoring.latest_rows(weather, "message_id", 5))


def test_describe_has_the_usual_statistics(spark):
    weather = testdata.landed(spark, SMALL, "weather")
    usual = {r["summary"]: r for r in weather.describe("temperature", "humidity").collect()}
    for row in monitoring.describe_numeric(weather, ["temperature", "humidity"]).collect():
        name = row["column_name"]
        assert row["n"] == int(usual["count"][name])
        for ours, theirs in (("mean", "mean"), ("stddev", "stddev"), ("min", "min"), ("max", "max")):
            assert row[ours] == pytest.approx(float(usual[theirs][name]), rel=1e-5)


def test_take_messages_in_log_order(spark):
    messages = testdata.messages(spark, SMALL, "weather")
    taken = take_messages(messages, 3).collect()
    assert [(r["partition"], r["offset"]) for r in taken] == [(0, 0), (0, 1), (0, 2)]


def test_kafka_options():
    assert kafka_options("t") == {
        "kafka.bootstrap.servers": "kafka:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": "50000",
    }
    assert kafka_options("t", "b:1", min_partitions=64)["minPartitions"] == "64"
    assert kafka_options("t", starting_offsets="earliest")["startingOffsets"] == "earliest"


def test_bounded_kafka_options():
    whole = bounded_kafka_options("t")
    assert (whole["startingOffsets"], whole["endingOffsets"]) == ("earliest", "latest")
    assert whole["failOnDataLoss"] == "true" and "maxOffsetsPerTrigger" not in whole
    part = bounded_kafka_options("t", {1: (5, 9), 0: (0, 3)})
    assert json.loads(part["assign"]) == {"t": [0, 1]} and "subscribe" not in part
    assert json.loads(part["startingOffsets"]) == {"t": {"0": 0, "1": 5}}
    assert json.loads(part["endingOffsets"]) == {"t": {"0": 3, "1": 9}}


@pytest.mark.parametrize("pick", [keyed.first_per_key, keyed.latest_per_key])
def test_rows_without_a_key_all_stay(spark, pick):
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 1), (None, 1), (None, 2)], "k string, t int")
    found = sorted((r["k"] or "", r["t"]) for r in pick(rows, "k", ["t"]).collect())
    kept = 1 if pick is keyed.first_per_key else 2
    assert found == [("", 1), ("", 1), ("", 2), ("a", kept)]


class Recorder:
    """Stands in for Spark's reader and writer and notes what it is told."""

    def __init__(self):
        self.told = {}
        self.read = self.write = self

    def format(self, name):
        self.told["format"] = name
        return self

    def options(self, **options):
        self.told.update(options)
        return self

    def option(self, name, value):
        self.told[name] = value
        return self

    def mode(self, name):
        self.told["mode"] = name
        return self

    def load(self):
        return self

    save = load


def test_jdbc_options():
    reader = Recorder()
    read_jdbc(reader, "jdbc:x", "t", split_column="id", lower=0, upper=100, partitions=8, user="u")
    assert reader.told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "user": "u", "partitionColumn": "id",
        "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    with pytest.raises(ValueError):
        read_jdbc(Recorder(), "jdbc:x", "t", split_column="id")
    writer = Recorder()
    append_jdbc(writer, "jdbc:x", "t", connections=4, user="u")
    assert writer.told == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "t", "batchsize": "1000", "user": "u",
        "numPartitions": 4, "mode": "append",
    }


def test_session_settings(spark):
    assert configure(spark).conf.get("spark.sql.session.timeZone") == "UTC"
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_a_new_kind_needs_only_a_spec(spark, tmp_path):
    spec = MACHINE_METRICS
    lines = testdata.machine_messages(spark, SMALL, spec).selectExpr("CAST(value AS STRING) AS value")
    lines.write.text(str(tmp_path / "in"))
    job = Warehouse(spark, str(tmp_path)).job(
        spec, stream_text(spark, str(tmp_path / "in")), max_age_ms=None
    )
    start_ingest(job, {"availableNow": True}).awaitTermination()
    tables = Warehouse(spark, str(tmp_path)).tables([spec])
    expected = (
        testdata.table(spark, SMALL, "events").where("value <= 100 AND event_id % 103 <= 100").count()
    )
    assert tables["machine_metrics"].count() == expected > 0


def test_registry():
    try:
        assert get_spec(register(MACHINE_METRICS).name) is MACHINE_METRICS
        assert MACHINE_METRICS in all_specs()
    finally:
        specs._SPECS.pop("machine_metrics")
    assert len(all_specs()) == 5


def test_a_spec_must_be_consistent():
    with pytest.raises(ValueError, match="key"):
        DatasetSpec(
            name="x", topic="x", table="x", wire_schema=wire(a=StringType()),
            columns=(TableColumn("a", "a", "string"),), key="key", event_time="a",
        )
    with pytest.raises(KeyError, match="nothing"):
        get_spec("nothing")


def test_strings_as_messages(spark):
    assert strings(spark, ["a", None]).collect() == [("a",), (None,)]


def test_footers_answer_counts_and_newest_without_columns(spark, tmp_path):
    rows = spark.sql(
        "SELECT id, timestamp_ntz'2024-05-01 00:00:00.5' + make_interval(0, 0, 0, 0, 0, 0, id) AS ingested_at, "
        "CAST(id % 3 AS INT) AS event_date FROM range(1000)"
    )
    rows.write.partitionBy("event_date").parquet(f"{tmp_path}/full")
    rows.filter("id < 0").write.parquet(f"{tmp_path}/empty")
    some = F.when(F.col("id") == 1, F.col("ingested_at"))
    rows.filter("id < 3").coalesce(1).withColumn("ingested_at", some).write.parquet(f"{tmp_path}/nulls")
    tables = footers.open_tables(spark, {n: f"{tmp_path}/{n}" for n in ("full", "empty", "nulls")})
    counts = monitoring.table_counts_long(tables)
    assert [(r.table_name, r.row_count) for r in counts.collect()] == [("empty", 0), ("full", 1000), ("nulls", 3)]
    newest = {name: footers.max_ingested(df) for name, df in tables.items()}
    expected = datetime(2024, 5, 1, 0, 16, 39, 500000)
    assert {n: df.first()[0] for n, df in newest.items()} == {
        "full": expected, "empty": None, "nulls": datetime(2024, 5, 1, 0, 0, 1, 500000)
    }
    fresh = monitoring.data_freshness(footers.newest(tables), datetime(2024, 5, 1, 0, 16, 49, 500000))
    assert sorted((r.table_name, r.lag_seconds) for r in fresh.collect()) == [("full", 10.0), ("nulls", 1008.0)]
    for report, pushed in ((monitoring.count_rows(tables["full"]), "COUNT(*)"), (newest["full"], "MAX(ingested_at)")):
        plan = report._jdf.queryExecution().toString()
        assert f"PushedAggregation: [{pushed}]" in plan
    # The caller's session reads as before.
    assert "PushedAggregation" not in spark.read.parquet(f"{tmp_path}/full").groupBy().count()._jdf.queryExecution().toString()
    spark.range(2).select("id", F.array("id").alias("items")).write.parquet(f"{tmp_path}/nested")
    with pytest.raises(ValueError, match="nested"):
        footers.open_tables(spark, {"nested": f"{tmp_path}/nested"})
