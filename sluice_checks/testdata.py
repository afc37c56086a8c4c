"""The given test tables as device messages and as landed tables.

``messages`` wraps each row of a table into the JSON message it stands for, with the
columns of a Kafka record; ``landed`` gives the same rows as the table a finished
ingest leaves. Both select only. Every message is built from one row, so no group of
rows is ever gathered into one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.transform import conform, project
from sluice.session import configure
from sluice.specs import PAGES, PRODUCTS, DatasetSpec, get_spec

# A product that is not listed; some orders start with it.
UNLISTED = "Lever-Q"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _uuid(number: Column) -> Column:
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(number.cast("string"), 12, "0"))


def _hash_uuid(text: Column) -> Column:
    digest = F.md5(text)
    return F.concat_ws("-", *[F.substring(digest, at, n)
                              for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def _weather(rows: DataFrame) -> DataFrame:
    n = F.col("event_id")
    return rows.select(
        _uuid(n).alias("message_id"),
        F.format_string("weather-sensor-%02d", F.col("user_id") % 10 + 1).alias("device_id"),
        F.col("value").alias("temperature"),
        (n % 101).cast("int").alias("humidity"),
        (950 + n % 101).cast("double").alias("pressure"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
        n.alias("_n"),
        F.floor(n / 2).alias("_offset"),
    )


def _user_events(rows: DataFrame) -> DataFrame:
    n = F.col("event_id")
    user = F.col("user_id").cast("string")
    return rows.select(
        _uuid(n).alias("message_id"),
        F.col("user_id").cast("int").alias("user_id"),
        "event_type",
        F.element_at(F.array(*map(F.lit, PAGES)), (n % 6 + 1).cast("int")).alias("page"),
        F.concat_ws("-", F.lit("sess"), user, F.to_date("ts").cast("string")).alias("session_id"),
        F.get_json_object("props", "$.k").alias("event_value"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
        n.alias("_n"),
        F.floor(n / 2).alias("_offset"),
    )


def _orders(rows: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")

    def quantity(i: Column) -> Column:
        return ((key + i) % 5 + 1).cast("int")

    def cents(i: Column) -> Column:
        return 1000 + (F.col("o_custkey") * 37 + key + i * 1009) % 9001

    def item(i: Column) -> Column:
        listed = F.element_at(F.array(*map(F.lit, PRODUCTS)), quantity(i))
        unlisted = (key % 89 == 5) & (i == 1)
        return F.struct(
            F.when(unlisted, UNLISTED).otherwise(listed).alias("product"),
            quantity(i).alias("quantity"),
            (cents(i) / 100.0).alias("price"),
        )

    count = (key % 11).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(
        F.array().cast("array<int>")
    )
    items = F.transform(numbers, item)
    total = F.aggregate(
        numbers, F.lit(0).cast("long"), lambda acc, i: acc + quantity(i) * cents(i)
    )
    return rows.select(
        _uuid(key).alias("order_id"),
        F.col("o_custkey").cast("int").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "delivered")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("confirmed")
        .alias("status"),
        items.alias("items"),
        F.when(F.col("o_orderstatus") == "O", total / 100.0)
        .otherwise(F.col("o_totalprice"))
        .alias("total_amount"),
        _epoch_ms(F.col("o_orderdate")).alias("timestamp"),
        key.alias("_n"),
        F.floor(key / 2).alias("_offset"),
    )


def _logistics(rows: DataFrame) -> DataFrame:
    key = F.col("l_orderkey")
    return rows.select(
        _uuid(key).alias("shipment_id"),
        _uuid(key).alias("order_id"),
        F.when(F.col("l_linestatus") == "O", "in_transit").otherwise("delivered").alias("status"),
        F.struct(
            ((40000 + F.col("l_partkey") % 1000) / 1000.0).alias("latitude"),
            ((-74000 + F.col("l_suppkey") % 1000) / 1000.0).alias("longitude"),
        ).alias("current_location"),
        F.concat(F.lit("SUPP-"), F.col("l_suppkey").cast("string")).alias("origin"),
        F.concat(F.lit("LINE-"), F.col("l_linenumber").cast("string")).alias("destination"),
        _epoch_ms(F.col("l_shipdate")).alias("timestamp"),
        key.alias("_n"),
        (key * 8 + F.col("l_linenumber")).alias("_offset"),
    )


def _inventory(rows: DataFrame) -> DataFrame:
    line = F.concat_ws(
        "|",
        *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        *[F.col(c).cast("decimal(18,2)").cast("string")
          for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        "l_returnflag",
        "l_linestatus",
        _epoch_ms(F.col("l_shipdate")).cast("string"),
    )
    returned = F.col("l_returnflag") == "R"
    quantity = F.col("l_quantity").cast("int")
    return rows.select(
        _hash_uuid(line).alias("message_id"),
        F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")).alias("item_sku"),
        F.concat(F.lit("WH"), (F.col("l_suppkey") % 4 + 1).cast("string")).alias("warehouse_id"),
        F.when(returned, quantity).otherwise(-quantity).alias("quantity_delta"),
        F.when(returned, "return").otherwise("sale").alias("change_reason"),
        _epoch_ms(F.col("l_shipdate")).alias("timestamp"),
        F.col("l_orderkey").alias("_n"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("_offset"),
    )


_KINDS = {
    "weather": ("events", _weather),
    "orders": ("orders", _orders),
    "logistics": ("lineitem", _logistics),
    "inventory": ("lineitem", _inventory),
    "user_events": ("events", _user_events),
}

# The broker stamps a message 0.25 s to 29.25 s after the event.
_ARRIVAL = "timestamp_millis(timestamp + _n % 30 * 1000 + 250)"


def spread(df: DataFrame) -> DataFrame:
    """Scanned rows over all cores, where the files have fewer splits than that.

    The given tables are single row groups, which one task would encode and parse
    alone. A scan with at least one split per core is left as it is.
    """
    return df.repartition(_cores(df)) if _few_splits(df) else df


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def _few_splits(scan: DataFrame) -> bool:
    return scan.rdd.getNumPartitions() < _cores(scan)


# Messages of one batch that a task parses and keeps: some 70 MB to 250 MB.
ROWS_PER_TASK = 250_000


def in_tasks(stream: DataFrame, rows: int) -> DataFrame:
    """A stream's batch of ``rows`` over all cores, and over more tasks as it grows.

    Parsed rows take many times the room of their files, and splits do not cut row groups.
    """
    return stream.repartition(max(_cores(stream), -(-rows // ROWS_PER_TASK)))


def wire_rows(rows: DataFrame, kind: str) -> DataFrame:
    """The wire fields of every message of ``kind``, one per table row, before encoding."""
    return _KINDS[kind][1](rows)


def source_rows(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return table(spark, sf_dir, _KINDS[kind][0])


def messages(
    spark: SparkSession, sf_dir: str, kind: str, damaged: bool = False, evenly: bool = True
) -> DataFrame:
    """All messages of ``kind`` as Kafka records, spread for parsing if ``evenly``."""
    rows = source_rows(spark, sf_dir, kind)
    return encoded(spread(rows) if evenly else rows, kind, damaged)


def stream_messages(
    spark: SparkSession, sf_dir: str, kind: str, damaged: bool = False
) -> DataFrame:
    """The same messages as a stream that starts with the table's file."""
    name = _KINDS[kind][0]
    scan = table(spark, sf_dir, name)
    rows = (
        spark.readStream.schema(scan.schema)
        .option("pathGlobFilter", f"{name}.parquet")
        .parquet(sf_dir)
    )
    return encoded(in_tasks(rows, scan.count()), kind, damaged)


PARTS = 3
# Some messages come 20 hours late, which a delay of a day allows for, and some three days.
LATENESS = "CASE WHEN _n % 7 = 1 THEN 259200000 WHEN _n % 5 = 0 THEN 72000000 ELSE 0 END"


def in_parts(
    spark: SparkSession, sf_dir: str, kind: str, damaged: bool = False
) -> DataFrame:
    """All messages of ``kind`` with the ``part`` they come in, one after the other by time."""
    rows = source_rows(spark, sf_dir, kind)
    first, last = wire_rows(rows, kind).agg(F.min("timestamp"), F.max("timestamp")).first()
    if first is None:
        first = last = 0
    part = f"({PARTS} * (timestamp - {first} + {LATENESS})) DIV ({last - first + 1})"
    part = F.expr(f"least({part}, {PARTS - 1})").alias("part")
    return encoded(spread(rows), kind, damaged, [part])


def encoded(
    rows: DataFrame, kind: str, damaged: bool = False, also: Sequence[Column] = ()
) -> DataFrame:
    """Table rows as the messages they stand for, with more columns on their wire fields.

    With ``damaged``, some are spoilt in the ways brokers and devices spoil them: not
    JSON, cut short, empty, time in quotes, key missing, or an unknown field added.
    """
    spec = get_spec(kind)
    body = F.to_json(F.struct(*spec.wire_schema.names), {"ignoreNullFields": "false"})
    if damaged:
        defect = F.col("_n") % 97
        body = (
            F.when(defect == 0, F.lit("not json"))
            .when(defect == 1, F.substring(body, F.lit(1), F.length(body) - 1))
            .when(defect == 2, F.lit(None).cast("string"))
            .when(defect == 3, F.regexp_replace(body, '"timestamp":(\\d+)', '"timestamp":"$1"'))
            .when(defect == 4, F.regexp_replace(body, f'^\\{{"{spec.key}":', '{"other":'))
            .when(defect == 5, F.regexp_replace(body, "^\\{", '{"extra":1,'))
            .otherwise(body)
        )
    return wire_rows(rows, kind).select(
        F.format_string("device-%d", F.col("_n") % 10).cast("binary").alias("key"),
        body.cast("binary").alias("value"),
        F.lit(spec.topic).alias("topic"),
        (F.col("_n") % 2).cast("int").alias("partition"),
        F.col("_offset").cast("long").alias("offset"),
        F.expr(_ARRIVAL).alias("timestamp"),
        *also,
    )


def landed(spark: SparkSession, sf_dir: str, kind: str, evenly: bool = False) -> DataFrame:
    """The table a finished ingest of ``messages`` holds (before de-duplication).

    ``evenly`` spreads it for reports that do much work per row.
    """
    spec = get_spec(kind)
    rows = source_rows(spark, sf_dir, kind)
    wire = wire_rows(spread(rows) if evenly else rows, kind)
    return conform(project(wire, spec, F.expr(_ARRIVAL)), spec)


def device_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as devices publish them: topic, payload, quality of service, retain flag.

    Each event goes to one of eight topics: the five known ones, another attribute
    of a known device, and two that no rule covers.
    """
    topics = (
        "devices/weather/data",
        "devices/orders/new_order",
        "devices/logistics/dispatch",
        "devices/inventory/change",
        "devices/users/event",
        "devices/weather/status",
        "devices/weather",
        "devices/weather/a/b",
    )
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.element_at(F.array(*map(F.lit, topics)), (n % 8 + 1).cast("int")).alias("topic"),
        F.to_json(F.struct("event_id", "event_type")).alias("payload"),
        F.lit(1).alias("qos"),
        F.lit(False).alias("retain"),
        F.format_string("device-%d", F.col("user_id") % 10).alias("clientid"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def tenant_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of many users' devices, published as devices/<user>/<event type>, and some
    one level deeper."""
    n = F.col("event_id")
    topic = F.concat_ws("/", F.lit("devices"), F.col("user_id").cast("string"), "event_type")
    return table(spark, sf_dir, "events").select(
        F.when(n % 10 == 0, F.concat(topic, F.lit("/raw"))).otherwise(topic).alias("topic"), "event_id"
    )


def tenant_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule or two for each user with events, and one for each type."""
    events = table(spark, sf_dir, "events")
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    users, kinds = events.select("user_id").distinct(), events.select("event_type").distinct()
    per_user = users.where("user_id % 3 = 0").select(
        F.concat(F.lit("devices/"), user, F.lit("/+")), F.concat(F.lit("user-"), user)
    )
    purchases = users.where("user_id % 5 = 0").select(
        F.concat(F.lit("+/"), user, F.lit("/purchase")), F.concat(F.lit("buyer-"), user)
    )
    per_kind = kinds.select(F.concat(F.lit("+/+/"), kind), F.concat(F.lit("type-"), kind))
    raw = kinds.select(F.concat(F.lit("devices/+/"), kind, F.lit("/raw")), F.lit("raw"))
    return per_user.union(purchases).union(per_kind).union(raw).toDF("topic_filter", "destination")


def machine_messages(spark: SparkSession, sf_dir: str, spec: DatasetSpec) -> DataFrame:
    """Messages of a sixth kind: the load of five machines."""
    n = F.col("event_id")
    rows = spread(table(spark, sf_dir, "events")).select(
        _uuid(n).alias("message_id"),
        F.concat(F.lit("machine-0"), (F.col("user_id") % 5 + 1).cast("string")).alias("machine_id"),
        F.col("value").alias("cpu_usage"),
        (n % 103).cast("double").alias("memory_usage"),
        (n % 1001).cast("int").alias("disk_io"),
        _epoch_ms(F.col("ts")).alias("timestamp"),
    )
    return rows.select(F.to_json(F.struct(*spec.wire_schema.names)).cast("binary").alias("value"))
