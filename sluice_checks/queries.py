"""Every operator as a query over the test tables: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import partial, reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from sluice import functions
from sluice.operators import keyed, open_fields, quality, routing, transform
from sluice.plans import footers, monitoring, reports
from sluice.session import freeing_shuffles, shared_dir
from sluice.sinks import (
    AppendTable,
    BucketTable,
    Quarantine,
    StateTable,
    StatsLog,
    export_tables,
    restore_tables,
)
from sluice.sources import take_messages
from sluice.specs import (
    EVENT_TIME,
    LOGISTICS,
    ORDERS,
    USER_EVENTS,
    WEATHER,
    DatasetSpec,
    TableColumn,
    all_specs,
    get_spec,
    wire,
)
from sluice.streaming import (
    IngestJob,
    LateRows,
    ProgressLog,
    Rollup,
    checkpointed_batches,
    dedup_stream,
    keep_late,
    keep_report,
    keep_totals,
    open_windows,
    progress,
    running_stock_stream,
    start_ingest,
    windowed_counts,
)

from . import testdata

Query = Callable[[SparkSession, str], DataFrame]

KINDS = ("weather", "orders", "logistics", "inventory", "user_events")
POSITION = ("partition", "offset", "timestamp")
# The user events are judged as if they arrived at this moment; the age rule is left
# out for the other kinds.
ARRIVED = datetime(2024, 1, 30)
# Freshness is judged as of this moment.
CHECKED = datetime(2030, 1, 1)

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _parsed(spark, sf_dir, kind, *fields):
    messages = testdata.messages(spark, sf_dir, kind)
    return transform.parse(messages, get_spec(kind), fields=fields or None)


def _landed(spark, sf_dir, kind, evenly=False):
    return testdata.landed(spark, sf_dir, kind, evenly)


def _tables(spark, sf_dir):
    return {get_spec(kind).table: _landed(spark, sf_dir, kind) for kind in KINDS}


def _flagged(spark, sf_dir, kind):
    spec = get_spec(kind)
    parsed = transform.parse(
        testdata.messages(spark, sf_dir, kind, damaged=True), spec, POSITION, diagnose=True
    )
    if kind == "user_events":
        return quality.flag(parsed, spec, as_of=ARRIVED)
    return quality.flag(parsed, spec, max_age_ms=None)


# --- sources and routing ---------------------------------------------------------


@query
def read_messages_limit(spark, sf_dir):
    messages = testdata.messages(spark, sf_dir, "weather", evenly=False)
    return take_messages(messages, 20, ("offset", "partition"))


@query
def route_exact(spark, sf_dir):
    routes = routing.exact_routes(all_specs())
    return routing.forwarded(routing.route(testdata.device_messages(spark, sf_dir), routes))


@query
def route_wildcard(spark, sf_dir):
    routes = routing.wildcard_routes(all_specs())
    return routing.forwarded(routing.route(testdata.device_messages(spark, sf_dir), routes))


@query
def route_by_table(spark, sf_dir):
    return routing.route_by_table(
        testdata.tenant_messages(spark, sf_dir), testdata.tenant_rules(spark, sf_dir)
    )


@query
def route_envelope(spark, sf_dir):
    routes = routing.exact_routes(all_specs())
    records = routing.envelope(
        routing.route(testdata.device_messages(spark, sf_dir), routes)
    )
    headers = F.transform("headers", lambda h: F.concat_ws("=", h["key"], h["value"].cast("string")))
    return records.select(
        "topic",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.concat_ws(",", headers).alias("headers"),
    )


# --- parse, project, conform -----------------------------------------------------


@query
def parse_weather(spark, sf_dir):
    return _parsed(spark, sf_dir, "weather")


@query
def parse_orders(spark, sf_dir):
    def as_text(item):
        price = item["price"].cast("decimal(10,2)").cast("string")
        return F.concat_ws(":", item["product"], item["quantity"].cast("string"), price)

    return _parsed(spark, sf_dir, "orders").withColumn(
        "items", F.concat_ws(";", F.transform("items", as_text))
    )


@query
def parse_logistics(spark, sf_dir):
    return _parsed(spark, sf_dir, "logistics").select(
        "shipment_id", "order_id", "status", "current_location.*", "origin", "destination",
        "timestamp",
    )


@query
def parse_inventory(spark, sf_dir):
    return _parsed(spark, sf_dir, "inventory")


@query
def parse_user_events(spark, sf_dir):
    return _parsed(spark, sf_dir, "user_events")


def _ingest(kind: str) -> Query:
    def run(spark, sf_dir):
        messages = testdata.messages(spark, sf_dir, kind)
        return transform.ingest(
            messages, get_spec(kind), F.col("source_timestamp"), ["timestamp"]
        ).drop("source_timestamp")

    return run


def _conform(kind: str) -> Query:
    return lambda spark, sf_dir: transform.conform(_ingest(kind)(spark, sf_dir), get_spec(kind))


def _quarantine(kind: str) -> Query:
    def run(spark, sf_dir):
        return quality.quarantined(_flagged(spark, sf_dir, kind)).select(
            "source_partition", "source_offset", F.concat_ws(",", "errors").alias("errors")
        )

    return run


def _valid(kind: str) -> Query:
    def run(spark, sf_dir):
        spec = get_spec(kind)
        kept = quality.valid(_flagged(spark, sf_dir, kind))
        return transform.conform(transform.project(kept, spec, F.col("source_timestamp")), spec)

    return run


for _kind in KINDS:
    _QUERIES[f"ingest_{_kind}"] = _ingest(_kind)
    _QUERIES[f"conform_{_kind}"] = _conform(_kind)
    _QUERIES[f"quarantine_{_kind}"] = _quarantine(_kind)
    _QUERIES[f"valid_{_kind}"] = _valid(_kind)


@query
def epoch_ms_to_ts(spark, sf_dir):
    return _parsed(spark, sf_dir, "weather", "message_id", "timestamp").select(
        "message_id",
        "timestamp",
        functions.epoch_ms_to_timestamp(F.col("timestamp")).cast("timestamp_ntz").alias("recorded_at"),
    )


@query
def order_item_count(spark, sf_dir):
    return _parsed(spark, sf_dir, "orders", "order_id", "items").select(
        "order_id", functions.item_count(F.col("items")).alias("item_count")
    )


@query
def order_total_check(spark, sf_dir):
    return reports.order_total_check(
        _parsed(spark, sf_dir, "orders", "order_id", "items", "total_amount")
    )


@query
def order_items_exploded(spark, sf_dir):
    return reports.order_items(_parsed(spark, sf_dir, "orders", "order_id", "items"))


@query
def location_text(spark, sf_dir):
    location = functions.location_text(
        F.col("current_location.latitude"), F.col("current_location.longitude")
    )
    parsed = _parsed(spark, sf_dir, "logistics", "shipment_id", "current_location")
    return parsed.select("shipment_id", location.alias("location"))


@query
def filter_startswith(spark, sf_dir):
    return monitoring.with_prefix(
        _landed(spark, sf_dir, "weather"), "device_id", "weather-sensor-0"
    )


@query
def describe_numeric(spark, sf_dir):
    described = monitoring.describe_numeric(
        _landed(spark, sf_dir, "weather"), ["temperature", "humidity", "pressure"]
    )
    return described.withColumn("stddev", F.round("stddev", 6))


# --- reports ---------------------------------------------------------------------


@query
def avg_temp_per_device(spark, sf_dir):
    return reports.avg_temp_per_device(_landed(spark, sf_dir, "weather"))


@query
def revenue_top_customers(spark, sf_dir):
    return reports.revenue_top_customers(_landed(spark, sf_dir, "orders"))


@query
def shipments_in_transit(spark, sf_dir):
    return reports.shipments_in_transit(latest_per_shipment(spark, sf_dir))


@query
def running_stock(spark, sf_dir):
    return reports.running_stock(_landed(spark, sf_dir, "inventory", evenly=True))


@query
def low_stock(spark, sf_dir):
    return reports.low_stock(running_stock(spark, sf_dir))


@query
def session_timeline(spark, sf_dir):
    return reports.session_timeline(
        _landed(spark, sf_dir, "user_events"), 8, "sess-8-2024-01-01"
    )


@query
def stock_by_sku(spark, sf_dir):
    return reports.stock_by_sku(_landed(spark, sf_dir, "inventory"))


@query
def stock_by_reason(spark, sf_dir):
    return reports.stock_by_reason(_landed(spark, sf_dir, "inventory"))


@query
def events_by_user_action(spark, sf_dir):
    return reports.events_by_user_action(_landed(spark, sf_dir, "user_events"))


@query
def events_tumbling(spark, sf_dir):
    return reports.events_tumbling(_landed(spark, sf_dir, "user_events"))


# --- monitoring ------------------------------------------------------------------


@query
def hourly_counts(spark, sf_dir):
    return monitoring.hourly_counts(_landed(spark, sf_dir, "weather"))


@query
def volume_trend(spark, sf_dir):
    return monitoring.volume_trend(_landed(spark, sf_dir, "weather"))


@query
def processing_lag(spark, sf_dir):
    return monitoring.processing_lag(_landed(spark, sf_dir, "weather"))


@query
def data_freshness(spark, sf_dir):
    return monitoring.data_freshness(_tables(spark, sf_dir), CHECKED)


@query
def table_counts_row(spark, sf_dir):
    return monitoring.table_counts_row(_tables(spark, sf_dir))


@query
def table_counts_long(spark, sf_dir):
    return monitoring.table_counts_long(_tables(spark, sf_dir))


@query
def latest_rows(spark, sf_dir):
    return monitoring.latest_rows(_landed(spark, sf_dir, "weather"), WEATHER.key, 5)


@query
def max_ingested(spark, sf_dir):
    return monitoring.max_ingested(_landed(spark, sf_dir, "weather"))


@query
def count_rows(spark, sf_dir):
    return monitoring.count_rows(_landed(spark, sf_dir, "weather"))


def _opened(spark, sf_dir, kinds=KINDS):
    """The landed tables as files, opened for reports from their footers."""
    folder = _new_folder(spark)
    landed = {get_spec(kind).table: _landed(spark, sf_dir, kind) for kind in kinds}
    export_tables(landed, folder)
    return footers.open_tables(spark, {name: f"{folder}/{name}" for name in landed})


@query
def footer_table_counts(spark, sf_dir):
    """Row counts from the footers of the tables' files."""
    return monitoring.table_counts_long(_opened(spark, sf_dir))


@query
def footer_freshness(spark, sf_dir):
    """Newest rows from the footers of the tables' files."""
    return monitoring.data_freshness(footers.newest(_opened(spark, sf_dir)), CHECKED)


@query
def footer_max_ingested(spark, sf_dir):
    return footers.max_ingested(_opened(spark, sf_dir, ["weather"])[WEATHER.table])


@query
def offsets_by_partition(spark, sf_dir):
    return monitoring.offsets_by_partition(
        testdata.messages(spark, sf_dir, "weather", evenly=False)
    )


# --- validation ------------------------------------------------------------------


@query
def non_null_ratio(spark, sf_dir):
    damaged = testdata.messages(spark, sf_dir, "weather", damaged=True)
    return quality.non_null_ratios(transform.parse(damaged, WEATHER), min_ratio=0.96)


def _violations(spark, sf_dir, rules_of):
    """Violations per rule over all kinds, decoding only the fields the rules look at."""
    frames = []
    for kind in KINDS:
        rules = rules_of(get_spec(kind))
        if rules:
            fields = {label.split(":")[1].split(".")[0] for label, _ in rules}
            frames.append(
                quality.count_violations(_parsed(spark, sf_dir, kind, *fields), kind, rules)
            )
    return reduce(DataFrame.unionByName, frames)


@query
def range_violations(spark, sf_dir):
    return _violations(spark, sf_dir, quality.range_rules)


@query
def domain_violations(spark, sf_dir):
    return _violations(spark, sf_dir, quality.domain_rules)


@query
def stale_messages(spark, sf_dir):
    return (
        _parsed(spark, sf_dir, "user_events", "message_id", "timestamp")
        .where(quality.stale(ARRIVED))
        .select("message_id", "timestamp")
    )


# --- keyed writes ----------------------------------------------------------------


def _later(df, interval):
    return df.withColumn("ingested_at", F.col("ingested_at") + F.expr(f"INTERVAL {interval}"))


@query
def orders_dedup(spark, sf_dir):
    orders = _landed(spark, sf_dir, "orders", evenly=True)
    return reports.orders_dedup(orders.unionByName(_later(orders, "1 hour")))


@query
def insert_if_absent(spark, sf_dir):
    """Delivered orders are in the table; then every order comes in twice."""
    orders = _landed(spark, sf_dir, "orders", evenly=True)
    target = orders.where(F.col("order_status") == "delivered")
    batch = _later(orders, "1 day").unionByName(_later(orders, "2 days"))
    return keyed.insert_if_absent(target, batch, ORDERS.key, [ORDERS.event_time])


@query
def latest_per_shipment(spark, sf_dir):
    return keyed.latest_per_key(
        _landed(spark, sf_dir, "logistics", evenly=True), LOGISTICS.key, [LOGISTICS.event_time]
    )


@query
def update_latest(spark, sf_dir):
    """Delivered shipments are in the table; then the updates of those in transit come in."""
    rows = _landed(spark, sf_dir, "logistics", evenly=True)
    order = [LOGISTICS.event_time]
    in_transit = F.col("shipment_status") == "in_transit"
    target = keyed.latest_per_key(rows.where(~in_transit), LOGISTICS.key, order)
    return keyed.update_latest(target, rows.where(in_transit), LOGISTICS.key, order)


@query
def user_events_dedup(spark, sf_dir):
    events = _landed(spark, sf_dir, "user_events", evenly=True)
    again = events.unionByName(_later(events, "1 minute"))
    return keyed.first_per_key(again, USER_EVENTS.key, [USER_EVENTS.event_time, "ingested_at"])


@query
def export_restore(spark, sf_dir):
    folder = _new_folder(spark)
    export_tables({"sales_orders": _landed(spark, sf_dir, "orders")}, folder)
    return restore_tables(spark, folder, ["sales_orders"])["sales_orders"]


# A kind the library does not know, to show that its record is all it takes.
MACHINE_METRICS = DatasetSpec(
    name="machine_metrics",
    topic="iot.machine.metrics",
    table="machine_metrics",
    wire_schema=wire(
        message_id=StringType(),
        machine_id=StringType(),
        cpu_usage=DoubleType(),
        memory_usage=DoubleType(),
        disk_io=IntegerType(),
        timestamp=LongType(),
    ),
    columns=(
        TableColumn("message_id", "message_id", "string", uuid=True),
        TableColumn("machine_id", "machine_id", "string", max_length=50),
        TableColumn("cpu_usage", "cpu_usage", "decimal(5,2)"),
        TableColumn("memory_usage", "memory_usage", "decimal(5,2)"),
        TableColumn("disk_io", "disk_io", "int"),
        TableColumn("recorded_at", EVENT_TIME, "timestamp_ntz"),
    ),
    key="message_id",
    event_time="recorded_at",
    required=("message_id", "machine_id", "timestamp"),
    ranges={"cpu_usage": (0, 100), "memory_usage": (0, 100)},
)


@query
def ingest_new_kind(spark, sf_dir):
    spec = MACHINE_METRICS
    messages = testdata.machine_messages(spark, sf_dir, spec)
    flagged = quality.flag(transform.parse(messages, spec, diagnose=True), spec, max_age_ms=None)
    landed = transform.conform(transform.project(quality.valid(flagged), spec), spec)
    return landed.drop("ingested_at")


@query
def ingest_open_fields(spark, sf_dir):
    """Weather messages, some with a field or a key of another name, landed with what is new."""
    messages = testdata.messages(spark, sf_dir, "weather", damaged=True)
    parsed = open_fields.parse_open(messages, WEATHER)
    rows = transform.conform(transform.project(parsed, WEATHER, keep=[open_fields.EXTRA]), WEATHER)
    table = AppendTable(spark, _new_folder(spark), WEATHER, grain="month", null_key="append")
    table.write(rows.where(F.col("device_id").isNotNull()))
    return table.read().select(
        "message_id", "device_id", "temperature", "recorded_at", open_fields.EXTRA,
        open_fields.extra_field("extra", "int").alias("extra"),
    )


# --- streams ---------------------------------------------------------------------
# Each takes the whole table as a stream until all of it is processed, and gives what
# the sink then holds. Tables and checkpoints go to a new part of the shared folder.


def _new_folder(spark) -> str:
    return f"{shared_dir(spark)}/sluice-{uuid.uuid4().hex}"


def _stream_job(spark, sf_dir, kind, folder, damaged=False, sink=None):
    spec = get_spec(kind)
    sink = sink or (StateTable if spec.policy == "update" else AppendTable)
    return IngestJob(
        spec,
        testdata.stream_messages(spark, sf_dir, kind, damaged),
        sink(spark, f"{folder}/table", spec),
        f"{folder}/checkpoint",
        Quarantine(f"{folder}/quarantine"),
        StatsLog(f"{folder}/stats"),
        max_age_ms=None,
    )


def _run(job):
    running = start_ingest(job, {"availableNow": True})
    running.awaitTermination()
    return running


def _append_stream(df, folder):
    """What an append-mode stream of ``df`` writes until its input is used up."""
    query = (
        df.writeStream.format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{folder}/out")
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


@query
def stream_insert_if_absent(spark, sf_dir):
    """Weather messages, some damaged, into their table; then all of them once more."""
    folder = _new_folder(spark)
    job = _stream_job(spark, sf_dir, "weather", folder, damaged=True)
    _run(job)
    _run(replace(job, checkpoint=f"{folder}/checkpoint-lost"))
    return job.table.read().drop("event_date", "ingested_at")


@query
def stream_insert_bucketed(spark, sf_dir):
    """The same into a table in buckets, which looks keys up in all it holds."""
    folder = _new_folder(spark)
    job = _stream_job(spark, sf_dir, "weather", folder, damaged=True, sink=BucketTable)
    _run(job)
    _run(replace(job, checkpoint=f"{folder}/checkpoint-lost"))
    return job.table.read().drop("ingested_at")


@query
def stream_insert_filtered(spark, sf_dir):
    """The same, looking keys up as for batches whose keys are too many to be sent around."""
    folder = _new_folder(spark)
    sink = partial(AppendTable, grain="month", broadcast_bytes=0)
    job = _stream_job(spark, sf_dir, "weather", folder, damaged=True, sink=sink)
    _run(job)
    _run(replace(job, checkpoint=f"{folder}/checkpoint-lost"))
    return job.table.read().drop("event_date", "ingested_at")


@query
def stream_update_latest(spark, sf_dir):
    job = _stream_job(spark, sf_dir, "logistics", _new_folder(spark))
    _run(job)
    return job.table.read().drop("ingested_at")


@query
def stream_quarantine(spark, sf_dir):
    job = _stream_job(spark, sf_dir, "weather", _new_folder(spark), damaged=True)
    _run(job)
    return job.quarantine.read(spark).select(
        "source_partition", "source_offset", F.concat_ws(",", "errors").alias("errors")
    )


@query
def stream_stats(spark, sf_dir):
    job = _stream_job(spark, sf_dir, "weather", _new_folder(spark), damaged=True)
    _run(job)
    return job.stats.read(spark).groupBy("metric_name").agg(
        F.sum("metric_value").alias("metric_value")
    )


@query
def stream_progress(spark, sf_dir):
    """Rows read and the last batch of a stream that has caught up, each message read once."""
    job = _stream_job(spark, sf_dir, "weather", _new_folder(spark))
    reported = progress(spark, [_run(job)]).select("query", "input_rows")
    recorded = checkpointed_batches(spark, {job.spec.name: job.checkpoint})
    return reported.join(recorded.withColumnRenamed("job", "query"), "query")


def _event_stream(spark, sf_dir):
    messages = testdata.stream_messages(spark, sf_dir, "user_events")
    return transform.conform(
        transform.ingest(messages, USER_EVENTS, F.col("source_timestamp"), ["timestamp"]),
        USER_EVENTS,
    ).drop("source_timestamp")


@query
def stream_events_tumbling(spark, sf_dir):
    """Windows that are closed once all events are in: they end a day before the last one."""
    counts = windowed_counts(_event_stream(spark, sf_dir))
    return _append_stream(counts, _new_folder(spark))


@query
def stream_open_windows(spark, sf_dir):
    """The windows that are not closed once all events are in, from the stream's state."""
    folder = _new_folder(spark)
    _append_stream(windowed_counts(_event_stream(spark, sf_dir)), folder)
    return open_windows(spark, f"{folder}/checkpoint")


@query
def stream_dedup(spark, sf_dir):
    events = _event_stream(spark, sf_dir)
    twice = events.unionByName(events)
    return _append_stream(
        dedup_stream(twice, USER_EVENTS.key, USER_EVENTS.event_time), _new_folder(spark)
    )


# --- streams whose messages come in three parts, some of them late ---------------------------


ONCE = {"availableNow": True}


def _in_parts(spark, sf_dir, kind, folder, start, damaged=False, held=True):
    """Run ``start(messages)`` until its input is used up, after each part that comes in.

    A part makes room for the next one, which the stream knows from it by the files' names.
    Streams of which no task holds its rows (``held`` off) take them as the files have them.
    """
    messages = testdata.in_parts(spark, sf_dir, kind, damaged)
    schema = messages.drop("part").schema
    for part in range(testdata.PARTS):
        come = messages.where(F.col("part") == part).drop("part")
        come.write.mode("overwrite").options(
            compression="zstd", maxRecordsPerFile=testdata.ROWS_PER_TASK
        ).parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        if held:
            there = spark.read.schema(schema).parquet(f"{folder}/in").count()
            stream = testdata.in_tasks(stream, there)
        with freeing_shuffles(spark):
            start(stream).awaitTermination()


def _landed_stream(messages, kind):
    """The stream's messages as rows of their table."""
    spec = get_spec(kind)
    landed = transform.ingest(messages, spec, F.col("source_timestamp"), ["timestamp"])
    return transform.conform(landed, spec).drop("source_timestamp")


@query
def stream_running_stock(spark, sf_dir):
    """Stock after each change that the watermark has passed, but for changes behind it."""
    folder = _new_folder(spark)

    def start(messages):
        stock = running_stock_stream(_landed_stream(messages, "inventory"))
        return keep_totals(stock, f"{folder}/out", f"{folder}/checkpoint", ONCE)

    _in_parts(spark, sf_dir, "inventory", folder, start, held=False)
    return spark.read.parquet(f"{folder}/out").drop("ingested_at")


@query
def stream_late_events(spark, sf_dir):
    """The user events that come in more than a day behind the newest one before."""
    folder = _new_folder(spark)
    late = LateRows(f"{folder}/late", USER_EVENTS.event_time)

    def start(messages):
        rows = _landed_stream(messages, "user_events")
        return keep_late(rows, late, f"{folder}/checkpoint", ONCE)

    _in_parts(spark, sf_dir, "user_events", folder, start)
    return late.read(spark)


class _FailsOnce:
    """A report's table whose second write is reported as failed after it was done."""

    def __init__(self, rollup: Rollup) -> None:
        self.rollup, self.writes = rollup, 0

    def write(self, totals, batch_id):
        self.rollup.write(totals, batch_id)
        self.writes += 1
        if self.writes == 2:
            raise RuntimeError("lost contact after writing")


def _kept_report(spark, sf_dir, kind, report, keys):
    """A report kept by a stream over three parts, of which the second is written twice."""
    folder = _new_folder(spark)
    rollup = Rollup(spark, f"{folder}/report", keys, buckets=8)
    sink = _FailsOnce(rollup)

    def start(messages):
        kept_up = report(_landed_stream(messages, kind))
        running = keep_report(kept_up, sink, f"{folder}/checkpoint", ONCE)
        try:
            running.awaitTermination()
        except StreamingQueryException:
            running = keep_report(kept_up, sink, f"{folder}/checkpoint", ONCE)
        return running

    _in_parts(spark, sf_dir, kind, folder, start)
    return rollup.read()


@query
def stream_stock_by_sku(spark, sf_dir):
    return _kept_report(
        spark, sf_dir, "inventory", reports.stock_by_sku, ["item_sku", "warehouse_id"]
    )


@query
def stream_events_by_user_action(spark, sf_dir):
    return _kept_report(
        spark, sf_dir, "user_events", reports.events_by_user_action, ["user_id", "event_type"]
    )


@query
def stream_hourly_counts(spark, sf_dir):
    return _kept_report(spark, sf_dir, "weather", monitoring.counts_per_hour, ["hour"])


@query
def stream_progress_log(spark, sf_dir):
    """What each batch of an ingest stream reported: all rows, and those of each outcome."""
    folder = _new_folder(spark)
    log = ProgressLog(spark, f"{folder}/log")
    table = AppendTable(spark, f"{folder}/table", WEATHER, grain="month")

    def start(messages):
        job = IngestJob(WEATHER, messages, table, f"{folder}/checkpoint", max_age_ms=None)
        return start_ingest(job, ONCE)

    spark.streams.addListener(log)
    try:
        _in_parts(spark, sf_dir, "weather", folder, start, damaged=True)
        log.close()
    finally:
        spark.streams.removeListener(log)
    return log.progress().where("input_rows > 0").select(
        "query", "batch_id", "input_rows",
        *[F.col("counts")[name].alias(name) for name in ("read", "valid", "rejected")],
    )
