import os
import pickle
from dataclasses import replace
from datetime import datetime

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from sluice.operators import quality
from sluice.operators.transform import conform, ingest, parse, project
from sluice.plans import reports
from sluice.sinks import AppendTable, Quarantine, StateTable, StatsLog, UpsertTable
from sluice.sources import stream_text
from sluice.specs import ORDERS, USER_EVENTS, all_specs, get_spec
from sluice.streaming import (
    IngestJob,
    LateRows,
    ProgressLog,
    Rollup,
    checkpointed_batches,
    dedup_stream,
    ingest_batch,
    keep_totals,
    progress,
    run_all,
    running_totals,
    source_lag,
    start_ingest,
    windowed_counts,
)
from sluice.streaming import running
from sluice.streaming.progress import partition_lags
from sluice_checks import queries, testdata

SMALL = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


def write_files(spark, kind, path, files=4, damaged=True):
    """The messages of ``kind`` as text files, in no particular order."""
    messages = testdata.messages(spark, SMALL, kind, damaged=damaged)
    lines = messages.select(F.col("value").cast("string").alias("value")).where("value IS NOT NULL")
    lines.repartition(files, F.xxhash64("value")).write.mode("append").text(path)
    return spark.read.text(path)


def make_table(spark, path, spec):
    if spec.policy == "update":
        return StateTable(spark, path, spec)
    return AppendTable(spark, path, spec, grain="year")


def make_job(spark, tmp_path, kind, **settings):
    spec = get_spec(kind)
    table = settings.pop("table", None) or make_table(spark, str(tmp_path / f"{kind}-table"), spec)
    return IngestJob(
        spec,
        stream_text(spark, str(tmp_path / f"{kind}-in"), max_files=1),
        table,
        str(tmp_path / f"{kind}-checkpoint"),
        Quarantine(str(tmp_path / f"{kind}-quarantine")),
        StatsLog(str(tmp_path / "stats" / kind)),
        max_age_ms=None,
        **settings,
    )


def contents(df, spec):
    columns = [c.name for c in spec.columns]
    return sorted(map(tuple, df.select(columns).collect()), key=repr)


def expected_table(messages, spec):
    flagged = quality.flag(parse(messages, spec, diagnose=True), spec, max_age_ms=None)
    rows = conform(project(quality.valid(flagged), spec), spec)
    if spec.policy == "ignore":
        return rows.dropDuplicates([spec.key])
    order = F.struct(spec.event_time, *[c for c in rows.columns if c != spec.event_time])
    return rows.groupBy(spec.key).agg(F.max(order).alias("r")).select("r.*")


def test_five_streams_equal_batch(spark, tmp_path):
    kinds = [spec.name for spec in all_specs() if spec.device_topic]
    inputs = {kind: write_files(spark, kind, str(tmp_path / f"{kind}-in")) for kind in kinds}
    jobs = [make_job(spark, tmp_path, kind) for kind in kinds]
    queries = run_all(jobs, ONCE)

    for job in jobs:
        spec, messages = job.spec, inputs[job.spec.name]
        assert contents(job.table.read(), spec) == contents(expected_table(messages, spec), spec)
        rejected = job.quarantine.read(spark)
        stats = {
            r["metric_name"]: r["n"]
            for r in job.stats.read(spark)
            .groupBy("metric_name").agg(F.sum("metric_value").alias("n")).collect()
        }
        assert stats[f"{spec.name}.read"] == messages.count()
        assert stats[f"{spec.name}.rejected"] == rejected.count() > 0

    last = {r["query"]: r for r in progress(spark, queries).collect()}
    assert set(last) == set(kinds)
    assert all(r["batch_id"] >= 3 for r in last.values())
    assert source_lag(spark, queries).count() == 0  # files have no offsets to lag behind
    folders = {job.spec.name: job.checkpoint for job in jobs}
    recorded = {r["job"]: r["latest_batch"] for r in checkpointed_batches(spark, folders).collect()}
    assert recorded == {kind: r["batch_id"] for kind, r in last.items()}


def test_resume_and_redelivery(spark, tmp_path):
    messages = write_files(spark, "orders", str(tmp_path / "orders-in"))
    job = make_job(spark, tmp_path, "orders")
    first = start_ingest(job, ONCE)
    first.awaitTermination()
    before = contents(job.table.read(), ORDERS)
    batches = first.lastProgress.batchId

    idle = start_ingest(job, ONCE)
    idle.awaitTermination()
    assert idle.lastProgress is None or idle.lastProgress.numInputRows == 0

    write_files(spark, "orders", str(tmp_path / "orders-in"), files=1)  # everything again
    again = start_ingest(job, ONCE)
    again.awaitTermination()
    assert again.lastProgress.batchId > batches
    assert contents(job.table.read(), ORDERS) == before
    assert before == contents(expected_table(messages, ORDERS), ORDERS)

    # A lost checkpoint makes batch numbers start over; new rows still come in.
    fresh = IngestJob(ORDERS, job.messages, job.table, str(tmp_path / "other"), max_age_ms=None)
    restarted = start_ingest(fresh, ONCE)
    restarted.awaitTermination()
    assert restarted.recentProgress[0].batchId == 0
    assert contents(job.table.read(), ORDERS) == before


def test_bounded_load_can_be_repeated(spark, tmp_path):
    messages = write_files(spark, "orders", str(tmp_path / "orders-in"))
    job = replace(make_job(spark, tmp_path, "orders"), messages=messages)
    for _ in range(2):
        ingest_batch(job, "2024-backlog")
        assert contents(job.table.read(), ORDERS) == contents(expected_table(messages, ORDERS), ORDERS)
        rejected = job.quarantine.read(spark)
        assert {r["query_id"] for r in rejected.select("query_id").distinct().collect()} == {
            "2024-backlog"
        }
        assert rejected.count() + job.table.read().count() == messages.count()


class Flaky:
    """A table whose write succeeds and is then reported as failed, once."""

    def __init__(self, table):
        self.table, self.failures = table, 1

    def write(self, batch):
        self.table.write(batch)
        if self.failures:
            self.failures -= 1
            raise RuntimeError("lost contact after writing")

    def read(self):
        return self.table.read()


@pytest.mark.parametrize("kind", ["user_events", "logistics"])
def test_failure_after_write_stops_the_query_and_is_repeated_harmlessly(spark, tmp_path, kind):
    spec = get_spec(kind)
    messages = write_files(spark, kind, str(tmp_path / f"{kind}-in"))
    table = Flaky(make_table(spark, str(tmp_path / "t"), spec))
    job = make_job(spark, tmp_path, kind, table=table)
    with pytest.raises(StreamingQueryException, match="lost contact"):
        start_ingest(job, ONCE).awaitTermination()
    start_ingest(job, ONCE).awaitTermination()
    assert contents(table.read(), spec) == contents(expected_table(messages, spec), spec)


def test_a_batch_for_the_latest_rows_is_counted_on_the_way_and_not_held(spark, tmp_path):
    def held():
        return spark.sparkContext._jsc.getPersistentRDDs().size()

    before, while_writing = held(), []

    class Watched(StateTable):
        def _put_in_place(self):
            while_writing.append(held() - before)
            super()._put_in_place()

    spec = get_spec("logistics")
    body = '{"shipment_id":"00000000-0000-4000-8000-%012d","order_id":"00000000-0000-4000-8000-000000000001",\
"status":"%s","current_location":{"latitude":40.5,"longitude":-73.5},"origin":"a","destination":"b","timestamp":%d}'
    loads = {
        "bad": ["not json"] * 3,
        "first": [body % (n, "in_transit", 10**12 + n) for n in (1, 1, 2)] + ["not json"],
        "more": [body % (n, "delivered", 10**12 + n + 1) for n in (2, 3)] + ["{}"] * 2,
        "none": [],
    }
    table = Watched(spark, str(tmp_path / "t"), spec, buckets=2)
    stats, quarantine = StatsLog(str(tmp_path / "stats")), Quarantine(str(tmp_path / "q"))
    for load, lines in loads.items():
        messages = spark.createDataFrame([(line,) for line in lines], "value string")
        ingest_batch(IngestJob(spec, messages, table, "", quarantine, stats, max_age_ms=None), load)
        if load == "bad":
            assert table.read() is None
    # Rows are held only to be merged with stored ones: a row per key, never the batch.
    assert while_writing == [0, 1]
    status = table.read().select(F.right("shipment_id", F.lit(1)), "shipment_status").collect()
    assert sorted(map(tuple, status)) == [("1", "in_transit"), ("2", "delivered"), ("3", "delivered")]
    counts = {(r["query_id"], r["metric_name"].split(".")[1]): r["metric_value"] for r in stats.read(spark).collect()}
    assert counts == {
        (load, name): n
        for load, of in {"bad": (3, 0, 3), "first": (4, 3, 1), "more": (4, 2, 2)}.items()
        for name, n in zip(("read", "valid", "rejected"), of)
    }
    rejected = quarantine.read(spark).groupBy("query_id").count().collect()
    assert dict(map(tuple, rejected)) == {"bad": 3, "first": 1, "more": 2}


def test_one_failure_stops_the_others(spark, tmp_path):
    for kind in ("orders", "weather"):
        write_files(spark, kind, str(tmp_path / f"{kind}-in"), files=1)
    bad = make_job(spark, tmp_path, "orders", table=Flaky(make_table(spark, str(tmp_path / "t"), ORDERS)))
    good = make_job(spark, tmp_path, "weather")
    with pytest.raises(StreamingQueryException, match="lost contact"):
        run_all([good, bad])  # no trigger: the good one would run forever
    assert not [q for q in spark.streams.active if q.name in ("orders", "weather")]


def test_messages_older_than_a_day_go_to_quarantine(spark, tmp_path):
    write_files(spark, "user_events", str(tmp_path / "user_events-in"), damaged=False)
    spec = USER_EVENTS
    job = IngestJob(
        spec,
        stream_text(spark, str(tmp_path / "user_events-in")),
        make_table(spark, str(tmp_path / "t"), spec),
        str(tmp_path / "c"),
        Quarantine(str(tmp_path / "q")),
        as_of=datetime(2024, 1, 10),
    )
    start_ingest(job, ONCE).awaitTermination()
    times = job.table.read().agg(F.min("event_timestamp"), F.max("event_timestamp")).first()
    assert datetime(2024, 1, 9) <= times[0] and times[1] <= datetime(2024, 1, 11)
    stale = job.quarantine.read(spark).where(F.array_contains("errors", "stale"))
    assert stale.count() > 0


def _events_stream(spark, path):
    return conform(ingest(stream_text(spark, path, max_files=1), USER_EVENTS), USER_EVENTS)


def _collect_stream(df, name, checkpoint):
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.table(name)


def test_windowed_counts_equal_batch_on_closed_windows(spark, tmp_path):
    path = str(tmp_path / "in")
    messages = write_files(spark, "user_events", path, files=1, damaged=False)
    # A last message two days later moves the watermark past every window before it.
    last = spark.read.text(path).limit(1).select(
        F.regexp_replace("value", '"timestamp":\\d+', '"timestamp":1707000000000').alias("value")
    )
    last.write.mode("append").text(path)
    os.utime(sorted((os.path.join(path, f) for f in os.listdir(path)), key=os.path.getmtime)[-1])
    streamed = _collect_stream(
        windowed_counts(_events_stream(spark, path)), "windows", str(tmp_path / "c")
    )
    batch = reports.events_tumbling(conform(ingest(messages, USER_EVENTS), USER_EVENTS))
    closed = batch.where(F.col("window_end") <= F.lit("2024-02-02 22:40:00").cast("timestamp"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, closed.collect()))
    assert closed.count() > 100


def test_dedup_stream(spark, tmp_path):
    path = str(tmp_path / "in")
    for _ in range(2):
        write_files(spark, "user_events", path, files=1, damaged=False)
    rows = dedup_stream(_events_stream(spark, path), "message_id", "event_timestamp", "60 days")
    kept = _collect_stream(rows, "deduped", str(tmp_path / "c"))
    assert kept.count() == kept.select("message_id").distinct().count()
    assert kept.count() == testdata.landed(spark, SMALL, "user_events").count()


def test_dedup_stream_keeps_rows_without_a_key(spark, tmp_path):
    path = str(tmp_path / "in")
    for _ in range(2):
        write_files(spark, "user_events", path, files=1, damaged=False)
    nameless = F.col("user_id") % 7 == 0
    events = _events_stream(spark, path).withColumn(
        "message_id", F.when(~nameless, F.col("message_id"))
    )
    rows = dedup_stream(events, "message_id", "event_timestamp", "60 days")
    kept = _collect_stream(rows, "nameless", str(tmp_path / "c"))
    landed = testdata.landed(spark, SMALL, "user_events")
    assert kept.where(F.col("message_id").isNull()).count() == 2 * landed.where(nameless).count()
    assert kept.where(~nameless).count() == landed.where(~nameless).count()


def test_partition_lags():
    source = {
        "endOffset": {"t": {"0": 5, "1": 7}},
        "latestOffset": {"t": {"0": 9, "1": 7, "2": 4}},
    }
    assert partition_lags("q", source) == [
        ("q", "t", 0, 5, 9, 4), ("q", "t", 1, 7, 7, 0), ("q", "t", 2, 0, 4, 4),
    ]
    assert partition_lags("q", {"endOffset": {"logOffset": 1}, "latestOffset": None}) == []


CHANGES = "at timestamp_ntz, id string, sku string, wh string, delta int, total string"


def change(minute, id_, delta, sku="a", wh="x"):
    return datetime(2024, 1, 1, minute // 60, minute % 60), id_, sku, wh, delta, "theirs"


def test_running_totals_follow_event_time_whatever_order_batches_have(spark, tmp_path):
    batches = [
        [change(90, "k", 5), change(60, "j", None), change(60, "i", 7), change(70, "n", 1, None, "x")],
        # Earlier than what came before, though not behind the watermark (minute 30).
        [change(75, "m", -3), change(40, "b", 2), change(60, "c", 1), change(200, "z", 9), change(90, "k", 5)],
        # Behind the watermark (minute 140), as are rows at it; a key without any value; no time.
        [change(130, "late", 100), change(140, "late2", 100), change(190, "y", 1), change(150, "w", None, "b"),
         (None, "q", "a", "x", 50, "theirs"), change(400, "end", 0, "c")],
    ]
    schema = spark.createDataFrame([], CHANGES).schema
    for batch in batches:
        spark.createDataFrame(batch, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        totals = running_totals(stream, ["sku", "wh"], "at", "id", "delta", "total", "1 hour")
        # A new query each time, as after a restart.
        totals.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
            **ONCE
        ).start(str(tmp_path / "out")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    assert found.columns == ["at", "id", "sku", "wh", "delta", "total"]
    by_key = {}
    for r in sorted(found.collect(), key=lambda r: (r["at"], r["id"])):
        by_key.setdefault((r["sku"], r["wh"]), []).append((r["id"], r["total"]))
    expected = [("b", 2), ("c", 3), ("i", 10), ("j", 10), ("m", 7), ("k", 12), ("k", 17), ("y", 18), ("z", 27)]
    assert sorted(by_key[("a", "x")]) == sorted(expected)
    assert by_key[(None, "x")] == [("n", 1)] and by_key[("b", "x")] == [("w", None)]
    assert set(by_key) == {("a", "x"), (None, "x"), ("b", "x")}  # "end" is not passed yet


def test_running_totals_keep_state_per_group_of_keys_and_whole_numbers_exactly(spark, tmp_path):
    large = (1 << 53) + 1  # not a double
    given = "at timestamp_ntz, id long, sku int, ratio double, delta bigint"
    rows = [(datetime(2024, 1, 1, 0, n % 3), 9 + n % 3, n % 500, None if n % 2 else 0.1, large if n % 3 else None)
            for n in range(1500)]
    rows += [(datetime(2024, 1, 3), 0, None, None, 1)]
    spark.createDataFrame(rows, given).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(given).parquet(str(tmp_path / "in"))
    totals = running_totals(stream, ["sku"], "at", "id", "delta", "total", "1 hour", groups=4)
    totals.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        **ONCE
    ).start(str(tmp_path / "out")).awaitTermination()
    found, by_key = spark.read.parquet(str(tmp_path / "out")), {}
    assert found.dtypes == [*stream.dtypes, ("total", "bigint")]
    for at, id_, sku, ratio, delta, total in sorted(rows_of(found)):
        by_key.setdefault(sku, []).append((id_, ratio, delta, total))
    assert set(by_key) == set(range(500))
    for sku, changes in by_key.items():
        ratios = [next(r[3] for r in rows if r[1:3] == (id_, sku)) for id_ in (9, 10, 11)]
        assert changes == [(9, ratios[0], None, None), (10, ratios[1], large, large), (11, ratios[2], large, 2 * large)]
    state = spark.read.format("statestore").option("stateVarName", "totals").load(str(tmp_path / "c"))
    assert state.count() == 4


def rows_of(df):
    return [tuple(row) for row in df.collect()]


def test_waiting_changes_take_little_room(spark, tmp_path):
    n = 4000
    changes = spark.range(n).select(
        F.expr("timestamp_ntz '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id % 600)").alias("at"),
        F.md5(F.col("id").cast("string")).alias("id"),
        F.concat(F.lit("SKU-"), F.col("id") % 50).alias("sku"),
        (F.col("id") % 9 - 4).cast("int").alias("delta"),
    )
    changes.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(changes.schema).parquet(str(tmp_path / "in"))
    totals = running_totals(stream, ["sku"], "at", "id", "delta", "total", "1 hour", groups=1)
    keep_totals(totals, str(tmp_path / "out"), str(tmp_path / "c"), ONCE).awaitTermination()
    assert spark.read.schema(totals.schema).parquet(str(tmp_path / "out")).count() == 0
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(str(tmp_path / "c"))
    held = waiting.agg(F.sum(F.length("list_element.changes"))).first()[0]
    assert 16 * n < held < 40 * n  # an id alone has 32 characters
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "100"
    # Chunks of checkpoints from before are read as they are.
    frame = pd.DataFrame({"at": [1, 2], "id": ["a", None]})
    for data in (running._packed(frame), pickle.dumps(frame, pickle.HIGHEST_PROTOCOL)):
        pd.testing.assert_frame_equal(running._unpacked(data), frame)


def test_a_part_makes_room_for_the_next_one(spark, tmp_path):
    there = []

    class Done:
        def awaitTermination(self):
            pass

    def look(messages):
        there.append(spark.read.parquet(str(tmp_path / "in")).count())
        return Done()

    queries._in_parts(spark, SMALL, "weather", str(tmp_path), look)
    parts = testdata.in_parts(spark, SMALL, "weather").groupBy("part").count().orderBy("part")
    assert there == [row["count"] for row in parts.collect()]


def test_batches_of_more_rows_take_more_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(testdata, "ROWS_PER_TASK", 50)
    tasks, most = [], []

    def start(messages):
        def write(batch, batch_id):
            tasks.append(batch.rdd.getNumPartitions())
            sizes = batch.groupBy(F.spark_partition_id()).count()
            most.append(sizes.agg(F.max("count")).first()[0])

        writer = messages.writeStream.foreachBatch(write).trigger(**ONCE)
        return writer.option("checkpointLocation", str(tmp_path / f"c{len(tasks)}")).start()

    rows = testdata.source_rows(spark, SMALL, "weather").count()
    start(testdata.stream_messages(spark, SMALL, "weather")).awaitTermination()
    assert tasks == [-(-rows // 50)] and most[0] <= 60 and tasks[0] > 8
    plans = []

    class Done:
        def awaitTermination(self):
            pass

    def look(messages):
        plans.append(messages._jdf.queryExecution().logical().toString())
        return Done()

    queries._in_parts(spark, SMALL, "weather", str(tmp_path / "parts"), look)
    found = [int(plan.split("Repartition ")[1].split(",")[0]) for plan in plans]
    assert len(found) == testdata.PARTS and rows // 50 <= sum(found) <= rows // 50 + 3 + 8 * 3


def test_late_rows_of_a_repeated_batch_are_the_same(spark, tmp_path):
    late = LateRows(str(tmp_path / "late"), "at", "1 hour")
    assert late.read(spark) is None
    batches = [
        [change(90, "a", 1), change(10, "b", 1)],
        [change(300, "c", 1), change(29, "d", 1), change(30, "e", 1), change(31, "f", 1), (None, "g", "a", "x", 1, "t")],
        [change(239, "h", 1), change(241, "i", 1)],
    ]
    frames = [spark.createDataFrame(rows, CHANGES) for rows in batches]
    for i in (0, 0, 1, 1, 2):
        late.write(frames[i], i)
    late.write(frames[1], 1)  # repeated although a later one was written
    late.write(frames[0].limit(0), 3)
    late.write(frames[2], 4)
    found = {(r["batch_id"], r["id"]) for r in late.read(spark).collect()}
    assert found == {(1, "d"), (1, "e"), (2, "h"), (4, "h")}


def test_a_kept_report_holds_the_totals_of_the_last_batch(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"), ["sku", "wh"], buckets=4)
    assert rollup.read() is None
    given = "sku string, wh string, n long"
    batches = [[("a", "x", 1), (None, "x", 2)], [("a", "x", 4)], [("b", "y", 1)]]
    for i in (0, 1, 1, 0, 2):  # the first batch again must not bring back its totals
        rollup.write(spark.createDataFrame(batches[i], given), i)
    found = {tuple(r) for r in rollup.read().select("sku", "wh", "n").collect()}
    assert found == {("a", "x", 4), (None, "x", 2), ("b", "y", 1)}


def test_totals_of_a_kept_report_are_not_reduced_again(spark, tmp_path, monkeypatch):
    plans, merged = [], UpsertTable.merged

    def look(table, rows, touched):
        plans.append(rows._jdf.queryExecution().logical().toString())
        return merged(table, rows, touched)

    monkeypatch.setattr(UpsertTable, "merged", look)
    totals = spark.createDataFrame([("a", 1), (None, 2)], "sku string, n long")
    Rollup(spark, str(tmp_path / "r"), ["sku"], buckets=4).write(totals, 0)
    assert len(plans) == 1 and "Aggregate" not in plans[0]


def test_log_of_progress_and_lag(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"), every=2)
    assert log.progress() is None and log.lag() is None
    report = {
        "id": "i", "runId": "r", "name": "q", "timestamp": "2024-03-05T23:59:59.500Z", "batchId": 7,
        "numInputRows": 10, "durationMs": {"triggerExecution": 12},
        "stateOperators": [{"numRowsDroppedByWatermark": 3}, {}],
        "observedMetrics": {"messages": {"read": 10, "valid": None}},
        "sources": [{"endOffset": {"t": {"0": 5}}, "latestOffset": {"t": {"0": 9}}}, {"endOffset": "file"}],
    }
    log.record(report)
    assert log.progress() is None  # gathered, not yet appended
    log.record(report | {"batchId": 8, "name": None, "sources": []})
    rows = {r["batch_id"]: r for r in log.progress().collect()}
    assert set(rows) == {7, 8} and rows[7]["dropped_late"] == 3 and rows[7]["counts"] == {"read": 10}
    assert rows[7]["recorded_at"] == datetime(2024, 3, 5, 23, 59, 59, 500000)
    assert [(r["topic"], r["partition"], r["lag"], r["batch_id"]) for r in log.lag().collect()] == [("t", 0, 4, 7)]
    log.close()
    assert log.progress().count() == 2


def test_rows_dropped_by_windows_are_logged(spark, tmp_path):
    log = ProgressLog(spark, str(tmp_path / "log"))
    spark.streams.addListener(log)
    schema = spark.createDataFrame([], CHANGES).schema
    try:
        for rows in ([change(1400, "a", 1)], [change(60, "b", 1), change(61, "c", 1)]):
            spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            events = spark.readStream.schema(schema).parquet(str(tmp_path / "in")).selectExpr(
                "at AS event_timestamp", "id AS event_type"
            )
            windowed_counts(events, delay="2 hours").writeStream.format("noop").queryName("logged_windows").option(
                "checkpointLocation", str(tmp_path / "c")
            ).trigger(**ONCE).start().awaitTermination()
        log.close()
    finally:
        spark.streams.removeListener(log)
    rows = log.progress().collect()
    assert sum(r["input_rows"] for r in rows) == 3 and sum(r["dropped_late"] for r in rows) == 2
    assert {r["query"] for r in rows} == {"logged_windows"} and len({r["run_id"] for r in rows}) == 2
