import random
from datetime import datetime
from functools import partial

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sluice.operators import keyed
from sluice.sinks import (
    AppendTable,
    BucketTable,
    DatabaseTable,
    Quarantine,
    StateTable,
    StatsLog,
    UpsertTable,
    export_tables,
    restore_tables,
    upsert_statement,
)
from sluice.sinks.upsert import BUCKET, BUCKETS, REDO
from sluice.specs import LOGISTICS, ORDERS, USER_EVENTS
from sluice_checks import testdata

from .fake_driver import connect, executed


def rows_of(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def events(spark, small):
    return testdata.landed(spark, small, "user_events").cache()


@pytest.fixture(scope="module")
def shipments(spark, small):
    return testdata.landed(spark, small, "logistics").cache()


def parts(df, key, n, seed):
    """``df`` split into ``n`` batches, rows of one key landing in several of them."""
    mixed = df.withColumn("_batch", F.pmod(F.xxhash64(*df.columns, F.lit(seed)), F.lit(n)))
    return [mixed.where(F.col("_batch") == i).drop("_batch") for i in range(n)]


@pytest.mark.parametrize("probe_days, grain", [(None, "day"), (0, "day"), (1, "month")])
@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 25])
def test_insert_if_absent(spark, events, tmp_path, probe_days, grain, broadcast_bytes):
    table = AppendTable(
        spark, str(tmp_path / "t"), USER_EVENTS, probe_days, grain=grain,
        broadcast_bytes=broadcast_bytes,
    )
    assert table.read() is None
    for batch in parts(events, "message_id", 3, 1):
        table.write(batch.unionByName(batch))
    first = rows_of(table.read().drop("event_date"))
    assert first == rows_of(events)
    later = events.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 HOUR"))
    table.write(later)
    assert rows_of(table.read().drop("event_date")) == first


def plan_nodes(plan):
    yield plan
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        yield from plan_nodes(plan.executedPlan())
    elif "QueryStage" in plan.nodeName():
        yield from plan_nodes(plan.plan())
    for i in range(plan.children().size()):
        yield from plan_nodes(plan.children().apply(i))


def shuffled_rows(df):
    """(plan as text, rows written) of each shuffle of ``df``, which is run."""
    df.collect()
    exchanges = [n for n in plan_nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    return [(n.toString(), n.metrics().get("shuffleRecordsWritten").get().value()) for n in exchanges]


def test_a_large_batch_filters_the_scan_of_the_table_by_its_keys(spark, events, tmp_path):
    many = events.crossJoin(spark.range(40)).withColumn(
        "message_id", F.concat("message_id", F.lit("-"), F.col("id").cast("string"))
    ).drop("id").cache()
    table = AppendTable(spark, str(tmp_path / "t"), USER_EVENTS, grain="year", broadcast_bytes=100)
    table.write(many)
    batch = events.limit(200).withColumn("message_id", F.concat("message_id", F.lit("-7")))
    new = events.limit(100).withColumn("message_id", F.concat("message_id", F.lit("-new")))
    rows = batch.unionByName(new).withColumn("event_date", F.lit("2024-01-01").cast("date")).cache()
    settings = dict(spark.conf.getAll)
    with table._looking_up(rows) as absent:
        plan = absent._jdf.queryExecution().executedPlan().toString()
        moved = [n for text, n in shuffled_rows(absent) if "might_contain" in text]
        found = {r["message_id"] for r in absent.collect()}
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert len(moved) == 1 and 200 <= moved[0] <= many.count() / 10
    assert found == {r["message_id"] for r in new.collect()}
    assert dict(spark.conf.getAll) == settings
    table.write(batch.unionByName(new))
    assert table.read().count() == many.count() + 100


def test_probe_scope(spark, events, tmp_path):
    moved = events.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 40 DAYS"))
    n = events.count()
    for probe_days, expected in ((None, n), (40, n), (0, 2 * n)):
        table = AppendTable(spark, str(tmp_path / str(probe_days)), USER_EVENTS, probe_days)
        table.write(events)
        table.write(moved)
        assert table.read().count() == expected


def test_many_dates_are_looked_up_by_listing(spark, events, tmp_path, monkeypatch):
    monkeypatch.setattr("sluice.sinks.parquet.LISTED_DATES", 0)
    table = AppendTable(spark, str(tmp_path / "t"), USER_EVENTS, probe_days=0)
    for _ in range(2):
        table.write(events)
    assert table.read().count() == events.count()


def test_append_table_reads_only_needed_dates_and_columns(spark, events, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), USER_EVENTS)
    table.write(events)
    day = table.read().where(F.col("event_date") == F.lit("2024-01-02").cast("date"))
    plan = day.select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert "ReadSchema: struct<user_id:int>" in plan


def test_null_keys(spark, events, tmp_path):
    nameless = events.limit(5).withColumn("message_id", F.lit(None).cast("string"))
    strict = AppendTable(spark, str(tmp_path / "strict"), USER_EVENTS)
    with pytest.raises(PySparkException, match="row without message_id"):
        strict.write(nameless)
    loose = AppendTable(spark, str(tmp_path / "loose"), USER_EVENTS, null_key="append")
    batch = events.unionByName(nameless)
    loose.write(batch)
    loose.write(batch)
    assert loose.read().count() == events.count() + 10


def test_rows_without_a_time_are_looked_up(spark, events, tmp_path):
    timeless = events.limit(5).withColumn("event_timestamp", F.lit(None).cast("timestamp_ntz"))
    table = AppendTable(spark, str(tmp_path / "t"), USER_EVENTS, probe_days=0)
    for _ in range(2):
        table.write(timeless)
    assert table.read().count() == 5


def test_failed_write_leaves_the_table_and_can_be_repeated(spark, events, tmp_path):
    table = AppendTable(spark, str(tmp_path / "t"), USER_EVENTS)
    half, rest = parts(events, "message_id", 2, 7)
    table.write(half)
    broken = rest.withColumn(
        "event_type",
        F.when(F.col("user_id") % 5 == 0, F.raise_error(F.lit("lost")).cast("string")).otherwise(
            F.col("event_type")
        ),
    )
    with pytest.raises(PySparkException):
        table.write(broken)
    assert rows_of(table.read().drop("event_date")) == rows_of(half)
    table.write(rest)
    table.write(rest)
    assert rows_of(table.read().drop("event_date")) == rows_of(events)


def test_buckets_keep_the_first_row_of_each_key(spark, events, tmp_path):
    path = str(tmp_path / "t")
    assert BucketTable(spark, path, USER_EVENTS, 4).read() is None
    for batch in parts(events, "message_id", 3, 1):
        # A new writer each time, as after a restart.
        BucketTable(spark, path, USER_EVENTS, 4).write(batch.unionByName(batch))
    table = BucketTable(spark, path, USER_EVENTS, 4)
    assert rows_of(table.read()) == rows_of(events)
    table.write(events.withColumn("event_timestamp", F.col("event_timestamp") + F.expr("INTERVAL 900 DAYS")))
    assert rows_of(table.read()) == rows_of(events)
    nameless = events.limit(1).withColumn("message_id", F.lit(None).cast("string"))
    with pytest.raises(PySparkException, match="row without message_id"):
        table.write(nameless)
    assert rows_of(table.read()) == rows_of(events)


def test_a_batch_is_moved_to_the_buckets_and_the_table_is_not(spark, events, tmp_path):
    table = BucketTable(spark, str(tmp_path / "t"), USER_EVENTS, 4)
    half, rest = parts(events, "message_id", 2, 7)
    table.write(half)
    assert len(list((tmp_path / "t").glob("part-*"))) == 4
    first = keyed.first_per_key(rest, "message_id", ["event_timestamp"], nullable=False)
    plan = table.absent(first)._jdf.queryExecution().executedPlan().toString()
    join, stored = plan[: plan.index("InMemoryRelation")], plan[plan.rindex("Sort [_present") :]
    # One exchange picks the batch's winners, one takes them to their buckets.
    assert "SortMergeJoin" in join and join.count("Exchange ") == 2
    assert "Exchange" not in stored and "Bucketed: true" in stored
    assert "ReadSchema: struct<message_id:string>" in stored
    table.write(rest)
    assert len(list((tmp_path / "t").glob("part-*"))) == 8


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_latest_state_does_not_depend_on_order_of_batches(spark, shipments, tmp_path, seed):
    expected = rows_of(keyed.latest_per_key(shipments, "shipment_id", ["last_update"]))
    batches = parts(shipments.repartition(5), "shipment_id", 4, seed)
    random.Random(seed).shuffle(batches)
    table = StateTable(spark, str(tmp_path / "s"), LOGISTICS)
    assert table.read() is None
    for i, batch in enumerate(batches):
        table.write(batch)
        if i == 1:
            table.write(batch)
    assert rows_of(table.read()) == expected
    table.write(batches[0])
    assert rows_of(table.read()) == expected


def stored_files(path):
    """(bucket, file, time of writing) of every file of an update-latest table."""
    return {(f.parent.name, f.name, f.stat().st_mtime_ns) for f in path.glob(f"{BUCKET}=*/part-*")}


def test_a_write_replaces_the_buckets_of_its_keys_alone(spark, shipments, tmp_path):
    path = tmp_path / "s"
    table = StateTable(spark, str(path), LOGISTICS)
    table.write(shipments)
    before = stored_files(path)
    assert len({bucket for bucket, *_ in before}) == BUCKETS == len(before)  # a file each
    held = spark.read.parquet(str(path)).where(F.col(BUCKET).isin(3, 40)).select("shipment_id")
    update = shipments.join(held, "shipment_id").withColumn("shipment_status", F.lit("lost")).withColumn(
        "last_update", F.col("last_update") + F.expr("INTERVAL 90000 DAYS")
    )
    # A new writer, as after a restart.
    StateTable(spark, str(path), LOGISTICS).write(update)
    after = stored_files(path)
    assert {bucket for bucket, *_ in before - after} == {f"{BUCKET}=3", f"{BUCKET}=40"}
    assert len(before & after) == BUCKETS - 2 and len(after) == BUCKETS
    once = rows_of(table.read())
    expected = shipments.unionByName(update)
    assert once == rows_of(keyed.latest_per_key(expected, "shipment_id", ["last_update"]))
    table.write(update)
    assert rows_of(table.read()) == once
    assert not (path / REDO).exists()


def test_a_write_reads_the_buckets_of_its_keys_alone_and_moves_them_once(spark, shipments, tmp_path):
    table = StateTable(spark, str(tmp_path / "s"), LOGISTICS)
    table.write(shipments)
    rows = spark.read.parquet(str(tmp_path / "s")).where(F.col(BUCKET) == 5)
    merged = table.merged(rows, [5])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert f"PartitionFilters: [isnotnull({BUCKET}" in plan


@pytest.mark.parametrize("lost", ["bucket", "nothing"])
def test_an_interrupted_overwrite_is_finished_by_the_next_write(spark, shipments, tmp_path, lost):
    path = tmp_path / "s"
    half, rest = parts(shipments, "shipment_id", 2, 4)

    class Interrupted(StateTable):
        def _put_in_place(self):
            raise RuntimeError("writer lost")

    StateTable(spark, str(path), LOGISTICS).write(half)
    with pytest.raises(RuntimeError, match="writer lost"):
        Interrupted(spark, str(path), LOGISTICS).write(rest)
    if lost == "bucket":  # as if the writer died between removing a bucket and replacing it
        for file in (path / f"{BUCKET}=7").iterdir():
            file.unlink()
    table = StateTable(spark, str(path), LOGISTICS)
    table.write(half.limit(0))  # even a batch without rows
    expected = rows_of(keyed.latest_per_key(shipments, "shipment_id", ["last_update"]))
    assert rows_of(table.read()) == expected
    # What was cut short before it was complete does not count.
    (path / REDO).mkdir()
    (path / REDO / "part-0.parquet").write_bytes(b"cut short")
    table.write(rest)
    assert rows_of(table.read()) == expected


def test_keys_of_several_columns_some_null(spark, tmp_path):
    table = UpsertTable(spark, str(tmp_path / "t"), ["a", "b"], ["at"], buckets=3)
    given = "a string, b int, at int, v string"
    table.write(spark.createDataFrame([("x", 1, 1, "old"), (None, 1, 1, "n"), ("x", None, 2, "y")], given))
    table.write(spark.createDataFrame([("x", 1, 2, "new"), (None, 1, 0, "older"), ("z", 9, 1, "z")], given))
    assert rows_of(table.read().select("a", "b", "v")) == sorted(
        [("x", 1, "new"), (None, 1, "n"), ("x", None, "y"), ("z", 9, "z")], key=repr
    )


def _shipment(status, minute, offset=None):
    row = ("k", "o", status, "40.5,-73.5", "a", "b", datetime(2024, 1, 1, 0, minute),
           datetime(2024, 1, 2))
    return row if offset is None else (*row, offset, 0)


SHIPMENT_COLUMNS = """shipment_id string, order_id string, shipment_status string,
    current_location string, origin_location string, destination_location string,
    last_update timestamp_ntz, ingested_at timestamp_ntz"""


@pytest.mark.parametrize("guard, winner", [(True, "newer"), (False, "older")])
def test_older_update_arriving_later(spark, tmp_path, guard, winner):
    table = StateTable(spark, str(tmp_path / "s"), LOGISTICS, guard=guard)
    for status, minute in (("newer", 5), ("older", 1)):
        table.write(spark.createDataFrame([_shipment(status, minute)], SHIPMENT_COLUMNS))
    assert [r["shipment_status"] for r in table.read().collect()] == [winner]


def test_tie_goes_to_the_later_message(spark, tmp_path):
    columns = SHIPMENT_COLUMNS + ", source_offset long, source_partition int"
    table = StateTable(spark, str(tmp_path / "s"), LOGISTICS)
    tied = [_shipment("a", 5, 2), _shipment("z", 5, 1)]
    table.write(spark.createDataFrame(tied, columns))
    assert [r["shipment_status"] for r in table.read().collect()] == ["a"]
    table.write(spark.createDataFrame([_shipment("b", 5, 0)], columns))
    assert [r["shipment_status"] for r in table.read().collect()] == ["a"]


def test_quarantine_and_stats_replace_their_batch(spark, tmp_path):
    box = Quarantine(str(tmp_path / "q"))
    assert box.read(spark) is None
    rejected = spark.createDataFrame([("x", ["malformed"])], "raw_value string, errors array<string>")
    for _ in range(2):
        box.write(rejected, "q1", 3)
    box.write(rejected, "q1", 4)
    assert sorted(r["batch_id"] for r in box.read(spark).collect()) == [3, 4]
    log = StatsLog(str(tmp_path / "stats"))
    for n in (1, 2):
        log.write(spark, {"orders.read": n}, datetime(2024, 1, 1), "q1", 0)
    rows = log.read(spark).select("metric_name", "metric_value", "recorded_at").collect()
    assert [tuple(r) for r in rows] == [("orders.read", 2, datetime(2024, 1, 1))]


def test_export_and_restore(spark, small, tmp_path):
    tables = {"sales_orders": testdata.landed(spark, small, "orders")}
    export_tables(tables, str(tmp_path))
    back = restore_tables(spark, str(tmp_path), tables)["sales_orders"]
    assert back.dtypes == tables["sales_orders"].dtypes
    assert rows_of(back) == rows_of(tables["sales_orders"])


def test_mode_ignore_would_lose_rows(spark, tmp_path):
    """Why no sink uses it: with any table present, the batch is dropped as a whole."""
    path = str(tmp_path / "t")
    spark.range(1).write.mode("ignore").parquet(path)
    spark.range(1, 5).write.mode("ignore").parquet(path)
    assert spark.read.parquet(path).count() == 1


def test_upsert_statements():
    ignore = upsert_statement("t", ["k", "a"], "k", "ignore")
    assert ignore == "INSERT INTO t (k, a) VALUES (%s, %s) ON CONFLICT (k) DO NOTHING"
    update = upsert_statement("t", ["k", "a", "ts"], "k", "update", "?", "ts")
    assert update == (
        "INSERT INTO t (k, a, ts) VALUES (?, ?, ?) ON CONFLICT (k) DO UPDATE SET "
        "a = excluded.a, ts = excluded.ts WHERE t.ts <= excluded.ts"
    )
    several = upsert_statement("t", ["k", "a"], "k", "ignore", rows=3)
    assert several.count("(%s, %s)") == 3


def test_database_table_sends_one_row_per_key(spark, small, shipments, tmp_path):
    orders = testdata.landed(spark, small, "orders")
    folder = str(tmp_path)
    DatabaseTable(ORDERS, partial(connect, folder), connections=3).write(orders.unionByName(orders))
    calls = executed(folder)
    assert {c["statement"].split(" ON ")[1] for c in calls} == {"CONFLICT (order_id) DO NOTHING"}
    assert sorted(r for c in calls for r in c["keys"]) == sorted(
        r[0] for r in orders.select("order_id").collect()
    )
    assert all(len(c["keys"]) <= 1000 for c in calls)


def test_database_failure_is_rolled_back_and_raised(spark, shipments, tmp_path):
    folder = str(tmp_path)
    table = DatabaseTable(LOGISTICS, partial(connect, folder, fail=True))
    with pytest.raises(Exception, match="connection lost"):
        table.write(shipments)
    assert executed(folder) == []
    DatabaseTable(LOGISTICS, partial(connect, folder)).write(shipments)
    keys = [k for c in executed(folder) for k in c["keys"]]
    assert len(keys) == len(set(keys)) == shipments.select("shipment_id").distinct().count()


