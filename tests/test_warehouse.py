import pytest
from pyspark.sql import functions as F

from sluice.jobs import main
from sluice.plans import monitoring, reports
from sluice.specs import all_specs
from sluice.warehouse import Warehouse
from sluice_checks import testdata

from .test_streaming import SMALL, contents, expected_table, write_files

KINDS = ("weather", "user_events", "logistics")


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """A warehouse filled by the command, from text files."""
    folder = tmp_path_factory.mktemp("warehouse")
    for kind in KINDS:
        write_files(spark, kind, str(folder / "in" / kind), files=2)
    main(["--root", str(folder / "out"), "--text", str(folder / "in"), "--once", "--any-age",
          "--probe-days", "0", *KINDS])
    return folder


def test_tables_after_the_command(spark, root):
    warehouse = Warehouse(spark, str(root / "out"))
    tables = warehouse.tables()
    assert set(tables) == {"weather_data", "user_events", "logistics_shipments"}
    for spec in all_specs():
        if spec.name in KINDS:
            messages = spark.read.text(str(root / "in" / spec.name))
            assert contents(tables[spec.table], spec) == contents(expected_table(messages, spec), spec)


def test_bucketed_tables_after_the_command(spark, root, tmp_path):
    for _ in range(2):
        main(["--root", str(tmp_path), "--text", str(root / "in"), "--once", "--any-age",
              "--buckets", "4", "user_events"])
    rows = Warehouse(spark, str(tmp_path), buckets=4).tables()["user_events"]
    dated = Warehouse(spark, str(root / "out")).tables()["user_events"]
    unlike = {"ingested_at", "event_date"}
    names = [name for name in dated.columns if name not in unlike]
    assert sorted(rows.select(names).collect()) == sorted(dated.select(names).collect())
    with pytest.raises(ValueError, match="probe_days"):
        Warehouse(spark, str(tmp_path), buckets=4, probe_days=0)


def test_reports_run_on_landed_tables(spark, root):
    tables = Warehouse(spark, str(root / "out")).tables()
    weather = tables["weather_data"]
    readings = reports.avg_temp_per_device(weather).agg(F.sum("readings")).first()[0]
    trend = monitoring.volume_trend(weather).agg(F.sum("row_count")).first()[0]
    assert readings == trend > 0
    assert monitoring.processing_lag(weather).first()["avg_lag_seconds"] > 0
    counts = {r["table_name"]: r["row_count"] for r in monitoring.table_counts_long(tables).collect()}
    assert counts == {name: rows.count() for name, rows in tables.items()}
    paths = {name: str(root / "out" / "tables" / name) for name in tables}
    sizes = monitoring.table_sizes(spark, paths).collect()
    assert {r["table_name"] for r in sizes} == set(tables)
    assert all(r["total_bytes"] > 0 for r in sizes)


# Queries people run by hand, with the schema prefix left out.
SQL = {
    "average temperature": """
        SELECT device_id, AVG(temperature) AS avg_temp, COUNT(*) AS readings FROM weather_data
        WHERE recorded_at > TIMESTAMP '2024-01-30' - INTERVAL '24 hours'
        GROUP BY device_id ORDER BY avg_temp DESC""",
    "in transit": """
        SELECT shipment_id, order_id, current_location, destination_location
        FROM logistics_shipments WHERE shipment_status = 'in_transit' ORDER BY last_update DESC""",
    "messages per hour": """
        SELECT DATE_TRUNC('hour', recorded_at) AS hour, COUNT(*) AS message_count
        FROM weather_data GROUP BY DATE_TRUNC('hour', recorded_at) ORDER BY hour DESC LIMIT 24""",
    "row counts": """
        SELECT (SELECT COUNT(*) FROM weather_data) AS weather,
               (SELECT COUNT(*) FROM logistics_shipments) AS logistics,
               (SELECT COUNT(*) FROM user_events) AS user_events""",
    "latest rows": "SELECT * FROM weather_data ORDER BY ingested_at DESC LIMIT 3",
}


@pytest.mark.parametrize("name", SQL)
def test_sql_over_views(spark, root, name):
    views = Warehouse(spark, str(root / "out")).create_views()
    assert views == ["logistics_shipments", "user_events", "weather_data"]
    assert spark.sql(SQL[name]).count() > 0
    assert testdata.landed(spark, SMALL, "weather").count() >= spark.table("weather_data").count()
