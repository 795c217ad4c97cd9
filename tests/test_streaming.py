import pytest
from pyspark.errors import StreamingQueryException

from beaconlake.model import EVENT_TABLES
from beaconlake.sources import benchdata, raw
from beaconlake.sources.lake import STREAMED_TABLES, Lake
from beaconlake.streaming.ingest_stream import route_batch, start_ingest

from .records import ARRIVED, CONNECTIVITY, encoded
from .records import raw as raw_rows


def _rows(lake):
    return {t: lake.read(t).count() for t in STREAMED_TABLES}


@pytest.fixture(scope="module")
def records(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("records") / "raw")
    benchdata.raw_records(spark, sf_dir).repartition(2).write.parquet(path)
    return path


@pytest.fixture(scope="module")
def expected(spark, sf_dir):
    tables = benchdata.network_tables(spark, sf_dir)
    return {t: tables.table(t).count() for t in STREAMED_TABLES}


def test_a_crash_after_the_write_leaves_one_copy(spark, records, expected, tmp_path):
    """The batch is written, the run dies before the commit, the restart repeats it."""
    lake, crashes = Lake(spark, str(tmp_path / "lake")), []

    def crash_once(target, batch, batch_id):
        route_batch(target, batch, batch_id, benchdata.ACCESS_DIGITS)
        if not crashes:
            crashes.append(batch_id)
            raise RuntimeError("lost before the commit")

    stream = raw.file_records(spark, records, 1)
    checkpoint = str(tmp_path / "checkpoint")
    with pytest.raises(StreamingQueryException):
        start_ingest(stream, lake, checkpoint, "crash", None, crash_once).awaitTermination()
    start_ingest(stream, lake, checkpoint, "crash", None, crash_once).awaitTermination()
    assert crashes and _rows(lake) == expected


def test_a_table_that_failed_is_retried_without_doubling_the_others(spark, tmp_path):
    root = str(tmp_path / "lake")
    batch = raw_rows(spark, encoded(CONNECTIVITY), (b"", "network.state"))

    class Failing(Lake):
        def write_batch(self, table, rows, batch_id):
            if table == "throughput_events":
                raise OSError("storage unavailable")
            super().write_batch(table, rows, batch_id)

    with pytest.raises(OSError):
        route_batch(Failing(spark, root), batch, "run-0000000000")
    route_batch(Lake(spark, root), batch, "run-0000000000")
    rows = _rows(Lake(spark, root))
    assert rows["connectivity_events"] == 1 and rows["rejected_events"] == 1
    assert sum(rows.values()) == 2


def test_a_retried_record_can_move_to_another_table(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    route_batch(lake, raw_rows(spark, encoded(CONNECTIVITY)), "run-0000000000")
    route_batch(lake, raw_rows(spark, (b"", "network.connectivity")), "run-0000000000")
    rows = _rows(lake)
    assert rows["connectivity_events"] == 0 and rows["rejected_events"] == 1


def test_day_bounds_prune_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from beaconlake.functions.timing import since
    lake = Lake(spark, str(tmp_path / "lake"))
    route_batch(lake, raw_rows(spark, encoded(CONNECTIVITY)), "run-0000000000")
    recent = since(lake.read("connectivity_events"), "event_timestamp",
                   F.lit(ARRIVED.replace(hour=0)))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "event_day" in filters and recent.count() == 1
    assert "event_timestamp" in plan.split("PushedFilters: [")[1].split("]")[0]


def test_reports_and_checks_prune_every_event_scan(spark, sf_dir, tmp_path):
    from datetime import timedelta

    from pyspark.sql import functions as F

    from beaconlake.operators import quality
    from beaconlake.plans import accounting
    lake = Lake(spark, str(tmp_path / "lake"))
    route_batch(lake, raw_rows(spark, encoded(CONNECTIVITY)), "run-0000000000")
    inventory = benchdata.network_tables(spark, sf_dir)
    tables = lake.tables(devices=inventory.devices, sites=inventory.sites)
    now = F.lit(ARRIVED.replace(hour=22))

    def days_filtered(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("_day#") > 0 and plan.count("isnull(arrival_day#") + plan.count(
            "isnull(event_day#") >= len(EVENT_TABLES)

    for report in (accounting.accepted_event_totals, accounting.reconciliation):
        plan = report(tables)._jdf.queryExecution().optimizedPlan().toString()
        scans = [line for line in plan.splitlines() if "Relation [" in line and "_kafka_topic" in line]
        assert scans and plan.count("isnull(event_day#") + plan.count("isnull(arrival_day#") >= len(scans)
        assert "scalar-subquery" not in plan and "Anti" not in plan
    assert accounting.accepted_event_totals(tables).first()["event_count"] == 1
    assert days_filtered(accounting.duplicate_origin(tables, as_of=now))
    assert days_filtered(accounting.late_records(tables, as_of=now))
    probes = {p.checks[0]: p for p in quality.event_probes(tables, timedelta(hours=6), now)
              if "events_from_unknown_devices" not in p.checks
              and "silent_access_devices" not in p.checks}
    assert days_filtered(probes["replay_duplicate_rows"].build())
    assert days_filtered(probes["reject_pct"].build())
    found = accounting.duplicate_origin(tables, as_of=now).first()
    assert (found["table_name"], found["total_rows"]) == ("connectivity_events", 1)


def test_empty_lake_reads_as_empty_tables(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "nothing"))
    assert all(lake.read(t).count() == 0 for t in EVENT_TABLES)
