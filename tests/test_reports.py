from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from beaconlake.functions import ordered
from beaconlake.model import REFERENCE_DDL, NetworkTables, event_schema, schema_of
from beaconlake.plans import accounting, incidents, performance, registry
from beaconlake.sources import benchdata

T0 = datetime(2026, 9, 1, 12)


def _events(spark, table, rows):
    """Rows given as dicts; unnamed columns are NULL."""
    schema = event_schema(table)
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def _reference(spark, table, rows):
    schema = schema_of(REFERENCE_DDL[table])
    return spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in rows], schema)


def _at(minutes):
    return T0 + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def hot(spark):
    """One key with most rows, spread over several buckets, and gaps between buckets."""
    rows = [("hot", i * 7 % 1000, i % 13) for i in range(1000)] + [("cold", 5, 1), ("cold", 900, 0)]
    return spark.createDataFrame(rows, "key string, place int, value int")


@pytest.mark.parametrize("width", [10, 333, 5000])
def test_bucketed_windows_equal_plain_windows(hot, width):
    by_key = Window.partitionBy("key").orderBy("place")
    bucket = F.floor(F.col("place") / width)
    plain = hot.select(
        "key", "place", F.lead("place").over(by_key).alias("a"),
        F.max("value").over(by_key.rowsBetween(Window.unboundedPreceding, -1)).alias("b"),
        F.row_number().over(by_key).cast("bigint").alias("c"),
        F.lag("value").over(by_key).alias("d"))
    ours = ordered.with_next_value(hot, ["key"], ["place"], bucket, "a")
    ours = ordered.with_previous_max(ours, ["key"], "place", "value", bucket, "b")
    ours = ordered.with_row_number(ours, ["key"], "place", bucket, "c")
    ours = ordered.with_previous_value(ours, ["key"], ["place"], "value", bucket, "d")
    wanted = sorted(plain.collect())
    assert sorted(ours.select("key", "place", "a", "b", "c", "d").collect()) == wanted


def test_incident_id_of_two_sources_counts_the_union(spark):
    devices = [{"device_id": d, "site_id": f"s-{d}", "infrastructure_role": r} for d, r in [
        ("a1", "subscriber_edge"), ("a2", "subscriber_edge"), ("a3", "subscriber_edge"),
        ("g1", "aggregation"), ("g2", "aggregation"), ("b1", "backhaul"), ("x1", "ixp")]]
    sites = [{"site_id": f"s-{d['device_id']}", "critical_infrastructure": d["device_id"] == "a1"}
             for d in devices]
    edges = [("a1", "g1", "access_aggregation"), ("a2", "g1", "access_aggregation"),
             ("a3", "g2", "access_aggregation"), ("g1", "b1", "aggregation_backhaul"),
             ("g2", "b1", "aggregation_backhaul"), ("b1", "x1", "backhaul_ixp")]
    incident = [("shared", "g1", 0, "outage_started"), ("shared", "g2", 1, "outage_started"),
                ("shared", "g1", 30, "recovered"), ("core", "b1", 0, "congestion_started"),
                ("leaf", "g2", 10, "congestion_started"), ("leaf", "g2", 12, "recovered")]
    states = [("a1", 3), ("a1", 3), ("a3", 4), ("a2", 34.5), ("a2", 36), ("a3", 17.5)]
    tables = NetworkTables.of(
        devices=_reference(spark, "devices", devices),
        sites=_reference(spark, "sites", sites),
        device_dependencies=spark.createDataFrame(
            edges, REFERENCE_DDL["device_dependencies"]),
        infrastructure_events=_events(spark, "infrastructure_events", [
            {"event_id": f"i{n}", "incident_id": i, "device_id": d, "event_timestamp": _at(m),
             "event_kind": k} for n, (i, d, m, k) in enumerate(incident)]),
        connectivity_state_events=_events(spark, "connectivity_state_events", [
            {"event_id": f"s{n}", "device_id": d, "event_timestamp": _at(m), "new_state": "offline"}
            for n, (d, m) in enumerate(states)]),
    )
    rows = incidents.incident_impact(tables, F.lit(_at(60))).collect()
    found = {(r["incident_id"], r["source_device_id"]): (
        r["impacted_access_devices"], r["impacted_critical_sites"],
        r["devices_with_state_change"], r["duration_minutes"], r["had_outage"]) for r in rows}
    assert found == {
        # a2 changed at 34.5, inside the recovery margin of the span of g1 only.
        ("shared", "g1"): (3, 1, 3, 30.0, True),
        ("shared", "g2"): (3, 1, 3, None, True),
        ("core", "b1"): (3, 1, 2, None, False),   # a1 and a3 within 5 minutes of the start
        ("leaf", "g2"): (1, 0, 0, 2.0, False),    # a3 changed half a minute too late
    }
    plan = incidents.incident_impact(tables, F.lit(_at(60)))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_availability_counts_until_the_newest_measurement(spark):
    tables = NetworkTables.of(
        connectivity_state_events=_events(spark, "connectivity_state_events", [
            {"event_id": e, "device_id": "d", "event_timestamp": _at(m), "new_state": s}
            for e, m, s in [("1", 0, "degraded"), ("1", 0, "degraded"), ("2", 10, "offline"),
                            ("3", 25, "online")]]),
        connectivity_events=_events(spark, "connectivity_events", [
            {"event_id": "9", "device_id": "d", "event_timestamp": _at(100)}]))
    row = incidents.connectivity_availability(tables, F.lit(_at(100))).first()
    assert row.asDict() == {
        "device_id": "d", "observed_minutes": 100.0, "online_minutes": 75.0,
        "degraded_minutes": 10.0, "offline_minutes": 15.0, "offline_periods": 1,
        "availability_pct": 85.0}


def test_late_records_need_more_than_one_cadence(spark):
    empty = {t: _events(spark, t, []) for t in (
        "throughput_events", "device_health_events", "connectivity_state_events",
        "infrastructure_events")}
    rows = [(1, 0), (2, 10), (3, 5), (4, 4.99), (4, 4.99), (5, 20)]  # offset, second
    tables = NetworkTables.of(connectivity_events=_events(spark, "connectivity_events", [
        {"event_type": "connectivity_metric", "device_id": "d", "_kafka_offset": o,
         "event_timestamp": T0 + timedelta(seconds=s)} for o, s in rows]), **empty)
    row = accounting.late_records(tables, as_of=F.lit(_at(1))).first()
    assert (row["records"], row["late_records"], row["max_lateness_seconds"]) == (6, 2, 5.01)


def test_reports_with_an_empty_window_are_empty(spark, sf_dir):
    tables = benchdata.network_tables(spark, sf_dir)
    far = F.lit(datetime(2100, 1, 1))
    assert performance.technology_statistics(tables, far).count() == 0
    assert accounting.duplicate_origin(tables, far).count() == 0


def test_stored_is_unique_plus_duplicate_and_extra_is_replay_plus_resend(spark, sf_dir):
    tables = benchdata.network_tables(spark, sf_dir, sequenced_stack=True)
    history = timedelta(days=60)
    for r in accounting.reconciliation(tables, history).collect():
        assert r["stored_rows"] == r["unique_events"] + r["duplicate_rows"]
    now = F.lit(datetime(2024, 2, 1))
    for r in accounting.duplicate_origin(tables, now, history, history).collect():
        assert r["extra_rows"] == r["replay_rows"] + r["upstream_rows"]


def test_unknown_report_names_are_refused():
    with pytest.raises(ValueError, match="unknown report"):
        registry.report("../etc/passwd")
    assert len(registry.REPORTS) == 15
