"""Registered queries: each runs one operator over the whole bench tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlake.model import ACCESS_ROLE, EVENT_TABLES, NetworkTables, newest
from beaconlake.operators import geography, ingest, quality, reference_rules
from beaconlake.plans import accounting, exploring, incidents, performance
from beaconlake.sources import benchdata

from . import lake_queries

Query = Callable[[SparkSession, str], DataFrame]
ALL_HISTORY = timedelta(days=60)


def _as_of(tables: NetworkTables) -> Column:
    """The data's own clock: its newest connectivity measurement."""
    return newest(tables.connectivity_events, "event_timestamp")


def _arrived_as_of(tables: NetworkTables) -> Column:
    return newest(tables.connectivity_events, "_kafka_timestamp")


def _report(build, **fixed) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = benchdata.network_tables(spark, sf_dir)
        return build(tables, as_of=_as_of(tables), window=ALL_HISTORY, **fixed)
    return run


def accepted_event_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.accepted_event_totals(
        benchdata.network_tables(spark, sf_dir), ALL_HISTORY)


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accounting.reconciliation(
        benchdata.network_tables(spark, sf_dir, sequenced_stack=True), ALL_HISTORY)


def late_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = benchdata.network_tables(spark, sf_dir)
    return accounting.late_records(tables, ALL_HISTORY, _as_of(tables), ALL_HISTORY)


def duplicate_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = benchdata.network_tables(spark, sf_dir)
    return accounting.duplicate_origin(
        tables, _arrived_as_of(tables), ALL_HISTORY, ALL_HISTORY)


def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exploring.reject_reasons(benchdata.network_tables(spark, sf_dir))


def contract_reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = ingest.classify(benchdata.raw_records(spark, sf_dir), benchdata.ACCESS_DIGITS)
    return ingest.rejected_rows(classified).select(
        "_kafka_topic", "_kafka_partition", "_kafka_offset", "rejection_reason")


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = ingest.classify(benchdata.raw_records(spark, sf_dir), benchdata.ACCESS_DIGITS)
    prefix = ingest.PREFIX
    return (
        classified.where(F.col("rejection_reason").startswith(prefix))
        .groupBy(F.expr(f"substring(rejection_reason, {len(prefix) + 1})").alias("violation"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejected(benchdata.raw_records(spark, sf_dir), benchdata.ACCESS_DIGITS).select(
        "_kafka_topic", "_kafka_partition", "_kafka_offset", "_kafka_timestamp",
        "rejection_reason", "_kafka_key")


def _typed(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = benchdata.raw_records(spark, sf_dir)
        return ingest.typed_events(raw, table, benchdata.ACCESS_DIGITS).drop("_ingested_at")  # processing time differs
    return run


def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = benchdata.device_messages(spark, sf_dir)
    return (
        ingest.route_messages(messages)
        .groupBy("device_topic", "kafka_topic",
                 F.decode("kafka_key", "UTF-8").alias("kafka_key"), "routing_error")
        .agg(F.count(F.lit(1)).alias("messages"))
    )


def skipped_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    committed, earliest = benchdata.offset_tables(spark, sf_dir)
    return ingest.skipped_offsets(committed, earliest)


def _rule(rule) -> Query:
    return lambda spark, sf_dir: rule(benchdata.delivered_inventory(spark, sf_dir))


def ref_count_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_rules.count_mismatch(
        benchdata.delivered_inventory(spark, sf_dir), benchdata.manifest_counts(spark, sf_dir))


def ref_violation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference_rules.summarised(reference_rules.violations(
        benchdata.delivered_inventory(spark, sf_dir), benchdata.manifest_counts(spark, sf_dir)))


def _probes(spark: SparkSession, sf_dir: str, category: str | None = None) -> list:
    tables = benchdata.network_tables(spark, sf_dir)
    probes = []
    if category != "event":
        expected = {r["label"]: r["expected"]
                    for r in benchdata.manifest_counts(spark, sf_dir).collect()}
        probes += quality.reference_probes(tables, expected)
    if category != "reference":
        now = newest(tables.stacked("_kafka_timestamp"), "_kafka_timestamp")
        probes += quality.event_probes(tables, ALL_HISTORY, now)
    return probes


def _checks(category: str, *wanted: str) -> Query:
    """Values of the checks whose name contains one of the texts."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        probes = [
            quality.Probe(p.category, kept, p.build) for p in _probes(spark, sf_dir, category)
            if (kept := tuple(c for c in p.checks if any(w in c for w in wanted)))
        ]
        return quality.values(probes)
    return run


def dq_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.findings(_probes(spark, sf_dir))
    return quality.ordered_findings(found).drop("error")


def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.summary(quality.findings(_probes(spark, sf_dir)))


def _on_tables(build) -> Query:
    return lambda spark, sf_dir: build(benchdata.network_tables(spark, sf_dir))


def developed_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = geography.developed_score(benchdata.network_tables(spark, sf_dir))
    return scores.withColumn("developed_score", F.round("developed_score", 9))


def nearest_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = geography.nearest_devices(benchdata.network_tables(spark, sf_dir), "device-0000")
    return near.withColumn("distance_km", F.round("distance_km", 6))


def nearest_devices_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five access devices nearest to every other device of the network."""
    tables = benchdata.network_tables(spark, sf_dir)
    anchors = tables.devices.where(F.col("infrastructure_role") != ACCESS_ROLE).select(
        F.col("device_id").alias("anchor_id"))
    return geography.nearest_devices_all(tables, anchors, 5).withColumn(
        "distance_km", F.round("distance_km", 6))


def reject_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exploring.reject_samples(benchdata.network_tables(spark, sf_dir), 2)
    return found.select("rejection_reason", "place", "_kafka_topic", "_kafka_partition", "_kafka_offset",
                        (F.col("raw_payload").isNotNull()).alias("has_payload"))


def hash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return geography.hash_bands(events, 42, "event_type", "user_id", "event_id")


QUERIES: dict[str, Query] = {
    "technology_statistics": _report(performance.technology_statistics),
    "accepted_event_totals": accepted_event_totals,
    "reconciliation": reconciliation,
    "device_statistics": _report(performance.device_statistics),
    "underperforming_devices": _report(performance.peer_comparison),
    "underperforming_devices_rounded": _report(performance.underperforming_devices),
    "provider_technology_cohorts": _report(performance.provider_technology_cohorts),
    "geographic_performance": _report(performance.geographic_performance),
    "connectivity_availability": _report(incidents.connectivity_availability),
    "incident_impact": _report(incidents.incident_impact),
    "late_records": late_records,
    "duplicate_origin": duplicate_origin,
    "latest_arrivals": _report(exploring.latest_arrivals),
    "arrival_delay_by_minute": _report(exploring.arrival_delay_by_minute),
    "speed_vs_plan": _report(exploring.speed_vs_plan),
    "reject_reasons": reject_reasons,
    "contract_reject_reasons": contract_reject_reasons,
    "contract_violations": contract_violations,
    "rejected_events": rejected_events,
    **{f"typed_{t.replace('connectivity_state', 'state')}": _typed(t) for t in EVENT_TABLES},
    "route_topics": route_topics,
    "skipped_offsets": skipped_offsets,
    "ref_missing_required": _rule(reference_rules.missing_required),
    "ref_duplicate_keys": _rule(reference_rules.duplicate_keys),
    "ref_count_mismatch": ref_count_mismatch,
    "ref_bad_geoid": _rule(reference_rules.bad_geoids),
    "ref_out_of_bounds": _rule(reference_rules.out_of_bounds),
    "ref_negative_values": _rule(reference_rules.negative_values),
    "ref_orphans": _rule(reference_rules.orphans),
    "ref_speed_rules": _rule(reference_rules.speed_rules),
    "ref_site_device_count": _rule(reference_rules.site_device_count),
    "ref_upstream_rules": _rule(reference_rules.upstream_rules),
    "ref_unrooted_devices": _rule(reference_rules.unrooted_devices),
    "ref_dependency_roles": _rule(reference_rules.dependency_roles),
    "ref_violation_summary": ref_violation_summary,
    "dq_row_counts": _checks("reference", "_row_count_"),
    "dq_duplicate_keys": _checks("reference", "_duplicate_keys"),
    "dq_orphans": _checks("reference", "_orphan_", "_without_upstream"),
    "dq_unknown_devices": _checks("event", "events_from_unknown_devices"),
    "dq_wrong_site": _checks("event", "events_with_wrong_site"),
    "dq_replay_rows": _checks("event", "replay_duplicate_rows"),
    "dq_duplicate_pct": _checks("event", "upstream_duplicate_pct"),
    "dq_reject_pct": _checks("event", "reject_pct"),
    "dq_freshness": _checks("event", "minutes_since_last_arrival", "stalled_beyond"),
    "dq_clock_skew": _checks("event", "source_clock_skew_minutes"),
    "dq_silent_devices": _checks("event", "silent_access_devices"),
    "dq_findings": dq_findings,
    "dq_summary": dq_summary,
    "dq_technology_signal": _on_tables(quality.technology_signal),
    "dq_transition_order": _on_tables(quality.transition_order),
    "density_percentile": _on_tables(
        lambda tables: geography.density_percentile(tables.census_block_groups)),
    "developed_score": developed_score,
    "nearest_devices": nearest_devices,
    "nearest_devices_all": nearest_devices_all,
    "reject_samples": reject_samples,
    "eligible_cohorts": _on_tables(
        lambda tables: geography.eligible_cohorts(tables, "agg-00", "device-0000")),
    "hash_bands": hash_bands,
    **lake_queries.QUERIES,
}
