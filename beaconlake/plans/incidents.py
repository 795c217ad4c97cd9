"""Availability from state transitions and the impact of shared incidents."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import with_next_value
from ..functions.statistics import percent_of
from ..functions.timing import before, micros_between, minutes, since
from ..model import NetworkTables, newest

DAY = timedelta(days=1)
# Fixed value: how long after recovery a state transition still belongs to an incident.
RECOVERY_MARGIN = timedelta(minutes=5)


def connectivity_availability(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """Minutes per state, offline periods and availability per device.

    A transition holds until the device's next one; the last holds until the newest
    connectivity measurement (and can therefore be negative when it is newer). Minutes
    are summed as whole microseconds, so the result does not depend on row order.
    """
    bound = before(F.current_timestamp() if as_of is None else as_of, window)
    states = since(tables.connectivity_state_events, "event_timestamp", bound).select(
        "event_id", "device_id", "event_timestamp", "new_state"
    ).distinct()
    ended_at = newest(
        since(tables.connectivity_events, "event_timestamp", bound), "event_timestamp"
    )
    held = with_next_value(
        states, ["device_id"], ["event_timestamp", "event_id"],
        F.date_trunc("hour", "event_timestamp"), "_until",
    ).select(
        "device_id", F.col("new_state").alias("state"),
        micros_between(F.col("event_timestamp"), F.coalesce("_until", ended_at)).alias("held"),
    )

    def held_in(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("held")).otherwise(0))

    state = F.col("state")
    return (
        held.groupBy("device_id")
        .agg(
            F.round(minutes(F.sum("held")), 1).alias("observed_minutes"),
            *[F.round(minutes(held_in(state == s)), 1).alias(f"{s}_minutes")
              for s in ("online", "degraded", "offline")],
            F.count_if(state == "offline").alias("offline_periods"),
            F.round(percent_of(held_in(state != "offline"), F.sum("held")), 2)
            .alias("availability_pct"),
        )
        .orderBy("availability_pct", "device_id")
    )


def upstream_paths(tables: NetworkTables) -> DataFrame:
    """Each access device with every device upstream of it, at most three hops."""
    edges = tables.device_dependencies.select("downstream_device_id", "upstream_device_id")

    def hop(n: int) -> DataFrame:
        return edges.select(
            F.col("downstream_device_id").alias(f"hop{n - 1}"),
            F.col("upstream_device_id").alias(f"hop{n}"),
        )

    first = tables.device_dependencies.where(
        F.col("dependency_type") == "access_aggregation"
    ).select(
        F.col("downstream_device_id").alias("access_device_id"),
        F.col("upstream_device_id").alias("hop1"),
    )
    chains = first.join(hop(2), "hop1", "left").join(hop(3), "hop2", "left")
    return (
        chains.select("access_device_id", F.explode(F.array("hop1", "hop2", "hop3"))
                      .alias("source_device_id"))
        .where(F.col("source_device_id").isNotNull())
        .distinct()
    )


def incident_impact(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """Each shared incident with the devices and critical sites downstream of it.

    The downstream set depends on the source device only, so its sizes are computed once
    per source; no (incident, device) pairs are formed for them. An incident id raised by
    several sources counts the union of their downstream sets, as each of its rows does;
    only such ids are expanded. State transitions meet incidents on (source, hour).
    """
    bound = before(F.current_timestamp() if as_of is None else as_of, window)
    events = since(tables.infrastructure_events, "event_timestamp", bound)
    # Minimum, maximum and "any" do not change with duplicates, so none are removed.
    incidents = events.groupBy(
        "incident_id", F.col("device_id").alias("source_device_id")
    ).agg(
        F.min("event_timestamp").alias("started_at"),
        F.max(F.when(F.col("event_kind") == "recovered", F.col("event_timestamp")))
        .alias("recovered_at"),
        F.bool_or(F.col("event_kind") == "outage_started").alias("had_outage"),
    )
    located = (
        tables.devices.select(F.col("device_id").alias("access_device_id"), "site_id")
        .join(tables.sites.select("site_id", "critical_infrastructure"), "site_id")
    )
    downstream = upstream_paths(tables).join(located, "access_device_id")

    def sizes(grouped) -> DataFrame:
        return grouped.agg(
            F.count_distinct("access_device_id").alias("_devices"),
            F.count_distinct(F.when(F.col("critical_infrastructure"), F.col("site_id")))
            .alias("_critical_sites"),
        )

    shared = (
        incidents.groupBy("incident_id").agg(F.count(F.lit(1)).alias("_sources"))
        .where(F.col("_sources") > 1).select("incident_id")
    )
    per_source = sizes(downstream.groupBy("source_device_id"))
    single = (
        incidents.join(shared, "incident_id", "left_anti")
        .select("incident_id", "source_device_id").join(per_source, "source_device_id")
        .select("incident_id", "_devices", "_critical_sites")
    )
    united = sizes(
        incidents.join(shared, "incident_id", "left_semi")
        .select("incident_id", "source_device_id").join(downstream, "source_device_id")
        .groupBy("incident_id")
    )
    impact = single.unionByName(united)

    sources = tables.devices.select(
        F.col("device_id").alias("source_device_id"),
        F.col("infrastructure_role").alias("source_role"),
    )
    changes = _state_changes(
        since(tables.connectivity_state_events, "event_timestamp", bound), incidents, downstream)
    return (
        incidents.join(sources, "source_device_id")
        .join(impact, "incident_id", "left")
        .join(changes, "incident_id", "left")
        .groupBy("incident_id", "source_device_id", "source_role", "started_at",
                 "recovered_at", "had_outage")
        .agg(
            F.coalesce(F.max("_devices"), F.lit(0)).alias("impacted_access_devices"),
            F.coalesce(F.max("_critical_sites"), F.lit(0)).alias("impacted_critical_sites"),
            F.coalesce(F.max("_changed"), F.lit(0)).alias("devices_with_state_change"),
        )
        .select(
            "incident_id", "source_device_id", "source_role", "started_at", "recovered_at",
            F.round(minutes(micros_between(F.col("started_at"), F.col("recovered_at"))), 1)
            .alias("duration_minutes"),
            "had_outage", "impacted_access_devices", "impacted_critical_sites",
            "devices_with_state_change",
        )
        .orderBy("started_at", "incident_id")
    )


def _state_changes(
    states: DataFrame, incidents: DataFrame, downstream: DataFrame
) -> DataFrame:
    """Distinct downstream devices with a transition during each incident. No incident
    starts before the report's window, so neither do the transitions that count."""
    ends_at = F.coalesce("recovered_at", "started_at") + F.lit(RECOVERY_MARGIN)
    spans = incidents.select("incident_id", "started_at", ends_at.alias("ends_at"))
    # Every source of an incident id meets every span of that id.
    windows = (
        incidents.select("incident_id", "source_device_id").join(spans, "incident_id")
        .withColumn("hour", F.explode(F.sequence(
            F.date_trunc("hour", "started_at"), F.date_trunc("hour", "ends_at"),
            F.expr("INTERVAL 1 HOUR"),
        )))
    )
    transitions = (
        states.select(F.col("device_id").alias("access_device_id"), "event_timestamp")
        .join(downstream.select("access_device_id", "source_device_id"), "access_device_id")
        .withColumn("hour", F.date_trunc("hour", "event_timestamp"))
    )
    return (
        transitions.join(windows, ["source_device_id", "hour"])
        .where(F.col("event_timestamp").between(F.col("started_at"), F.col("ends_at")))
        .groupBy("incident_id").agg(F.count_distinct("access_device_id").alias("_changed"))
    )
