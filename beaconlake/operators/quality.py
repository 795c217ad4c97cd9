"""Data-quality checks: one number each, compared with a threshold.

Checks that read the same rows share one pass: a `Probe` is a one-row DataFrame whose
columns are the values of its checks. `findings` is one lazy DataFrame over all probes;
`run` executes probe by probe, so that one failing probe cannot hide the others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import with_previous_value
from ..functions.statistics import percent_of, percentile
from ..functions.timing import before, micros_between, minutes, since
from ..model import ACCESS_ROLE, IXP_ROLE, NetworkTables
from .reference_rules import KEYS

FINDING_DDL = (
    "name string, category string, severity string, threshold double, value double, "
    "status string, error string"
)
COORDINATES = ("_kafka_topic", "_kafka_partition", "_kafka_offset")


@dataclass(frozen=True)
class Check:
    name: str
    category: str
    severity: str
    threshold: float
    description: str


# Names, severities and thresholds of the 22 checks.
_COUNTED = ("sites", "devices", "device_dependencies", "census_block_groups")
CHECKS: dict[str, Check] = {c.name: c for c in [
    *[Check(f"{t}_row_count_vs_manifest", "reference", "fail", 0,
            f"rows of {t} more or less than the manifest states") for t in _COUNTED],
    *[Check(f"{t}_duplicate_keys", "reference", "fail", 0, f"rows of {t} sharing a key")
      for t in _COUNTED],
    Check("sites_orphan_block_group", "reference", "fail", 0, "sites without block group"),
    Check("devices_orphan_site", "reference", "fail", 0, "devices without site"),
    Check("dependencies_orphan_downstream", "reference", "fail", 0, "unknown lower device"),
    Check("dependencies_orphan_upstream", "reference", "fail", 0, "unknown upper device"),
    Check("non_ixp_devices_without_upstream", "reference", "fail", 0, "devices left loose"),
    Check("events_from_unknown_devices", "event", "fail", 0, "rows of devices not listed"),
    Check("events_with_wrong_site", "event", "fail", 0, "rows whose site is not the device's"),
    Check("replay_duplicate_rows", "event", "warn", 0, "source records stored again"),
    Check("upstream_duplicate_pct", "event", "warn", 1.0, "% of rows repeating an event_id"),
    Check("reject_pct", "event", "warn", 1.0, "% of delivered records rejected"),
    Check("minutes_since_last_arrival", "event", "warn", 15, "minutes since newest arrival"),
    Check("stalled_beyond_kafka_retention", "event", "fail", 120,
          "minutes since newest arrival, past what the broker keeps"),
    Check("source_clock_skew_minutes", "event", "warn", 5,
          "median minutes from measurement to arrival"),
    Check("silent_access_devices", "event", "warn", 0, "access devices sending nothing"),
]}


@dataclass(frozen=True)
class Probe:
    category: str
    checks: tuple[str, ...]
    build: Callable[[], DataFrame]  # one row, one column per check


def _one_row(df: DataFrame, **values: Column) -> DataFrame:
    return df.agg(*[v.cast("double").alias(k) for k, v in values.items()])


def reference_probes(tables: NetworkTables, manifest: dict[str, int]) -> list[Probe]:
    """Sizes and relations of the reference tables. `manifest`: expected rows per table."""
    def size(table: str) -> Probe:
        names = (f"{table}_row_count_vs_manifest", f"{table}_duplicate_keys")
        rows = F.count(F.lit(1))
        return Probe("reference", names, lambda: _one_row(
            tables.table(table),
            **{names[0]: F.abs(rows - F.lit(manifest[table])),
               names[1]: rows - F.count_distinct(KEYS[table])}))

    def lonely(name: str, rows, key: str, target: str, target_key: str) -> Probe:
        return Probe("reference", (name,), lambda: _one_row(
            rows().select(F.col(key).alias("key")).join(
                tables.table(target).select(F.col(target_key).alias("key")), "key",
                "left_anti"), **{name: F.count(F.lit(1))}))

    return [
        *[size(t) for t in _COUNTED],
        lonely("sites_orphan_block_group", lambda: tables.sites, "block_group_geoid",
               "census_block_groups", "block_group_geoid"),
        lonely("devices_orphan_site", lambda: tables.devices, "site_id", "sites", "site_id"),
        lonely("dependencies_orphan_downstream", lambda: tables.device_dependencies,
               "downstream_device_id", "devices", "device_id"),
        lonely("dependencies_orphan_upstream", lambda: tables.device_dependencies,
               "upstream_device_id", "devices", "device_id"),
        lonely("non_ixp_devices_without_upstream",
               lambda: tables.devices.where(F.col("infrastructure_role") != IXP_ROLE),
               "device_id", "device_dependencies", "downstream_device_id"),
    ]


def event_probes(
    tables: NetworkTables, window: timedelta = timedelta(hours=6), as_of: Column | None = None
) -> list[Probe]:
    """Quality of the records that arrived in the window."""
    now = F.current_timestamp() if as_of is None else as_of
    bound = before(now, window)

    def arrived(df: DataFrame) -> DataFrame:
        return since(df, "_kafka_timestamp", bound)

    def devices() -> DataFrame:
        # One row per (device, site) meets the inventory instead of one per event.
        seen = (
            arrived(tables.stacked("device_id", "site_id", "_kafka_timestamp"))
            .groupBy("device_id", "site_id").agg(F.count(F.lit(1)).alias("events"))
        )
        listed = tables.devices.select("device_id", F.col("site_id").alias("listed_site"),
                                       F.lit(True).alias("listed"))
        met = seen.join(listed, "device_id", "left")
        wrong = F.col("site_id") != F.col("listed_site")
        return _one_row(
            met,
            events_from_unknown_devices=F.coalesce(
                F.sum(F.when(F.col("listed").isNull(), F.col("events"))), F.lit(0)),
            events_with_wrong_site=F.coalesce(
                F.sum(F.when(wrong, F.col("events"))), F.lit(0)))

    def identity() -> DataFrame:
        rows = F.count(F.lit(1))
        return _one_row(
            arrived(tables.stacked("event_id", *COORDINATES, "_kafka_timestamp")),
            replay_duplicate_rows=rows - F.count_distinct(F.struct(*COORDINATES)),
            upstream_duplicate_pct=percent_of(rows - F.count_distinct("event_id"), rows))

    def rejects() -> DataFrame:
        accepted = arrived(tables.stacked("_kafka_timestamp")).select(F.lit(0).alias("rejected"))
        refused = arrived(tables.rejected_events).select(F.lit(1).alias("rejected"))
        return _one_row(accepted.unionByName(refused), reject_pct=percent_of(
            F.sum("rejected"), F.count(F.lit(1))))

    def clocks() -> DataFrame:
        age = minutes(micros_between(F.max("_kafka_timestamp"), now))
        skew = micros_between(F.col("event_timestamp"), F.col("_kafka_timestamp"))
        rows = arrived(tables.connectivity_events).select("event_timestamp", "_kafka_timestamp")
        return _one_row(
            rows, minutes_since_last_arrival=age,
            stalled_beyond_kafka_retention=F.coalesce(age, F.lit(1e9)),
            source_clock_skew_minutes=minutes(percentile(skew, 0.5)))

    def silent() -> DataFrame:
        access = tables.devices.where(F.col("infrastructure_role") == ACCESS_ROLE)
        heard = arrived(tables.connectivity_events).select("device_id").distinct()
        return _one_row(
            access.select("device_id").join(heard, "device_id", "left_anti"),
            silent_access_devices=F.count(F.lit(1)))

    return [
        Probe("event", ("events_from_unknown_devices", "events_with_wrong_site"), devices),
        Probe("event", ("replay_duplicate_rows", "upstream_duplicate_pct"), identity),
        Probe("event", ("reject_pct",), rejects),
        Probe("event", ("minutes_since_last_arrival", "stalled_beyond_kafka_retention",
                        "source_clock_skew_minutes"), clocks),
        Probe("event", ("silent_access_devices",), silent),
    ]


def values(probes: Iterable[Probe]) -> DataFrame:
    """(name, value) of every check of the probes."""
    parts = []
    for probe in probes:
        pairs = F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in probe.checks])
        parts.append(probe.build().select(F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts)


def evaluated(named_values: DataFrame) -> DataFrame:
    """Findings from (name, value, error): an error fails, a value over the threshold gets
    the check's severity, anything else (NULL included) is ok."""
    def known(attribute: str) -> Column:
        return F.coalesce(*[
            F.when(F.col("name") == c.name, F.lit(getattr(c, attribute)))
            for c in CHECKS.values()])

    judged = named_values.withColumns({
        "category": known("category"), "severity": known("severity"),
        "threshold": known("threshold").cast("double"),
    })
    status = (
        F.when(F.col("error").isNotNull(), "fail")
        .when(F.col("value") > F.col("threshold"), F.col("severity")).otherwise("ok")
    )
    return judged.select(
        "name", "category", "severity", "threshold", "value", status.alias("status"), "error")


def findings(probes: Iterable[Probe]) -> DataFrame:
    return evaluated(values(probes).withColumn("error", F.lit(None).cast("string")))


def run(spark: SparkSession, probes: Iterable[Probe]) -> DataFrame:
    """Findings with errors isolated: one job per probe, one row each to the driver."""
    found = []
    for probe in probes:
        try:
            row = probe.build().first()
            found += [(c, row[c], None) for c in probe.checks]
        except Exception as error:  # a broken probe is a finding, not the end of the run
            found += [(c, None, str(error)) for c in probe.checks]
    return evaluated(spark.createDataFrame(found, "name string, value double, error string"))


def ordered_findings(found: DataFrame) -> DataFrame:
    """Failures first, then warnings, then the rest; by name within."""
    rank = F.when(F.col("status") == "fail", 0).when(F.col("status") == "warn", 1).otherwise(2)
    return found.orderBy(rank, "name")


def summary(found: DataFrame) -> DataFrame:
    """One row: counts per status, groups without findings, and whether the run failed.
    Warnings never fail it; a missing group does."""
    missing = F.array_except(
        F.array(F.lit("reference"), F.lit("event")), F.collect_set("category"))
    totals = found.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in ("fail", "warn", "ok")],
        F.concat_ws(", ", missing).alias("missing_groups"))
    return totals.withColumn("failed", (F.col("fail") > 0) | (F.col("missing_groups") != ""))


# The health signal of each access technology.
TECHNOLOGY_SIGNAL = {
    "fiber": "optical_rx_power_dbm",
    "coax": "snr_db",
    "fixed_wireless": "signal_strength_dbm",
    "satellite": "signal_quality_pct",
}
# The life cycle of device states and of incidents.
STATE_STEPS = (("online", "degraded"), ("degraded", "offline"), ("offline", "degraded"),
               ("degraded", "online"))
INCIDENT_STEPS = (("", "congestion_started"), ("congestion_started", "outage_started"),
                  ("outage_started", "recovery_started"), ("recovery_started", "recovered"))


def technology_signal(tables: NetworkTables) -> DataFrame:
    """Health rows of known devices whose signals are not exactly the one of the device's
    technology (none for infrastructure), counted per what was expected and sent."""
    sent = F.concat_ws(", ", *[
        F.when(F.col(c).isNotNull(), F.lit(c)) for c in TECHNOLOGY_SIGNAL.values()])
    per_device = (
        tables.device_health_events.select("device_id", sent.alias("sent"))
        .groupBy("device_id", "sent").agg(F.count(F.lit(1)).alias("rows"))
    )
    wanted = F.coalesce(*[
        F.when((F.col("infrastructure_role") == ACCESS_ROLE) & (F.col("technology") == t), signal)
        for t, signal in TECHNOLOGY_SIGNAL.items()
    ], F.lit(""))
    listed = tables.devices.select("device_id", "technology", wanted.alias("expected"))
    return (
        per_device.join(listed, "device_id").where(F.col("sent") != F.col("expected"))
        .groupBy("technology", "expected", "sent").agg(F.sum("rows").alias("rows"))
    )


def transition_order(tables: NetworkTables) -> DataFrame:
    """Transitions outside the life cycle, of devices and of incidents, and device
    transitions that do not start where the previous one ended."""
    def step(low: Column, high: Column, steps) -> Column:
        allowed = reduce(lambda a, b: a | b, [(low == x) & (high == y) for x, y in steps])
        return F.coalesce(allowed, F.lit(False))

    order, hour = ["event_timestamp", "event_id"], F.date_trunc("hour", "event_timestamp")
    states = tables.connectivity_state_events.select(
        F.col("device_id").alias("subject"), *order, "previous_state", "new_state").distinct()
    chained = with_previous_value(states, ["subject"], order, "new_state", hour, "_before")
    moves = chained.select(
        "subject", "event_id", F.col("previous_state").alias("from_step"),
        F.col("new_state").alias("to_step"),
        (~step(F.col("previous_state"), F.col("new_state"), STATE_STEPS)).alias("bad_step"),
        F.coalesce(F.col("_before") != F.col("previous_state"), F.lit(False))
        .alias("broken_chain"))
    kinds = tables.infrastructure_events.select(
        F.col("incident_id").alias("subject"), *order, "event_kind").distinct()
    followed = with_previous_value(kinds, ["subject"], order, "event_kind", hour, "_before")
    came_from = F.coalesce("_before", F.lit(""))
    stages = followed.select(
        "subject", "event_id", came_from.alias("from_step"), F.col("event_kind").alias("to_step"),
        (~step(came_from, F.col("event_kind"), INCIDENT_STEPS)).alias("bad_step"),
        F.lit(False).alias("broken_chain"))
    return moves.unionByName(stages).where("bad_step OR broken_chain")
