"""Accounting reports: what was accepted, delivered twice, lost or late."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordered import with_previous_max
from ..functions.statistics import percent_of
from ..functions.timing import before, micros_between, seconds, since
from ..model import FAMILIES, NetworkTables, newest

# Offsets per ordering bucket of the lateness report. Offsets are unique within a topic
# partition and a device stays in one partition, so a bucket holds at most this many
# records of a device (plus replayed copies).
OFFSETS_PER_BUCKET = 1_000_000


def accepted_event_totals(
    tables: NetworkTables, window: timedelta = timedelta(hours=6)
) -> DataFrame:
    """Accepted events per family and inventory dimensions, each event_id counted once.

    Window: measured since `window` before the newest connectivity measurement. Events
    of devices missing from the inventory stay, with NULL dimensions. Events are counted
    per device before the inventory joins, so the joins see devices, not events.
    """
    bound = before(tables.newest("connectivity_events", "event_timestamp"), window)
    events = tables.stacked("event_type", "event_id", "device_id", "event_timestamp")
    per_device = (
        since(events, "event_timestamp", bound)
        .select("event_type", "event_id", "device_id").distinct()
        .groupBy("event_type", "device_id").agg(F.count(F.lit(1)).alias("events"))
    )
    devices = tables.devices.select(
        "device_id", "site_id", "provider_name", "technology", "infrastructure_role"
    )
    grain = ["event_type", "provider_name", "technology", "region", "infrastructure_role"]
    return (
        per_device.join(devices, "device_id", "left")
        .join(tables.sites.select("site_id", "region"), "site_id", "left")
        .groupBy(*grain).agg(F.sum("events").alias("event_count"))
        .orderBy(*grain)
    )


def reconciliation(tables: NetworkTables, window: timedelta = timedelta(hours=6)) -> DataFrame:
    """Stored, unique, duplicate, missing and rejected records per topic.

    Window: arrived since `window` before the newest connectivity arrival. Missing
    numbers are holes in the observed sequence range of each (topic, device, session);
    rejected records and the window's edges show as holes or shorter ranges. A topic
    with rejects only does not appear.
    """
    bound = before(tables.newest("connectivity_events", "_kafka_timestamp"), window)
    events = tables.stacked(
        "_kafka_topic", "event_id", "device_id", "device_session_id", "sequence_number",
        "_kafka_timestamp",
    )
    streams = (
        since(events, "_kafka_timestamp", bound)
        .groupBy("_kafka_topic", "device_id", "device_session_id")
        .agg(
            F.count(F.lit(1)).alias("stored_rows"),
            F.count_distinct("event_id").alias("unique_events"),
            (F.max("sequence_number") - F.min("sequence_number") + 1
             - F.count_distinct("sequence_number")).alias("missing_sequence_numbers"),
        )
    )
    per_topic = streams.groupBy("_kafka_topic").agg(
        *[F.sum(c).alias(c)
          for c in ("stored_rows", "unique_events", "missing_sequence_numbers")]
    )
    rejects = (
        since(tables.rejected_events, "_kafka_timestamp", bound)
        .groupBy("_kafka_topic").agg(F.count(F.lit(1)).alias("rejected"))
    )
    return (
        per_topic.join(rejects, "_kafka_topic", "left")
        .select(
            F.col("_kafka_topic").alias("kafka_topic"), "stored_rows", "unique_events",
            (F.col("stored_rows") - F.col("unique_events")).alias("duplicate_rows"),
            "missing_sequence_numbers",
            F.coalesce("rejected", F.lit(0)).alias("rejected_rows"),
        )
        .orderBy("kafka_topic")
    )


def late_records(
    tables: NetworkTables, window: timedelta = timedelta(hours=6),
    as_of: Column | None = None, lookback: timedelta = timedelta(days=2),
) -> DataFrame:
    """Late records per measurement hour and family.

    A record is late when an earlier record (by offset) of the same device and family
    was measured more than one reporting cadence after it. Window: `window` before the
    newest connectivity measurement, searched for within `lookback` of `as_of`.
    """
    now = F.current_timestamp() if as_of is None else as_of
    recent = since(tables.connectivity_events, "event_timestamp", before(now, lookback))
    bound = before(newest(recent, "event_timestamp"), window)
    arrived = since(
        tables.stacked("event_type", "device_id", "event_timestamp", "_kafka_offset"),
        "event_timestamp", bound,
    ).select(
        F.col("event_type").alias("event_family"), "device_id", "event_timestamp",
        "_kafka_offset",
    )
    ordered = with_previous_max(
        arrived, ["event_family", "device_id"], "_kafka_offset", "event_timestamp",
        F.floor(F.col("_kafka_offset") / F.lit(OFFSETS_PER_BUCKET)), "_newest_before",
    )
    cadence = F.coalesce(*[
        F.when(F.col("event_family") == f.event_type, F.lit(f.cadence_seconds)) for f in FAMILIES
    ])
    behind = ordered.select(
        F.date_trunc("hour", "event_timestamp").alias("measurement_hour"), "event_family",
        micros_between(F.col("event_timestamp"), F.col("_newest_before")).alias("_behind"),
        (cadence.cast("bigint") * 1_000_000).alias("_allowed"),
    ).withColumn("_late_by", F.when(F.col("_behind") > F.col("_allowed"), F.col("_behind")))
    return (
        behind.groupBy("measurement_hour", "event_family")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("_late_by").alias("late_records"),
            F.round(percent_of(F.count("_late_by"), F.count(F.lit(1))), 4).alias("late_pct"),
            seconds(F.max("_late_by")).alias("max_lateness_seconds"),
        )
        .orderBy("measurement_hour", "event_family")
    )


def duplicate_origin(
    tables: NetworkTables, as_of: Column | None = None,
    window: timedelta = timedelta(hours=6), prune: timedelta = timedelta(days=2),
) -> DataFrame:
    """Duplicate rows per event table, split into replays and upstream resends.

    A replay is the same (topic, partition, offset) stored again; a resend is the same
    event_id under another offset. Window on arrival time; the looser `prune` bound on
    measurement time only skips old day partitions. Copies are counted per source record
    first, so an event with very many copies is spread before it is reduced.
    """
    now = F.current_timestamp() if as_of is None else as_of
    coordinates = ["_kafka_topic", "_kafka_partition", "_kafka_offset"]
    events = since(
        tables.stacked("event_id", *coordinates, "_kafka_timestamp", "event_timestamp"),
        "_kafka_timestamp", before(now, window),
    )
    events = since(events, "event_timestamp", before(now, prune))
    per_record = events.groupBy("table_name", "event_id", *coordinates).agg(
        F.count(F.lit(1)).alias("stored")
    )
    per_event = per_record.groupBy("table_name", "event_id").agg(
        F.sum("stored").alias("copies"), F.count(F.lit(1)).alias("records")
    )
    extra = F.sum(F.col("copies") - 1)
    return (
        per_event.groupBy("table_name")
        .agg(
            F.sum("copies").alias("total_rows"),
            F.count_if(F.col("copies") > 1).alias("duplicated_events"),
            extra.alias("extra_rows"),
            F.sum(F.col("copies") - F.col("records")).alias("replay_rows"),
            F.sum(F.col("records") - 1).alias("upstream_rows"),
            F.round(percent_of(extra, F.sum("copies")), 3).alias("duplicate_pct"),
        )
        .orderBy("table_name")
    )
