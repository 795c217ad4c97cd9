"""Ad-hoc questions asked of the stored tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timing import before, micros_between, since
from ..model import NetworkTables

DAY = timedelta(days=1)


def _bound(as_of: Column | None, window: timedelta) -> Column:
    return before(F.current_timestamp() if as_of is None else as_of, window)


def latest_arrivals(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY, rows: int = 10
) -> DataFrame:
    """The throughput tests processed last, newest first (ties by partition and offset)."""
    recent = since(tables.throughput_events, "event_timestamp", _bound(as_of, window))
    return recent.select(
        "_ingested_at", "event_timestamp", "device_id", "download_mbps", "_kafka_partition",
        "_kafka_offset",
    ).orderBy(F.desc("_ingested_at"), "_kafka_partition", "_kafka_offset").limit(rows)


def arrival_delay_by_minute(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY, rows: int = 10
) -> DataFrame:
    """Average seconds from measurement to arrival per arrival minute, newest first."""
    recent = since(tables.throughput_events, "event_timestamp", _bound(as_of, window))
    delay = micros_between(F.col("event_timestamp"), F.col("_kafka_timestamp"))
    return (
        recent.groupBy(F.date_trunc("minute", "_kafka_timestamp").alias("arrived"))
        .agg(F.round(F.sum(delay).cast("double") / F.count(F.lit(1)) / 1_000_000.0, 1)
             .alias("avg_delay_seconds"))
        .orderBy(F.desc("arrived")).limit(rows)
    )


def speed_vs_plan(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = timedelta(hours=1)
) -> DataFrame:
    """Measured against advertised download per technology.

    Sums per device go into the join, so the inventory meets one row per device.
    """
    per_device = (
        since(tables.throughput_events, "event_timestamp", _bound(as_of, window))
        .groupBy("device_id")
        .agg(F.count(F.lit(1)).alias("tests"), F.sum("download_mbps").alias("downloaded"))
    )
    plans = tables.devices.select("device_id", "technology", "advertised_download_mbps")
    planned = F.col("advertised_download_mbps")
    return (
        per_device.join(plans, "device_id").groupBy("technology")
        .agg(
            F.sum("tests").alias("tests"),
            F.round(F.sum("downloaded") / F.sum("tests"), 1).alias("avg_download"),
            F.round(F.try_divide(
                F.sum(planned * F.col("tests")), F.sum(F.when(planned.isNotNull(), F.col("tests")))
            ), 1).alias("advertised"),
        )
        .orderBy("technology")
    )


def reject_reasons(tables: NetworkTables) -> DataFrame:
    """Rejected records per reason, most frequent first."""
    return (
        tables.rejected_events.groupBy("rejection_reason")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy(F.desc("records"), "rejection_reason")
    )


def reject_samples(tables: NetworkTables, per_reason: int = 3) -> DataFrame:
    """The earliest rejected records of each reason with payload and coordinates. A reason with
    most of the rejects is cut down to a few rows in each task before any are shuffled."""
    coordinates = ["_kafka_timestamp", "_kafka_topic", "_kafka_partition", "_kafka_offset"]
    place = F.row_number().over(Window.partitionBy("rejection_reason").orderBy(*coordinates))
    return tables.rejected_events.select(
        "rejection_reason", *coordinates, "raw_payload", place.alias("place")
    ).where(F.col("place") <= per_reason)
