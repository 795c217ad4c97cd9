"""Performance reports: latency, loss and speed by device, technology, provider, place.

Duplicates are kept in all of them: a resent event is an identical copy, so minima and
maxima do not change and percentiles hardly move, while removing copies would shuffle
every event id. All windows end at `as_of` (now unless given).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.statistics import percent_of, percentile, percentiles
from ..functions.timing import before, since
from ..model import ACCESS_ROLE, NetworkTables

DAY = timedelta(days=1)


def _recent(df: DataFrame, as_of: Column | None, window: timedelta, *columns: str) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return since(df, "event_timestamp", before(now, window)).select("device_id", *columns)


def _connectivity_statistics(rows: DataFrame, key: str) -> DataFrame:
    grouped = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("connectivity_samples"),
        F.min("latency_ms").alias("latency_ms_min"),
        percentiles("latency_ms", 0.5, 0.95).alias("_latency"),
        F.max("latency_ms").alias("latency_ms_max"),
        percentiles("jitter_ms", 0.5, 0.95).alias("_jitter"),
        percentiles("packet_loss_pct", 0.5, 0.95).alias("_loss"),
        F.max("packet_loss_pct").alias("packet_loss_pct_max"),
    )
    return grouped.select(
        key, "connectivity_samples", "latency_ms_min",
        F.col("_latency")[0].alias("latency_ms_median"),
        F.col("_latency")[1].alias("latency_ms_bad"),
        "latency_ms_max",
        F.col("_jitter")[0].alias("jitter_ms_median"),
        F.col("_jitter")[1].alias("jitter_ms_bad"),
        F.col("_loss")[0].alias("packet_loss_pct_median"),
        F.col("_loss")[1].alias("packet_loss_pct_bad"),
        "packet_loss_pct_max",
    )


def _throughput_statistics(rows: DataFrame, key: str) -> DataFrame:
    grouped = rows.groupBy(key).agg(
        F.count(F.lit(1)).alias("throughput_tests"),
        *[agg for c in ("download_mbps", "upload_mbps") for agg in (
            F.min(c).alias(f"{c}_min"), percentiles(c, 0.05, 0.5).alias(f"_{c}"),
            F.max(c).alias(f"{c}_max"),
        )],
    )
    return grouped.select(
        key, "throughput_tests",
        *[out for c in ("download_mbps", "upload_mbps") for out in (
            F.col(f"{c}_min"), F.col(f"_{c}")[0].alias(f"{c}_bad"),
            F.col(f"_{c}")[1].alias(f"{c}_median"), F.col(f"{c}_max"),
        )],
    )


def _statistics(
    tables: NetworkTables, key: str, as_of: Column | None, window: timedelta,
    devices: DataFrame | None = None,
) -> DataFrame:
    connectivity = _recent(
        tables.connectivity_events, as_of, window, "latency_ms", "jitter_ms", "packet_loss_pct"
    )
    throughput = _recent(
        tables.throughput_events, as_of, window, "download_mbps", "upload_mbps"
    )
    if devices is not None:
        connectivity = connectivity.join(devices, "device_id")
        throughput = throughput.join(devices, "device_id")
    return (
        _connectivity_statistics(connectivity, key)
        .join(_throughput_statistics(throughput, key), key, "full")
        .orderBy(key)
    )


def device_statistics(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """Connectivity and throughput statistics per device."""
    return _statistics(tables, "device_id", as_of, window)


def technology_statistics(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """The same statistics per access technology; unknown devices are left out."""
    devices = tables.devices.select("device_id", "technology")
    return _statistics(tables, "technology", as_of, window, devices)


def peer_comparison(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY,
    min_samples: int = 10, min_peers: int = 5,
    download_floor: float = 0.7, latency_ceiling: float = 1.5,
) -> DataFrame:
    """Devices below `download_floor` x peer median download or above `latency_ceiling`
    x peer median latency, with exact (unrounded) medians and ratios.

    Peers share technology and advertised download. A device needs `min_samples` of both
    kinds, a peer group `min_peers` devices.
    """
    tests = (
        _recent(tables.throughput_events, as_of, window, "download_mbps")
        .groupBy("device_id")
        .agg(percentile("download_mbps", 0.5).alias("median_download_mbps"),
             F.count(F.lit(1)).alias("tests"))
        .where(F.col("tests") >= min_samples)
    )
    samples = (
        _recent(tables.connectivity_events, as_of, window, "latency_ms")
        .groupBy("device_id")
        .agg(percentile("latency_ms", 0.5).alias("median_latency_ms"),
             F.count(F.lit(1)).alias("samples"))
        .where(F.col("samples") >= min_samples)
    )
    group = ["technology", "advertised_download_mbps"]
    measured = (
        tests.join(samples, "device_id")
        .join(tables.devices.select("device_id", "provider_name", *group), "device_id")
    )
    peers = (
        measured.groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("peer_devices"),
            percentile("median_download_mbps", 0.5).alias("peer_median_download_mbps"),
            percentile("median_latency_ms", 0.5).alias("peer_median_latency_ms"),
        )
        .where(F.col("peer_devices") >= min_peers)
    )
    download, latency = F.col("median_download_mbps"), F.col("median_latency_ms")
    peer_download, peer_latency = (
        F.col("peer_median_download_mbps"), F.col("peer_median_latency_ms")
    )
    return (
        measured.join(peers, group)
        .where((download < download_floor * peer_download)
               | (latency > latency_ceiling * peer_latency))
        .select(
            "device_id", "provider_name", *group, "peer_devices",
            download, peer_download,
            F.try_divide(download, peer_download).alias("download_vs_peer_ratio"),
            latency, peer_latency,
            F.try_divide(latency, peer_latency).alias("latency_vs_peer_ratio"),
        )
    )


def underperforming_devices(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY, **limits
) -> DataFrame:
    """`peer_comparison` rounded for reading: values to 1 digit, ratios to 3."""
    digits = {
        "median_download_mbps": 1, "peer_median_download_mbps": 1, "download_vs_peer_ratio": 3,
        "median_latency_ms": 1, "peer_median_latency_ms": 1, "latency_vs_peer_ratio": 3,
    }
    exact = peer_comparison(tables, as_of, window, **limits)
    return exact.withColumns(
        {c: F.round(c, n) for c, n in digits.items()}
    ).orderBy("download_vs_peer_ratio", "device_id")


def provider_technology_cohorts(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """Download relative to plan, latency and loss per provider and technology."""
    group = ["provider_name", "technology"]
    devices = tables.devices.select("device_id", *group, "advertised_download_mbps")
    tests = (
        _recent(tables.throughput_events, as_of, window, "download_mbps")
        .join(devices, "device_id")
        .groupBy(*group)
        .agg(
            F.count_distinct("device_id").alias("devices"),
            F.count(F.lit(1)).alias("throughput_tests"),
            percentiles(percent_of(F.col("download_mbps"), F.col("advertised_download_mbps")),
                        0.5, 0.05).alias("_pct"),
        )
        .select(
            *group, "devices", "throughput_tests",
            F.round(F.col("_pct")[0], 1).alias("download_pct_of_advertised_median"),
            F.round(F.col("_pct")[1], 1).alias("download_pct_of_advertised_bad"),
        )
    )
    samples = (
        _recent(tables.connectivity_events, as_of, window, "latency_ms", "packet_loss_pct")
        .join(devices.select("device_id", *group), "device_id")
        .groupBy(*group)
        .agg(
            F.count(F.lit(1)).alias("connectivity_samples"),
            percentiles("latency_ms", 0.5, 0.95).alias("_latency"),
            percentile("packet_loss_pct", 0.95).alias("_loss"),
        )
        .select(
            *group, "connectivity_samples",
            F.round(F.col("_latency")[0], 1).alias("latency_ms_median"),
            F.round(F.col("_latency")[1], 1).alias("latency_ms_bad"),
            F.round("_loss", 3).alias("packet_loss_pct_bad"),
        )
    )
    return tests.join(samples, group, "full").orderBy(*group)


def geographic_performance(
    tables: NetworkTables, as_of: Column | None = None, window: timedelta = DAY
) -> DataFrame:
    """Access devices per region and urban flag with density, speed and latency."""
    group = ["region", "inside_census_urban_area"]
    access = (
        tables.devices.where(F.col("infrastructure_role") == ACCESS_ROLE)
        .select("device_id", "site_id", "advertised_download_mbps")
        .join(tables.sites.select("site_id", "block_group_geoid", *group), "site_id")
        .join(
            tables.census_block_groups.select(
                "block_group_geoid", "population_density_per_sq_mile"
            ), "block_group_geoid",
        )
    )
    places = access.groupBy(*group).agg(
        F.count(F.lit(1)).alias("devices"),
        F.round(percentile("population_density_per_sq_mile", 0.5), 1)
        .alias("median_block_group_density"),
    )
    tests = (
        _recent(tables.throughput_events, as_of, window, "download_mbps")
        .join(access.select("device_id", "advertised_download_mbps", *group), "device_id")
        .groupBy(*group)
        .agg(F.round(percentile(
            percent_of(F.col("download_mbps"), F.col("advertised_download_mbps")), 0.5
        ), 1).alias("download_pct_of_advertised_median"))
    )
    samples = (
        _recent(tables.connectivity_events, as_of, window, "latency_ms")
        .join(access.select("device_id", *group), "device_id")
        .groupBy(*group).agg(percentiles("latency_ms", 0.5, 0.95).alias("_latency"))
        .select(
            *group,
            F.round(F.col("_latency")[0], 1).alias("latency_ms_median"),
            F.round(F.col("_latency")[1], 1).alias("latency_ms_p95"),
        )
    )
    return places.join(tests, group, "left").join(samples, group, "left").orderBy(*group)
