"""Density ranks, development scores, neighbours and cohorts of the inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import banded, distance_km, stable_uniform
from ..functions.grid import nearest
from ..model import ACCESS_ROLE, NetworkTables
from ..session import ensure_checkpoint_dir

# Weights of the development score and the configured anomaly rates.
DENSITY_WEIGHT, URBAN_WEIGHT, URBAN_SCALE_KM = 0.55, 0.45, 40.0
ANOMALY_RATES = {
    "duplicate": 0.0025, "sequence_gap": 0.001, "out_of_order": 0.001, "late_arrival": 0.0005,
    "poison": 0.0002,
}
# How large cohorts must be and how far apart.
MIN_PROVIDER_GROUP, MIN_MODEL_PEERS, MIN_SEPARATION_KM = 25, 24, 150.0


def density_percentile(census: DataFrame) -> DataFrame:
    """Average rank / n of each block group's density; ties share their average rank. A block
    group without density has none.

    Counts per distinct density are ranked inside value ranges that Spark cuts evenly;
    only one row per range is summed in a single window. The ranged counts are
    checkpointed, because their ranges must not be cut anew for each use.
    """
    ensure_checkpoint_dir(census.sparkSession)
    sizes = census.groupBy(F.col("population_density_per_sq_mile").alias("density")).agg(
        F.count(F.lit(1)).alias("groups")).where(F.col("density").isNotNull())
    ranged = sizes.repartitionByRange("density").withColumn(
        "range", F.spark_partition_id()).checkpoint()
    per_range = ranged.groupBy("range").agg(F.sum("groups").alias("in_range"))
    below = per_range.select("range", F.coalesce(F.sum("in_range").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("below"))
    running = F.coalesce(F.sum("groups").over(
        Window.partitionBy("range").orderBy("density")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = ranged.agg(F.sum("groups").alias("n")).scalar()
    placed = F.col("below") + F.col("before")
    ranks = ranged.withColumn("before", running).join(below, "range").select(
        "density",
        ((2 * placed + F.col("groups") + 1).cast("double") / 2.0 / total)
        .alias("density_percentile"))
    return census.select(
        "block_group_geoid", F.col("population_density_per_sq_mile").alias("density")
    ).join(ranks, "density", "left").select("block_group_geoid", "density_percentile")


def developed_score(tables: NetworkTables) -> DataFrame:
    """How developed a site's place is, from density rank and closeness to a city."""
    closeness = F.when(F.col("inside_census_urban_area"), 1.0).otherwise(
        F.exp(-F.col("distance_to_nearest_urban_area_km") / F.lit(URBAN_SCALE_KM)))
    score = (F.lit(DENSITY_WEIGHT) * F.col("density_percentile")
             + F.lit(URBAN_WEIGHT) * closeness)
    return (
        tables.sites.select("site_id", "block_group_geoid", "inside_census_urban_area",
                            "distance_to_nearest_urban_area_km")
        .join(density_percentile(tables.census_block_groups), "block_group_geoid", "left")
        .select("site_id", score.alias("developed_score"))
    )


def located_access_devices(tables: NetworkTables) -> DataFrame:
    access = tables.devices.where(F.col("infrastructure_role") == ACCESS_ROLE)
    return access.join(
        tables.sites.select("site_id", "latitude", "longitude", "critical_infrastructure"),
        "site_id")


def _from_anchor(devices: DataFrame, anchor_id: str) -> Column:
    """Distance of each device to the anchor, whose place is one scalar subquery."""
    place = devices.where(F.col("device_id") == anchor_id).agg(
        F.first(F.struct("latitude", "longitude")).alias("place")).scalar()
    return distance_km(place["latitude"], place["longitude"],
                       F.col("latitude"), F.col("longitude"))


def nearest_devices(tables: NetworkTables, anchor_id: str, n: int = 40) -> DataFrame:
    """The n access devices nearest to the anchor (itself included), ties by id."""
    devices = located_access_devices(tables)
    return devices.select(
        "device_id", _from_anchor(devices, anchor_id).alias("distance_km")
    ).orderBy("distance_km", "device_id").limit(n)


def nearest_devices_all(tables: NetworkTables, anchors: DataFrame, n: int = 40) -> DataFrame:
    """The n access devices nearest to each anchor device (`anchor_id`), ties by id."""
    places = located_access_devices(tables).select(
        F.col("device_id").alias("place_id"), "latitude", "longitude")
    located = anchors.join(tables.devices.select(F.col("device_id").alias("anchor_id"), "site_id"),
                           "anchor_id").join(tables.sites.select("site_id", "latitude", "longitude"), "site_id")
    return nearest(located, places, n).withColumnRenamed("place_id", "device_id")


def eligible_cohorts(tables: NetworkTables, router_id: str, anchor_id: str) -> DataFrame:
    """What can take part in a comparison next to the incidents of one router:
    (kind, cohort, devices).

    provider_technology: large groups of another provider than the router's, without any
    device below it. critical_router: routers with a critical site directly below.
    far_anchor: access devices far from the anchor. model_peers: devices of a model with
    enough peers on sites that are not critical.
    """
    devices = located_access_devices(tables)
    edges = tables.device_dependencies.select(
        F.col("downstream_device_id").alias("device_id"), "upstream_device_id")
    below = edges.where(F.col("upstream_device_id") == router_id)
    router_provider = tables.devices.where(F.col("device_id") == router_id).agg(
        F.first("provider_id").alias("provider")).scalar()
    group = ["provider_id", "technology"]
    touched = devices.join(below, "device_id", "left_semi").select(*group).distinct()
    counted = F.count(F.lit(1)).alias("devices")
    providers = (
        devices.where(~F.col("provider_id").eqNullSafe(router_provider))
        .groupBy(*group).agg(counted).where(F.col("devices") >= MIN_PROVIDER_GROUP)
        .join(touched, group, "left_anti")
        .select(F.lit("provider_technology").alias("kind"),
                F.concat_ws("|", *group).alias("cohort"), "devices")
    )
    routers = (
        devices.join(edges, "device_id").groupBy("upstream_device_id")
        .agg(counted, F.bool_or("critical_infrastructure").alias("critical")).where("critical")
        .select(F.lit("critical_router").alias("kind"),
                F.col("upstream_device_id").alias("cohort"), "devices")
    )
    far = devices.where(_from_anchor(devices, anchor_id) >= MIN_SEPARATION_KM).select(
        F.lit("far_anchor").alias("kind"), F.col("device_id").alias("cohort"),
        F.lit(1).cast("bigint").alias("devices"))
    models = devices.groupBy("device_model").agg(counted).where(
        F.col("devices") >= MIN_MODEL_PEERS)
    peers = devices.where(~F.col("critical_infrastructure")).join(models, "device_model").select(
        F.lit("model_peers").alias("kind"), F.col("device_id").alias("cohort"), "devices")
    return reduce(DataFrame.unionByName, [providers, routers, far, peers])


def hash_bands(events: DataFrame, seed: int, *key: str) -> DataFrame:
    """Label each row by the band its key's stable number falls in, at most one each."""
    number = stable_uniform(F.lit(str(seed)), *key)
    return events.select(
        *key, number.alias("selector"), banded(number, ANOMALY_RATES, "clean").alias("label"))
