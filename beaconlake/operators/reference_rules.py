"""Rules of the reference tables. Each rule is a DataFrame of (rule, entity, detail)
violations; their union is the loader's report and must be empty before a load."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..model import ACCESS_ROLE, IXP_ROLE, NETWORK_SITE_TYPE
from ..session import ensure_checkpoint_dir

# Keys, required columns, domains and role pairs of the inventory contract.
KEYS = {
    "census_block_groups": "block_group_geoid",
    "sites": "site_id",
    "devices": "device_id",
    "device_dependencies": "downstream_device_id",
}
REQUIRED = {
    "census_block_groups": ["block_group_geoid", "population", "land_area_sq_miles",
                            "internal_latitude", "internal_longitude"],
    "sites": ["site_id", "latitude", "longitude", "region", "block_group_geoid",
              "inside_census_urban_area", "site_type", "critical_infrastructure"],
    "devices": ["device_id", "site_id", "technology", "device_class", "infrastructure_role",
                "deployment_date"],
    "device_dependencies": ["downstream_device_id", "upstream_device_id", "dependency_type"],
}
NOT_NEGATIVE = {
    "census_block_groups": ["population", "land_area_sq_miles", "population_density_per_sq_mile"],
    "sites": ["distance_to_nearest_urban_area_km", "distance_to_nearest_place_km"],
    "devices": ["advertised_download_mbps", "advertised_upload_mbps"],
}
GEOID_PATTERN = r"^05\d{10}$"
LATITUDES = (32.9, 36.6)
LONGITUDES = (-94.7, -89.5)
DEPENDENCY_ROLES = {
    "access_aggregation": ("subscriber_edge", "aggregation"),
    "aggregation_backhaul": ("aggregation", "backhaul"),
    "backhaul_ixp": ("backhaul", "ixp"),
}
EXAMPLES = 5

Tables = dict[str, DataFrame]


def _counted() -> dict[str, tuple[str, str]]:
    """What each manifest count counts: label -> (table, SQL condition)."""
    access = f"infrastructure_role <=> '{ACCESS_ROLE}'"
    network = f"site_type <=> '{NETWORK_SITE_TYPE}'"
    return {
        "census_block_groups": ("census_block_groups", "true"),
        "sites": ("sites", "true"),
        "devices": ("devices", "true"),
        "device_dependencies": ("device_dependencies", "true"),
        "access devices": ("devices", access),
        "infrastructure devices": ("devices", f"NOT ({access})"),
        "service sites": ("sites", f"NOT ({network})"),
        "network sites": ("sites", network),
    }


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _found(df: DataFrame, rule: str, entity: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), entity.cast("string").alias("entity"),
                     detail.cast("string").alias("detail"))


def _unpivoted(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """One aggregate over the table, then one row (name, value) per aggregate."""
    one = df.agg(F.array(*[
        F.struct(F.lit(k).alias("name"), v.alias("value")) for k, v in values.items()
    ]).alias("all"))
    return one.select(F.inline("all"))


def missing_required(tables: Tables) -> DataFrame:
    """Required columns with NULL or empty values, with the number of such rows."""
    parts = []
    for table, columns in REQUIRED.items():
        empty = {
            f"{table}.{c}": F.count_if(F.col(c).isNull() | (F.col(c).cast("string") == ""))
            for c in columns
        }
        counts = _unpivoted(tables[table], empty).where("value > 0")
        parts.append(_found(counts, "missing required value", F.col("name"), F.col("value")))
    return _union(parts)


def duplicate_keys(tables: Tables) -> DataFrame:
    """Key values held by more than one row."""
    parts = []
    for table, key in KEYS.items():
        repeated = tables[table].groupBy(F.col(key).alias("key")).agg(
            F.count(F.lit(1)).alias("n")).where("n > 1")
        parts.append(_found(
            repeated, "duplicate key", F.concat(F.lit(f"{table}."), F.col("key")), F.col("n")))
    return _union(parts)


def actual_counts(tables: Tables) -> DataFrame:
    """The counts a manifest states, from the tables: (label, actual)."""
    by_table: dict[str, dict[str, Column]] = {}
    for label, (table, condition) in _counted().items():
        by_table.setdefault(table, {})[label] = F.count_if(F.expr(condition))
    return _union([
        _unpivoted(tables[t], counts).toDF("label", "actual") for t, counts in by_table.items()
    ])


def count_mismatch(tables: Tables, manifest: DataFrame) -> DataFrame:
    """Counts that differ from the manifest's (label, expected)."""
    compared = actual_counts(tables).join(manifest, "label", "left")
    wrong = compared.where(~F.col("actual").eqNullSafe(F.col("expected")))
    return _found(wrong, "count mismatch", F.col("label"), F.concat(
        F.lit("file has "), F.col("actual"), F.lit(", manifest says "),
        F.coalesce(F.col("expected").cast("string"), F.lit("nothing"))))


def bad_geoids(tables: Tables) -> DataFrame:
    """Block group ids that are not 12 digits of the expected state."""
    geoids = _union([
        tables[t].select(F.col("block_group_geoid").alias("geoid"), F.lit(t).alias("holder"))
        for t in ("census_block_groups", "sites")
    ])
    bad = geoids.where((F.col("geoid") != "") & ~F.col("geoid").rlike(GEOID_PATTERN)).distinct()
    return _found(bad, "malformed block group", F.col("geoid"), F.col("holder"))


def out_of_bounds(tables: Tables) -> DataFrame:
    inside = F.col("latitude").between(*LATITUDES) & F.col("longitude").between(*LONGITUDES)
    return _found(
        tables["sites"].where(~inside), "site out of bounds", F.col("site_id"),
        F.concat_ws(", ", F.col("latitude").cast("string"), F.col("longitude").cast("string")))


def negative_values(tables: Tables) -> DataFrame:
    """Columns with a negative measure, with the number of such rows."""
    parts = []
    for table, columns in NOT_NEGATIVE.items():
        counts = _unpivoted(tables[table], {
            f"{table}.{c}": F.count_if(F.col(c) < 0) for c in columns
        }).where("value > 0")
        parts.append(_found(counts, "negative value", F.col("name"), F.col("value")))
    return _union(parts)


def orphans(tables: Tables) -> DataFrame:
    """Foreign keys without a target; a NULL key has none either."""
    relations = [
        ("sites", "site_id", "block_group_geoid", "census_block_groups", "block_group_geoid"),
        ("devices", "device_id", "site_id", "sites", "site_id"),
        ("device_dependencies", "downstream_device_id", "downstream_device_id", "devices",
         "device_id"),
        ("device_dependencies", "upstream_device_id", "upstream_device_id", "devices",
         "device_id"),
    ]
    parts = []
    for table, entity, key, target, target_key in relations:
        lonely = tables[table].select(F.col(entity).alias("entity"), F.col(key).alias("key")).join(
            tables[target].select(F.col(target_key).alias("key")), "key", "left_anti")
        parts.append(_found(
            lonely, "orphan", F.col("entity"), F.lit(f"{table}.{key} -> {target}")))
    return _union(parts)


def speed_rules(tables: Tables) -> DataFrame:
    """Access devices need provider and speed, infrastructure devices have no speed."""
    access = F.col("infrastructure_role").eqNullSafe(ACCESS_ROLE)
    lacking = access & (
        F.col("advertised_download_mbps").isNull() | F.col("provider_id").isNull())
    extra = ~access & F.col("advertised_download_mbps").isNotNull()
    problem = F.when(lacking, "access device without provider or speed").when(
        extra, "infrastructure device with speed")
    found = tables["devices"].select("device_id", "infrastructure_role", problem.alias("rule"))
    return found.where(F.col("rule").isNotNull()).select(
        "rule", F.col("device_id").alias("entity"), F.col("infrastructure_role").alias("detail"))


def site_device_count(tables: Tables) -> DataFrame:
    """Service sites that do not have exactly one device."""
    per_site = tables["devices"].groupBy("site_id").agg(F.count(F.lit(1)).alias("n"))
    service = tables["sites"].where(
        ~F.col("site_type").eqNullSafe(NETWORK_SITE_TYPE)).select("site_id")
    counted = service.join(per_site, "site_id", "left").withColumn(
        "n", F.coalesce("n", F.lit(0)))
    return _found(counted.where("n <> 1"), "service site without exactly one device",
                  F.col("site_id"), F.col("n"))


def upstream_rules(tables: Tables) -> DataFrame:
    """An IXP has no upstream; every other device has one."""
    devices = tables["devices"].select("device_id", "infrastructure_role")
    linked = tables["device_dependencies"].select(
        F.col("downstream_device_id").alias("device_id"))
    ixp = F.col("infrastructure_role").eqNullSafe(IXP_ROLE)
    rooted = devices.where(ixp).join(linked, "device_id", "left_semi")
    loose = devices.where(~ixp).join(linked, "device_id", "left_anti")
    return _found(rooted, "IXP with an upstream", F.col("device_id"),
                  F.col("infrastructure_role")).unionByName(
        _found(loose, "device without an upstream", F.col("device_id"),
               F.col("infrastructure_role")))


def unrooted_devices(tables: Tables) -> DataFrame:
    """Devices from which no IXP without upstream is reached, cycles included.

    The devices reached grow downstream from those IXPs, one hop per round, until a round
    finds nothing new. Each round is checkpointed, so that the plan does not grow and a
    lost executor does not restart the walk.
    """
    devices = tables["devices"].select("device_id", "infrastructure_role").distinct()
    spark = devices.sparkSession
    ensure_checkpoint_dir(spark)
    edges = tables["device_dependencies"].select(
        F.col("downstream_device_id").alias("device_id"), "upstream_device_id")
    reached = (
        devices.where(F.col("infrastructure_role") == IXP_ROLE).select("device_id")
        .join(edges.select("device_id"), "device_id", "left_anti").distinct().checkpoint()
    )
    frontier = reached
    while not frontier.isEmpty():
        frontier = (
            edges.join(frontier.withColumnRenamed("device_id", "upstream_device_id"),
                       "upstream_device_id", "left_semi")
            .select("device_id").distinct()
            .join(reached, "device_id", "left_anti").checkpoint()
        )
        reached = reached.unionByName(frontier)
    lost = devices.join(reached, "device_id", "left_anti")
    return _found(lost, "no path to an IXP", F.col("device_id"), F.col("infrastructure_role"))


def dependency_roles(tables: Tables) -> DataFrame:
    """Dependencies whose type does not fit the roles of their two devices."""
    roles = tables["devices"].select("device_id", "infrastructure_role").distinct()
    ends = (
        tables["device_dependencies"]
        .join(roles.toDF("downstream_device_id", "low_role"), "downstream_device_id")
        .join(roles.toDF("upstream_device_id", "high_role"), "upstream_device_id")
    )
    fits = reduce(lambda a, b: a | b, [
        (F.col("dependency_type") == kind) & (F.col("low_role") == low)
        & (F.col("high_role") == high)
        for kind, (low, high) in DEPENDENCY_ROLES.items()
    ])
    wrong = ends.where(~F.coalesce(fits, F.lit(False)))
    return _found(wrong, "dependency type does not fit roles", F.col("downstream_device_id"),
                  F.concat_ws(" ", "dependency_type", "low_role", "high_role"))


def violations(tables: Tables, manifest: DataFrame) -> DataFrame:
    """Every violation of every rule. The tables are checkpointed first: a dozen rules
    read them, and reading the source again for each would cost more than the rules."""
    ensure_checkpoint_dir(manifest.sparkSession)
    tables = {name: df.checkpoint() for name, df in tables.items()}
    return _union([
        missing_required(tables), duplicate_keys(tables), count_mismatch(tables, manifest),
        bad_geoids(tables), out_of_bounds(tables), negative_values(tables), orphans(tables),
        speed_rules(tables), site_device_count(tables), upstream_rules(tables),
        unrooted_devices(tables), dependency_roles(tables),
    ])


def summarised(found: DataFrame) -> DataFrame:
    """Per rule: distinct entities and the first five of them in order, as the loader
    prints them. Only five rows per rule are ever put into a list. The violations are
    checkpointed, so that the rules run once."""
    ensure_checkpoint_dir(found.sparkSession)
    distinct = found.select("rule", "entity").distinct().checkpoint()
    first = distinct.withColumn(
        "_place", F.row_number().over(Window.partitionBy("rule").orderBy("entity"))
    ).where(F.col("_place") <= EXAMPLES)
    examples = first.groupBy("rule").agg(F.concat_ws(
        ", ", F.sort_array(F.collect_list("entity"))).alias("examples"))
    counts = distinct.groupBy("rule").agg(F.count(F.lit(1)).alias("entities"))
    return counts.join(examples, "rule").orderBy("rule")
