"""The network data model: event families, table schemas and the table bundle.

Everything below the "fixed values" comments must equal the published contract of
the model, because results and stored tables depend on it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Family:
    event_type: str
    topic: str
    table: str
    cadence_seconds: int


# Event families, their topics, tables and reporting cadences.
FAMILIES = (
    Family("connectivity_metric", "network.connectivity", "connectivity_events", 5),
    Family("throughput_test", "network.throughput", "throughput_events", 60),
    Family("device_health", "network.device_health", "device_health_events", 30),
    Family("connectivity_state", "network.state", "connectivity_state_events", 60),
    Family("infrastructure_event", "network.infrastructure", "infrastructure_events", 60),
)

# Inventory roles and site types.
ACCESS_ROLE = "subscriber_edge"
IXP_ROLE = "ixp"
NETWORK_SITE_TYPE = "network_facility"

# Table definitions (column, Spark SQL type).
ENVELOPE_DDL = """
    schema_version int, event_id string, event_type string, event_timestamp timestamp,
    device_session_id string, sequence_number bigint, site_id string, device_id string,
    _kafka_topic string, _kafka_partition int, _kafka_offset bigint, _kafka_timestamp timestamp
"""
LATE_LINEAGE_DDL = "_kafka_key string, _ingested_at timestamp"
MEASURE_DDL = {
    "connectivity_events": "latency_ms double, jitter_ms double, packet_loss_pct double",
    "throughput_events": "download_mbps double, upload_mbps double",
    "device_health_events": """
        cpu_pct double, memory_pct double, temperature_c double, optical_rx_power_dbm double,
        snr_db double, signal_strength_dbm double, signal_quality_pct double
    """,
    "connectivity_state_events": "previous_state string, new_state string, reason string",
    "infrastructure_events": "incident_id string, event_kind string, severity string",
}
REJECTED_DDL = """
    raw_payload string, _kafka_topic string, _kafka_partition int, _kafka_offset bigint,
    _kafka_timestamp timestamp, rejection_reason string, rejected_at timestamp,
    raw_value binary, _kafka_key string
"""
RAW_RECORD_DDL = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)
REFERENCE_DDL = {
    "census_block_groups": """
        block_group_geoid string, population bigint, land_area_sq_miles double,
        population_density_per_sq_mile double, internal_latitude double, internal_longitude double
    """,
    "sites": """
        site_id string, latitude double, longitude double, region string, block_group_geoid string,
        inside_census_urban_area boolean, urban_area_name string,
        distance_to_nearest_urban_area_km double, nearest_census_place string,
        distance_to_nearest_place_km double, site_type string, critical_infrastructure boolean
    """,
    "devices": """
        device_id string, site_id string, provider_id string, provider_name string,
        technology string, device_class string, device_model string, infrastructure_role string,
        advertised_download_mbps double, advertised_upload_mbps double, deployment_date date
    """,
    "device_dependencies": (
        "downstream_device_id string, upstream_device_id string, dependency_type string"
    ),
}
REFERENCE_LINEAGE_DDL = "_source_file string, _source_sha256 string, _loaded_at timestamp"

# The partition day that stored tables keep of each clock.
CLOCK_DAYS = {"event_timestamp": "event_day", "_kafka_timestamp": "arrival_day"}

EVENT_TABLES = tuple(f.table for f in FAMILIES)
REFERENCE_TABLES = tuple(REFERENCE_DDL)
REJECT_TABLE = "rejected_events"
# Every accepted event once, of all families: envelope and lineage.
CURATED_TABLE = "curated_events"
ALL_TABLES = (
    *EVENT_TABLES, REJECT_TABLE, "sites", "devices", "device_dependencies", "census_block_groups",
)


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(),
    "string": T.StringType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "binary": T.BinaryType(),
}


def schema_of(ddl: str) -> T.StructType:
    """Schema of a flat column list; unlike StructType.fromDDL it needs no session."""
    fields = (column.split() for column in ddl.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def event_schema(table: str) -> T.StructType:
    """Envelope, measures, then the lineage columns that were added later."""
    return schema_of(f"{ENVELOPE_DDL}, {MEASURE_DDL[table]}, {LATE_LINEAGE_DDL}")


def table_schema(table: str) -> T.StructType:
    """Full stored schema of any table of the model, without partition columns."""
    if table in MEASURE_DDL:
        return event_schema(table)
    if table == REJECT_TABLE:
        return schema_of(REJECTED_DDL)
    if table == CURATED_TABLE:
        return schema_of(f"table_name string, {ENVELOPE_DDL}, {LATE_LINEAGE_DDL}")
    return schema_of(f"{REFERENCE_DDL[table]}, {REFERENCE_LINEAGE_DDL}")


def family_of(table: str) -> Family:
    return next(f for f in FAMILIES if f.table == table)


class NetworkTables:
    """The ten tables every report and check reads, as lazy DataFrames.

    `load(name)` builds a table when it is first asked for. `stack`, when given, builds
    one DataFrame with the rows of all five event tables (envelope and lineage columns
    plus `table_name`): a source that keeps the families in one place passes it so that
    stacked reads scan the data once. Otherwise the five tables are unioned.
    `newest(name, clock)`, when given, knows a clock's newest value without a scan.
    """

    def __init__(
        self, load: Callable[[str], DataFrame], stack: Callable[[], DataFrame] | None = None,
        newest: Callable[[str, str], Column] | None = None,
    ) -> None:
        self._load, self._stack, self._newest = load, stack, newest
        self._loaded: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("__") or name not in ALL_TABLES:
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in ALL_TABLES:
            raise ValueError(f"unknown table {name!r}; known: {', '.join(ALL_TABLES)}")
        if name not in self._loaded:
            self._loaded[name] = self._load(name)
        return self._loaded[name]

    def newest(self, name: str, clock: str) -> Column:
        """Newest value of a clock of a table: what a report's window ends with."""
        if self._newest is not None:
            return self._newest(name, clock)
        return newest(self.table(name), clock)

    @classmethod
    def of(cls, **tables: DataFrame) -> NetworkTables:
        """Tables given directly; the ones left out cannot be read."""
        return cls(lambda name: tables[name])

    def stacked(self, *columns: str) -> DataFrame:
        """Rows of the five event tables with `table_name` and the wanted columns. A clock
        brings its partition day along where all five keep it, for `since` to prune by."""
        if self._stack is not None:
            return self._stack().select("table_name", *columns)
        tables = [self.table(t) for t in EVENT_TABLES]
        days = [day for clock, day in CLOCK_DAYS.items()
                if clock in columns and all(day in t.columns for t in tables)]
        parts = [
            table.select(F.lit(name).alias("table_name"), *columns, *days)
            for name, table in zip(EVENT_TABLES, tables, strict=True)
        ]
        return reduce(DataFrame.unionByName, parts)


def newest(df: DataFrame, column: str) -> Column:
    """Newest value of a clock column as a scalar subquery (evaluated once per query)."""
    return df.agg(F.max(column).alias("newest")).scalar()
