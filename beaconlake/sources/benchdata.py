"""The network model on top of the supplied bench tables.

`events`, `customer`, `nation` and `region` become deliveries of five event families and
an inventory: customer -> nation -> region is the access -> aggregation -> backhaul
chain below one IXP. Every event is read. The remainders of ids below do not thin the
data out; they say which deliveries were lost, repeated or broken on the way, so that
gaps, duplicates, rejects and inventory faults exist to be found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ordered import with_row_number
from ..model import (
    EVENT_TABLES, FAMILIES, MEASURE_DDL, REFERENCE_TABLES, NetworkTables, event_schema, schema_of,
)
from ..operators.ingest import once, rejected

# Which bench event type stands for which family (the order of model.FAMILIES).
BENCH_TYPES = ("click", "view", "purchase", "signup", "error")
MEASURES = [f.name for ddl in MEASURE_DDL.values() for f in schema_of(ddl)]
IDS_PER_BUCKET = 1_000_000
# Ids grow with the data; the contract is told so.
ACCESS_DIGITS = "{4,}"

# 0 for a sound record, 1..21 for a broken one, 22 for one cut short (see `_spoil`).
FAULT = """CASE WHEN event_id % 499 = 3 THEN 22
    WHEN event_id % 1009 BETWEEN 1 AND 21 THEN int(event_id % 1009) ELSE 0 END"""
HALF = "CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END"
# Sent again: event_id % 400 = 7. Stored again: % 1000 = 13. Lost on the way: numbers of the
# sequence, one after each 20 (every event of the table arrives).
COPIES = """filter(array(0, CASE WHEN event_id % 400 = 7 THEN 1 END,
    CASE WHEN event_id % 1000 = 13 THEN 2 END), c -> c IS NOT NULL)"""
INFRA = "event_type = 'error'"


# Given schemas spare a footer-reading job per table and query.
BENCH_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
              " value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
                " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(BENCH_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _by_type(*values: str) -> str:
    cases = " ".join(f"WHEN '{t}' THEN {v}" for t, v in zip(BENCH_TYPES, values, strict=True))
    return f"CASE event_type {cases} END"


def _of_families(attribute: str) -> str:
    return _by_type(*[f"'{getattr(f, attribute)}'" for f in FAMILIES])


def _name(prefix: str, number: str, digits: int) -> str:
    """Prefix and zero-padded number; longer numbers are kept whole."""
    text = f"string({number})"
    return f"concat('{prefix}-', lpad({text}, greatest({digits}, length({text})), '0'))"


def _uuid(kind: str, number: str) -> str:
    """UUID-shaped text holding a number; the fourth group tells the kind of id."""
    return f"concat('00000000-0000-4000-{kind}-', lpad(lower(hex({number})), 12, '0'))"


def _pick(number: str, *values: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {number} {cases} END"


SIGNAL = "CASE WHEN event_id % 70 = 11 THEN -1 ELSE user_id % 4 END"  # -1: none sent
STATE_NAMES = ("online", "degraded", "offline")
MEASURE_SQL = {
    "latency_ms": ("click", "value"),
    "jitter_ms": ("click", "value / 10.0D"),
    "packet_loss_pct": ("click", "value % 5.0D"),
    "download_mbps": ("view", "value + 1.0D"),
    "upload_mbps": ("view", "(value + 1.0D) / 4.0D"),
    "cpu_pct": ("purchase", "value % 100.0D"),
    "memory_pct": ("purchase", "(value * 2.0D) % 100.0D"),
    "temperature_c": ("purchase", "value % 60.0D + 20.0D"),
    "optical_rx_power_dbm": ("purchase", f"IF({SIGNAL} = 0, value % 30.0D - 30.0D, NULL)"),
    "snr_db": ("purchase", f"IF({SIGNAL} = 1 OR event_id % 50 = 9, value % 60.0D, NULL)"),
    "signal_strength_dbm": ("purchase", f"IF({SIGNAL} = 2, value % 100.0D - 120.0D, NULL)"),
    "signal_quality_pct": ("purchase", f"IF({SIGNAL} = 3, value % 100.0D, NULL)"),
    "previous_state": ("signup", _pick("(event_id div 3) % 3", *STATE_NAMES)),
    "new_state": ("signup", _pick("event_id % 3", *STATE_NAMES)),
    "reason": ("signup", _pick(
        "event_id % 4", "upstream_congestion", "upstream_outage", "upstream_recovery",
        "upstream_recovered")),
    "incident_id": ("error", _uuid("a000", "router * 100000 + arrived_ms div 432000000")),
    "event_kind": ("error", _pick(
        "event_id % 4", "congestion_started", "outage_started", "recovery_started",
        "recovered")),
    "severity": ("error", _pick("event_id % 4", "warning", "critical", "warning", "info")),
}


def deliveries(events: DataFrame, sequenced: bool, partitions: int | None = None) -> DataFrame:
    """Bench events as wide typed deliveries: envelope, lineage, measures of all families.

    Numbering the sequence needs a pass over the whole stream, so it is only done when
    asked for; otherwise the column does not exist. With `partitions` the deliveries are dealt
    over so many, while they are still narrow.
    """
    source = events.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value", f"{HALF} AS half")
    if sequenced:
        source = with_row_number(
            source, ["user_id", "event_type", "half"], "event_id",
            F.floor(F.col("event_id") / F.lit(IDS_PER_BUCKET)), "sequence_number",
        )
    numbered = ["sequence_number + sequence_number div 20 AS sequence_number"] if sequenced else []
    kept = ["sequence_number"] if sequenced else []
    copied = source.selectExpr(
        "event_id", "user_id", "event_type", "value", "half", *numbered,
        f"explode({COPIES}) AS copy", "user_id % 25 AS router",
        "timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) div 1000"
        " AS arrived_ms",
    )
    if partitions:
        copied = copied.repartition(partitions, "event_id", F.col("copy") == 1)
    device = f"IF({INFRA}, {_name('agg', 'router', 2)}, {_name('device', 'user_id', 4)})"
    return copied.selectExpr(
        f"{FAULT} AS fault",
        f"{_of_families('table')} AS table_name",
        "1 AS schema_version",
        f"{_uuid('8000', 'event_id')} AS event_id",
        f"{_of_families('event_type')} AS event_type",
        "timestamp_millis(arrived_ms - floor(value * 600000.0D)) AS event_timestamp",
        f"{_uuid('9000', 'user_id * 2 + half')} AS device_session_id",
        *kept,
        f"IF({INFRA}, {_name('network-site-agg', 'router', 2)}, {_name('site', 'user_id', 4)})"
        " AS site_id",
        f"{device} AS device_id",
        f"{_of_families('topic')} AS _kafka_topic",
        f"int(IF({INFRA}, router, user_id) % 3) AS _kafka_partition",
        "event_id * 2 + IF(copy = 1, 1, 0) AS _kafka_offset",
        "timestamp_millis(arrived_ms) AS _kafka_timestamp",
        *[f"CASE WHEN event_type = '{t}' THEN {sql} END AS {name}"
          for name, (t, sql) in MEASURE_SQL.items()],
        f"{device} AS _kafka_key",
        "timestamp_millis(arrived_ms + 250) AS _ingested_at",
    )


# How a broken record differs from a sound one: fault number -> column -> SQL.
FIRST_MEASURES = ("latency_ms", "download_mbps", "cpu_pct", "previous_state", "incident_id")
OUT_OF_RANGE = {"latency_ms": "-1.0D", "download_mbps": "0.0D", "cpu_pct": "101.0D",
                "new_state": "'rebooting'", "event_kind": "'exploded'"}
STAMP = "date_format(event_timestamp, \"yyyy-MM-dd'T'HH:mm:ss{}'Z'\")"


def event_count(spark: SparkSession, sf_dir: str) -> int:
    return _table(spark, sf_dir, "events").count()


def raw_records(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """The deliveries as broker records: JSON bytes with the faults built in."""
    sent = deliveries(_table(spark, sf_dir, "events"), sequenced=True, partitions=partitions)

    def measure(name: str) -> str:
        sql = name
        if name in OUT_OF_RANGE:
            sql = f"IF(fault = 20 AND {name} IS NOT NULL, {OUT_OF_RANGE[name]}, {sql})"
        if name in FIRST_MEASURES:
            sql = f"IF(fault = 18, NULL, {sql})"
        return f"'{name}', {sql}"

    payload = ", ".join([*map(measure, MEASURES), "'rtt_ms', IF(fault = 10, 1.0D, NULL)"])
    body = f"""to_json(named_struct(
        'schema_version', IF(fault = 15, 2, schema_version),
        'event_id', IF(fault = 16, 'not-a-uuid', event_id),
        'event_type', CASE fault WHEN 5 THEN 'reboot' WHEN 6 THEN NULL ELSE event_type END,
        'event_timestamp', CASE fault WHEN 9 THEN '2026-13-45T18:00:00.000Z'
            WHEN 13 THEN {STAMP.format('')} ELSE {STAMP.format('.SSS')} END,
        'device_session_id', IF(fault = 12, NULL, device_session_id),
        'sequence_number', IF(fault = 14, 0L, sequence_number),
        'site_id', site_id,
        'device_id', IF(fault = 17, 'Device-1', device_id),
        'region', IF(fault = 11, 'central', NULL),
        'payload', named_struct({payload})))"""
    following = {f.event_type: FAMILIES[(i + 1) % 5].topic for i, f in enumerate(FAMILIES)}
    astray = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in following.items())
    # In one method with the columns it is made of, the text would be made by interpreted code.
    lines = once(sent, {"body": body}).selectExpr(
        "fault", "body", "_kafka_key", "_kafka_partition", "_kafka_offset",
        "_kafka_timestamp",
        f"CASE fault WHEN 7 THEN CASE event_type {astray} END WHEN 8 THEN 'network.unknown'"
        " ELSE _kafka_topic END AS topic",
    )
    return lines.select(
        F.encode("_kafka_key", "UTF-8").alias("key"),
        _spoil(F.col("body"), F.col("fault")).alias("value"),
        "topic",
        F.col("_kafka_partition").alias("partition"),
        F.col("_kafka_offset").alias("offset"),
        F.col("_kafka_timestamp").alias("timestamp"),
    )


def _spoil(body: Column, fault: Column) -> Column:
    """JSON text to record bytes, broken the way the fault says."""
    text = (
        F.when(fault == 1, F.lit(""))
        .when(fault == 3, F.lit("[1, 2]"))
        .when(fault == 4, F.lit("null"))
        .when(fault == 19, F.regexp_replace(
            body, r'"payload":\{"(\w+)":[^,}]+', r'"payload":{"$1":[true]'))
        .when(fault == 21, F.regexp_replace(body, r'"payload":\{[^}]*\}', '"payload":"none"'))
        .when(fault == 22, F.substring(body, F.lit(1), F.length(body) - 1))
        .otherwise(body)
    )
    return F.when(fault == 2, F.unhex(F.lit("7B2261223A22FFFE227D"))) \
        .otherwise(F.encode(text, "UTF-8"))


def network_tables(
    spark: SparkSession, sf_dir: str, sequenced: bool = False, sequenced_stack: bool = False
) -> NetworkTables:
    """The model's tables. Broken deliveries are not in the event tables; reading
    `rejected_events` runs all deliveries through ingestion's own validation. Sequence numbers are
    in the event tables with `sequenced`, in stacked reads with `sequenced_stack`."""
    events = _table(spark, sf_dir, "events")
    stored = inventory(spark, sf_dir)

    def load(name: str) -> DataFrame:
        if name in EVENT_TABLES:
            bench_type = BENCH_TYPES[EVENT_TABLES.index(name)]
            rows = deliveries(events.where(F.col("event_type") == bench_type), sequenced)
            columns = [c for c in event_schema(name).names
                       if sequenced or c != "sequence_number"]
            return rows.where("fault = 0").select(*columns)
        if name in REFERENCE_TABLES:
            return stored[name]()
        return rejected(raw_records(spark, sf_dir), ACCESS_DIGITS)

    return NetworkTables(
        load,
        lambda: deliveries(events, sequenced_stack).where("fault = 0").drop("fault", *MEASURES),
    )


# Inventory: customers are access devices, nations aggregation routers, regions backhaul.
# Devices of customers with c_custkey % 40 = 9 are in `devices` under another name.
NATION_GEOID = "concat('05', lpad(string({0}), 10, '0'))"


def _site(site_id, latitude, longitude, region, nation, urban_km, place_km, site_type,
          critical) -> list[str]:
    return [
        f"{site_id} AS site_id", f"{latitude} AS latitude", f"{longitude} AS longitude",
        f"{region} AS region", f"{NATION_GEOID.format(nation)} AS block_group_geoid",
        f"{nation} % 2 = 0 AS inside_census_urban_area",
        f"IF({nation} % 2 = 0, concat('Area ', {nation}), NULL) AS urban_area_name",
        f"IF({nation} % 2 = 0, 0.0D, {urban_km}) AS distance_to_nearest_urban_area_km",
        f"concat('Place ', {nation}) AS nearest_census_place",
        f"{place_km} AS distance_to_nearest_place_km",
        f"{site_type} AS site_type", f"{critical} AS critical_infrastructure",
    ]


def _router(device_id: str, model: str, role: str, provider: str) -> list[str]:
    return [
        f"{device_id} AS device_id", f"concat('network-site-', {device_id}) AS site_id",
        f"{provider} AS provider_id", f"{provider} AS provider_name", "'fiber' AS technology",
        f"'{role}_router' AS device_class", f"'{model}' AS device_model",
        f"'{role}' AS infrastructure_role", "double(NULL) AS advertised_download_mbps",
        "double(NULL) AS advertised_upload_mbps", "DATE '2020-01-01' AS deployment_date",
    ]


def _edge(low: str, high: str, kind: str) -> list[str]:
    return [f"{low} AS downstream_device_id", f"{high} AS upstream_device_id",
            f"'{kind}' AS dependency_type"]


TECHNOLOGY = _pick("c_custkey % 4", "fiber", "coax", "fixed_wireless", "satellite")
# The one IXP, ixp-01, spelled with a column: a literal key would turn joins on it into
# nested loops.
IXP = _name("ixp", "1 + r_regionkey div 1000", 2)
PLAN = "CASE (c_custkey div 4) % 3 WHEN 0 THEN 100.0D WHEN 1 THEN 300.0D ELSE 1000.0D END"


def inventory(spark: SparkSession, sf_dir: str) -> dict:
    """Builders of sites, devices, dependencies and block groups."""
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    region = _table(spark, sf_dir, "region")

    def union(*parts: DataFrame) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    def ixp() -> DataFrame:
        return region.agg(F.min("r_regionkey").alias("r_regionkey"))

    def regions() -> DataFrame:
        return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))

    def sites() -> DataFrame:
        facility = "'network_facility'"
        return union(
            customer.join(regions(), F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(*_site(
                _name("site", "c_custkey", 4), "32.9D + (c_custkey % 370) / 100.0D",
                "-94.7D + (c_custkey % 52) / 10.0D", "r_name", "c_nationkey",
                "(c_custkey % 80) + 0.5D", "(c_custkey % 30) / 2.0D",
                "IF(c_custkey % 25 = 0, 'hospital', 'residential')", "c_custkey % 25 = 0")),
            regions().selectExpr(*_site(
                f"concat('network-site-', {_name('agg', 'n_nationkey', 2)})",
                "33.0D + n_nationkey / 10.0D", "-94.0D + n_nationkey / 10.0D", "r_name",
                "n_nationkey", "12.5D", "0.0D", facility, "false")),
            region.selectExpr(*_site(
                f"concat('network-site-', {_name('backhaul', 'r_regionkey', 2)})",
                "34.0D + r_regionkey / 10.0D", "-93.0D + r_regionkey / 10.0D", "r_name",
                "r_regionkey", "20.5D", "0.0D", facility, "false")),
            ixp().selectExpr(*_site(
                f"concat('network-site-', {IXP})", "34.7D", "-92.3D", "'central'", "r_regionkey",
                "0.0D", "0.0D", facility, "false")),
        )

    def devices() -> DataFrame:
        access = customer.selectExpr(
            f"IF(c_custkey % 40 = 9, {_name('spare', 'c_custkey', 4)},"
            f" {_name('device', 'c_custkey', 4)}) AS device_id",
            f"{_name('site', 'c_custkey', 4)} AS site_id",
            "lower(c_mktsegment) AS provider_id", "c_mktsegment AS provider_name",
            f"{TECHNOLOGY} AS technology",
            _pick("c_custkey % 4", "ont", "cable_modem", "cpe", "terminal") + " AS device_class",
            f"concat(upper({TECHNOLOGY}), '-', c_custkey % 3) AS device_model",
            "'subscriber_edge' AS infrastructure_role",
            f"{PLAN} AS advertised_download_mbps", f"{PLAN} / 10.0D AS advertised_upload_mbps",
            "date_add(DATE '2020-01-01', int(c_custkey % 1000)) AS deployment_date")
        return union(
            access,
            nation.selectExpr(*_router(
                _name("agg", "n_nationkey", 2), "RTR-EDGE-2000", "aggregation", "'transit'")),
            region.selectExpr(*_router(
                _name("backhaul", "r_regionkey", 2), "RTR-HAUL-4000", "backhaul", "'transit'")),
            ixp().selectExpr(*_router(IXP, "RTR-CORE-9000", "ixp", "string(NULL)")),
        )

    def dependencies() -> DataFrame:
        return union(
            customer.selectExpr(*_edge(
                _name("device", "c_custkey", 4), _name("agg", "c_nationkey", 2), "access_aggregation")),
            nation.selectExpr(*_edge(
                _name("agg", "n_nationkey", 2), _name("backhaul", "n_regionkey", 2),
                "aggregation_backhaul")),
            region.selectExpr(*_edge(
                _name("backhaul", "r_regionkey", 2), IXP, "backhaul_ixp")),
        )

    def census() -> DataFrame:
        people = customer.groupBy("c_nationkey").agg((F.count(F.lit(1)) * 100).alias("people"))
        area = "(1.0D + n_nationkey)"
        return nation.join(
            people, F.col("n_nationkey") == F.col("c_nationkey"), "left"
        ).selectExpr(
            f"{NATION_GEOID.format('n_nationkey')} AS block_group_geoid",
            "coalesce(people, 0L) AS population", f"{area} AS land_area_sq_miles",
            f"coalesce(people, 0L) / {area} AS population_density_per_sq_mile",
            "33.0D + n_nationkey / 10.0D AS internal_latitude",
            "-94.0D + n_nationkey / 10.0D AS internal_longitude")

    return {"sites": sites, "devices": devices, "device_dependencies": dependencies,
            "census_block_groups": census}


def device_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a device message (`device_topic`, `payload`), some misaddressed."""
    level = F.expr(_by_type(
        "'connectivity'", "'throughput'", "'health'", "'state'", "'infrastructure'"))
    site = F.expr(_name("site", "user_id", 4))
    device = F.expr(_name("device", "user_id", 4))
    place = F.col("event_id") % 31
    topic = (
        F.when(place == 1, F.concat_ws("/", F.lit("network"), F.lit(""), device, level))
        .when(place == 2, F.concat_ws("/", F.lit("network"), site, device, F.lit("firmware")))
        .when(place == 3, F.concat_ws("/", F.lit("network"), site, F.upper(device), level))
        .when(place == 4, F.concat_ws("/", F.lit("network"), site, level))
        .otherwise(F.concat_ws("/", F.lit("network"), site, device, level))
    )
    return _table(spark, sf_dir, "events").select(
        topic.alias("device_topic"), F.encode("props", "UTF-8").alias("payload"))


def offset_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Committed and oldest retained offsets per topic partition: the consumer stopped on
    day 10 and the broker has dropped days 8, 10 and 12 of partitions 0, 1 and 2."""
    sent = deliveries(_table(spark, sf_dir, "events"), sequenced=False)
    day = F.dayofmonth("_kafka_timestamp")
    stopped = F.max(F.when(day <= 10, F.col("_kafka_offset"))) + 1
    oldest = F.min(F.when(day > 8 + F.col("_kafka_partition") * 2, F.col("_kafka_offset")))
    keys = [F.col("_kafka_topic").alias("topic"), F.col("_kafka_partition").alias("partition")]
    committed = sent.groupBy(*keys).agg(stopped.alias("offset")).withColumn(
        "offset", F.when((F.col("topic") == "network.state") & (F.col("partition") == 0), -1)
        .otherwise(F.col("offset")))
    earliest = sent.groupBy(*keys).agg(oldest.alias("offset"))
    return committed, earliest


def manifest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(label, expected): the rows the inventory should have, counted at its source."""
    def rows(name: str) -> DataFrame:
        return _table(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("n"))

    c, n, r = (rows(t).scalar() for t in ("customer", "nation", "region"))
    expected = {
        "census_block_groups": n, "sites": c + n + r + 1, "devices": c + n + r + 1,
        "device_dependencies": c + n + r, "access devices": c,
        "infrastructure devices": n + r + 1, "service sites": c, "network sites": n + r + 1,
    }
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("label"), v.alias("expected")) for k, v in expected.items()])))


def delivered_inventory(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The inventory as a careless supplier would deliver it: every rule is broken by
    some rows, picked by the number in their id."""
    clean = {name: build() for name, build in inventory(spark, sf_dir).items()}

    def numbered(table: str, column: str, prefix: str) -> DataFrame:
        number = f"IF({column} LIKE '{prefix}-%', int(substring_index({column}, '-', -1)), NULL)"
        return clean[table].withColumn("n", F.expr(number))

    def changed(df: DataFrame, **sql: str) -> DataFrame:
        return df.withColumns({c: F.expr(e) for c, e in sql.items()})

    sites = changed(
        numbered("sites", "site_id", "site"),
        region="IF(n % 60 = 1, NULL, region)",
        latitude="IF(n % 61 = 2, 45.0D, latitude)",
        block_group_geoid="IF(n % 62 = 3, concat('06', substring(block_group_geoid, 3)),"
                          " block_group_geoid)",
        distance_to_nearest_place_km="IF(n % 63 = 4, -1.0D, distance_to_nearest_place_km)")
    devices = changed(
        numbered("devices", "device_id", "device"),
        site_id="IF(n % 70 = 1, 'site-none', site_id)",
        advertised_download_mbps="CASE WHEN n % 71 = 2 THEN NULL"
                                 " WHEN device_id LIKE 'agg-%1' THEN 100.0D"
                                 " ELSE advertised_download_mbps END",
        provider_id="IF(n % 72 = 3, NULL, provider_id)",
        technology="IF(n % 74 = 6, '', technology)")
    second_ixp = clean["devices"].where("device_id = 'ixp-01'").withColumn(
        "device_id", F.lit("ixp-02"))
    edges = numbered("device_dependencies", "downstream_device_id", "device")
    edges = changed(
        edges,
        downstream_device_id="IF(n % 80 = 1, concat('gone-', downstream_device_id),"
                             " downstream_device_id)",
        upstream_device_id="CASE WHEN n % 81 = 2 THEN 'agg-99'"
                           " WHEN n % 83 = 4 THEN downstream_device_id"
                           " ELSE upstream_device_id END",
        dependency_type="IF(n % 82 = 3, 'aggregation_backhaul', dependency_type)")
    ixp_edge = clean["device_dependencies"].where("downstream_device_id = 'backhaul-00'") \
        .withColumn("downstream_device_id", F.lit("ixp-02"))
    return {
        "sites": sites.unionByName(sites.where("n % 64 = 5")).drop("n"),
        "devices": devices.unionByName(devices.where("n % 73 = 5")).drop("n")
        .unionByName(second_ixp),
        "device_dependencies": edges.drop("n").unionByName(ixp_edge),
        "census_block_groups": changed(
            clean["census_block_groups"],
            population="IF(int(substring(block_group_geoid, 3)) % 7 = 3, -5L, population)"),
    }
