"""The network model on the bench tables, as DuckDB common table expressions.

Written independently of the Spark adapter from the same description; only what a query
names is kept in front of it (`with_model`).
"""

from __future__ import annotations

import re

FAMILY_CASE = """CASE bench_type WHEN 'click' THEN {0} WHEN 'view' THEN {1}
    WHEN 'purchase' THEN {2} WHEN 'signup' THEN {3} ELSE {4} END"""


def _by_family(*values: str) -> str:
    return FAMILY_CASE.format(*[f"'{v}'" for v in values])


FAMILIES = _by_family("connectivity_metric", "throughput_test", "device_health",
                      "connectivity_state", "infrastructure_event")
TABLES = _by_family("connectivity_events", "throughput_events", "device_health_events",
                    "connectivity_state_events", "infrastructure_events")
TOPICS = _by_family("network.connectivity", "network.throughput", "network.device_health",
                    "network.state", "network.infrastructure")
NEXT_TOPICS = _by_family("network.throughput", "network.device_health", "network.state",
                         "network.infrastructure", "network.connectivity")
NEXT_FAMILIES = _by_family("throughput_test", "device_health", "connectivity_state",
                           "infrastructure_event", "connectivity_metric")

ENVELOPE = """schema_version, event_id, event_type, event_timestamp, device_session_id,
    sequence_number, site_id, device_id, _kafka_topic, _kafka_partition, _kafka_offset,
    _kafka_timestamp"""

MEASURES = {
    "connectivity_events": "latency_ms, jitter_ms, packet_loss_pct",
    "throughput_events": "download_mbps, upload_mbps",
    "device_health_events": """cpu_pct, memory_pct, temperature_c, optical_rx_power_dbm, snr_db,
        signal_strength_dbm, signal_quality_pct""",
    "connectivity_state_events": "previous_state, new_state, reason",
    "infrastructure_events": "incident_id, event_kind, severity",
}
FAMILY_OF = {
    "connectivity_events": "connectivity_metric", "throughput_events": "throughput_test",
    "device_health_events": "device_health", "connectivity_state_events": "connectivity_state",
    "infrastructure_events": "infrastructure_event",
}

CTES: dict[str, str] = {
    "src": """
        SELECT event_id, ts, user_id, event_type AS bench_type, value,
               CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END AS half,
               row_number() OVER (
                   PARTITION BY user_id, event_type, CASE WHEN day(ts) > 15 THEN 1 ELSE 0 END
                   ORDER BY event_id) AS sequence_number,
               CASE WHEN event_id % 499 = 3 THEN 22
                    WHEN event_id % 1009 BETWEEN 1 AND 21 THEN event_id % 1009
                    ELSE 0 END AS fault,
               epoch_us(ts) // 1000 AS arrived_ms,
               user_id % 25 AS router
        FROM events""",
    "copies": """
        SELECT *, 0 AS copy FROM src
        UNION ALL
        SELECT *, 1 AS copy FROM src WHERE event_id % 400 = 7
        UNION ALL
        SELECT *, 2 AS copy FROM src WHERE event_id % 1000 = 13""",
    "delivered": f"""
        SELECT fault, bench_type, {TABLES} AS table_name,
               1 AS schema_version,
               format('00000000-0000-4000-8000-{{:012x}}', event_id) AS event_id,
               {FAMILIES} AS event_type,
               make_timestamp((arrived_ms - floor(value * 600000.0)::BIGINT) * 1000)
                   AS event_timestamp,
               format('00000000-0000-4000-9000-{{:012x}}', user_id * 2 + half)
                   AS device_session_id,
               sequence_number + sequence_number // 20 AS sequence_number,
               CASE WHEN bench_type = 'error' THEN format('network-site-agg-{{:02d}}', router)
                    ELSE format('site-{{:04d}}', user_id) END AS site_id,
               CASE WHEN bench_type = 'error' THEN format('agg-{{:02d}}', router)
                    ELSE format('device-{{:04d}}', user_id) END AS device_id,
               {TOPICS} AS _kafka_topic,
               (CASE WHEN bench_type = 'error' THEN router ELSE user_id END % 3)::INT
                   AS _kafka_partition,
               event_id * 2 + CASE WHEN copy = 1 THEN 1 ELSE 0 END AS _kafka_offset,
               make_timestamp(arrived_ms * 1000) AS _kafka_timestamp,
               make_timestamp((arrived_ms + 250) * 1000) AS _ingested_at,
               CASE WHEN bench_type = 'click' THEN value END AS latency_ms,
               CASE WHEN bench_type = 'click' THEN value / 10.0::DOUBLE END AS jitter_ms,
               CASE WHEN bench_type = 'click' THEN value % 5.0::DOUBLE END AS packet_loss_pct,
               CASE WHEN bench_type = 'view' THEN value + 1.0::DOUBLE END AS download_mbps,
               CASE WHEN bench_type = 'view' THEN (value + 1.0::DOUBLE) / 4.0::DOUBLE END
                   AS upload_mbps,
               CASE WHEN bench_type = 'purchase' THEN value % 100.0::DOUBLE END AS cpu_pct,
               CASE WHEN bench_type = 'purchase' THEN (value * 2.0::DOUBLE) % 100.0::DOUBLE END
                   AS memory_pct,
               CASE WHEN bench_type = 'purchase' THEN value % 60.0::DOUBLE + 20.0::DOUBLE END
                   AS temperature_c,
               CASE WHEN bench_type = 'purchase' AND event_id % 70 <> 11 AND user_id % 4 = 0
                    THEN value % 30.0::DOUBLE - 30.0::DOUBLE END AS optical_rx_power_dbm,
               CASE WHEN bench_type = 'purchase' AND (event_id % 50 = 9
                         OR (event_id % 70 <> 11 AND user_id % 4 = 1))
                    THEN value % 60.0::DOUBLE END AS snr_db,
               CASE WHEN bench_type = 'purchase' AND event_id % 70 <> 11 AND user_id % 4 = 2
                    THEN value % 100.0::DOUBLE - 120.0::DOUBLE END AS signal_strength_dbm,
               CASE WHEN bench_type = 'purchase' AND event_id % 70 <> 11 AND user_id % 4 = 3
                    THEN value % 100.0::DOUBLE END AS signal_quality_pct,
               CASE WHEN bench_type = 'signup' THEN
                    CASE (event_id // 3) % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'degraded'
                    ELSE 'offline' END END AS previous_state,
               CASE WHEN bench_type = 'signup' THEN
                    CASE event_id % 3 WHEN 0 THEN 'online' WHEN 1 THEN 'degraded'
                    ELSE 'offline' END END AS new_state,
               CASE WHEN bench_type = 'signup' THEN
                    CASE event_id % 4 WHEN 0 THEN 'upstream_congestion'
                    WHEN 1 THEN 'upstream_outage' WHEN 2 THEN 'upstream_recovery'
                    ELSE 'upstream_recovered' END END AS reason,
               CASE WHEN bench_type = 'error' THEN
                    format('00000000-0000-4000-a000-{{:012x}}',
                           router * 100000 + arrived_ms // 432000000) END AS incident_id,
               CASE WHEN bench_type = 'error' THEN
                    CASE event_id % 4 WHEN 0 THEN 'congestion_started' WHEN 1 THEN 'outage_started'
                    WHEN 2 THEN 'recovery_started' ELSE 'recovered' END END AS event_kind,
               CASE WHEN bench_type = 'error' THEN
                    CASE event_id % 4 WHEN 0 THEN 'warning' WHEN 1 THEN 'critical'
                    WHEN 2 THEN 'warning' ELSE 'info' END END AS severity
        FROM copies""",
    "accepted": "SELECT * FROM delivered WHERE fault = 0",
    **{t: f"SELECT {ENVELOPE}, {m}, device_id AS _kafka_key, _ingested_at FROM accepted "
          f"WHERE event_type = '{FAMILY_OF[t]}'" for t, m in MEASURES.items()},
    "rejects": f"""
        SELECT CASE fault WHEN 7 THEN {NEXT_TOPICS} WHEN 8 THEN 'network.unknown'
                    ELSE _kafka_topic END AS _kafka_topic,
               _kafka_partition, _kafka_offset, _kafka_timestamp, device_id AS _kafka_key,
               CASE fault
                 WHEN 1 THEN 'Empty Kafka value'
                 WHEN 2 THEN 'Invalid JSON: not valid UTF-8'
                 WHEN 3 THEN 'Invalid JSON: expected an object'
                 WHEN 4 THEN 'Invalid JSON: expected an object'
                 WHEN 5 THEN 'Unknown or missing event_type: ''reboot'''
                 WHEN 6 THEN 'Unknown or missing event_type: ''None'''
                 WHEN 7 THEN 'event_type ''' || event_type || ''' not allowed on topic '
                     || {NEXT_TOPICS} || ' (expected ''' || {NEXT_FAMILIES} || ''')'
                 WHEN 8 THEN 'Unmapped topic: network.unknown'
                 WHEN 9 THEN 'Cannot map to ' || table_name
                     || ': no such date 2026-13-45T18:00:00.000Z'
                 WHEN 22 THEN 'Invalid JSON: malformed document'
                 ELSE 'Schema validation error: ' || CASE fault
                   WHEN 10 THEN 'unexpected payload field rtt_ms'
                   WHEN 11 THEN 'unexpected envelope field region'
                   WHEN 12 THEN 'device_session_id is required'
                   WHEN 13 THEN 'event_timestamp does not match '
                     || '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}'
                     || '\\.[0-9]{{3}}Z$'
                   WHEN 14 THEN 'sequence_number is below 1'
                   WHEN 15 THEN 'schema_version must be 1'
                   WHEN 16 THEN 'event_id does not match ^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-'
                     || '[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$'
                   WHEN 17 THEN 'device_id does not match ^[a-z0-9][a-z0-9_-]*$'
                   WHEN 18 THEN 'payload.' || CASE bench_type WHEN 'click' THEN 'latency_ms'
                     WHEN 'view' THEN 'download_mbps' WHEN 'purchase' THEN 'cpu_pct'
                     WHEN 'signup' THEN 'previous_state' ELSE 'incident_id' END || ' is required'
                   WHEN 19 THEN 'payload.' || CASE bench_type
                     WHEN 'click' THEN 'latency_ms must be of type number'
                     WHEN 'view' THEN 'download_mbps must be of type number'
                     WHEN 'purchase' THEN 'cpu_pct must be of type number'
                     WHEN 'signup' THEN 'previous_state must be of type string'
                     ELSE 'incident_id must be of type string' END
                   WHEN 20 THEN 'payload.' || CASE bench_type
                     WHEN 'click' THEN 'latency_ms is below 0'
                     WHEN 'view' THEN 'download_mbps must be above 0'
                     WHEN 'purchase' THEN 'cpu_pct is above 100'
                     WHEN 'signup' THEN
                       'new_state must be one of [''online'', ''degraded'', ''offline'']'
                     ELSE 'event_kind must be one of [''congestion_started'', '
                       || '''outage_started'', ''recovery_started'', ''recovered'']' END
                   WHEN 21 THEN 'payload must be an object'
                 END
               END AS rejection_reason
        FROM delivered WHERE fault <> 0""",
    "places": """
        SELECT n_nationkey, n_regionkey, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "sites": """
        SELECT format('site-{:04d}', c_custkey) AS site_id,
               32.9::DOUBLE + (c_custkey % 370) / 100.0::DOUBLE AS latitude,
               -94.7::DOUBLE + (c_custkey % 52) / 10.0::DOUBLE AS longitude,
               r_name AS region, '05' || lpad(c_nationkey::VARCHAR, 10, '0') AS block_group_geoid,
               c_nationkey % 2 = 0 AS inside_census_urban_area,
               CASE WHEN c_nationkey % 2 = 0 THEN 'Area ' || c_nationkey END AS urban_area_name,
               CASE WHEN c_nationkey % 2 = 0 THEN 0.0::DOUBLE
                    ELSE (c_custkey % 80) + 0.5::DOUBLE END AS distance_to_nearest_urban_area_km,
               'Place ' || c_nationkey AS nearest_census_place,
               (c_custkey % 30) / 2.0::DOUBLE AS distance_to_nearest_place_km,
               CASE WHEN c_custkey % 25 = 0 THEN 'hospital' ELSE 'residential' END AS site_type,
               c_custkey % 25 = 0 AS critical_infrastructure
        FROM customer JOIN places ON c_nationkey = n_nationkey
        UNION ALL
        SELECT format('network-site-agg-{:02d}', n_nationkey),
               33.0::DOUBLE + n_nationkey / 10.0::DOUBLE,
               -94.0::DOUBLE + n_nationkey / 10.0::DOUBLE, r_name,
               '05' || lpad(n_nationkey::VARCHAR, 10, '0'), n_nationkey % 2 = 0,
               CASE WHEN n_nationkey % 2 = 0 THEN 'Area ' || n_nationkey END,
               CASE WHEN n_nationkey % 2 = 0 THEN 0.0::DOUBLE ELSE 12.5::DOUBLE END,
               'Place ' || n_nationkey, 0.0::DOUBLE, 'network_facility', false
        FROM places
        UNION ALL
        SELECT format('network-site-backhaul-{:02d}', r_regionkey),
               34.0::DOUBLE + r_regionkey / 10.0::DOUBLE,
               -93.0::DOUBLE + r_regionkey / 10.0::DOUBLE, r_name,
               '05' || lpad(r_regionkey::VARCHAR, 10, '0'), r_regionkey % 2 = 0,
               CASE WHEN r_regionkey % 2 = 0 THEN 'Area ' || r_regionkey END,
               CASE WHEN r_regionkey % 2 = 0 THEN 0.0::DOUBLE ELSE 20.5::DOUBLE END,
               'Place ' || r_regionkey, 0.0::DOUBLE, 'network_facility', false
        FROM region
        UNION ALL
        SELECT 'network-site-ixp-01', 34.7::DOUBLE, -92.3::DOUBLE, 'central', '050000000000',
               true, 'Area 0', 0.0::DOUBLE, 'Place 0', 0.0::DOUBLE, 'network_facility', false""",
    "devices": """
        SELECT CASE WHEN c_custkey % 40 = 9 THEN format('spare-{:04d}', c_custkey)
                    ELSE format('device-{:04d}', c_custkey) END AS device_id,
               format('site-{:04d}', c_custkey) AS site_id,
               lower(c_mktsegment) AS provider_id, c_mktsegment AS provider_name,
               CASE c_custkey % 4 WHEN 0 THEN 'fiber' WHEN 1 THEN 'coax'
                    WHEN 2 THEN 'fixed_wireless' ELSE 'satellite' END AS technology,
               CASE c_custkey % 4 WHEN 0 THEN 'ont' WHEN 1 THEN 'cable_modem'
                    WHEN 2 THEN 'cpe' ELSE 'terminal' END AS device_class,
               CASE c_custkey % 4 WHEN 0 THEN 'FIBER' WHEN 1 THEN 'COAX'
                    WHEN 2 THEN 'FIXED_WIRELESS' ELSE 'SATELLITE' END
                    || '-' || (c_custkey % 3) AS device_model,
               'subscriber_edge' AS infrastructure_role,
               CASE (c_custkey // 4) % 3 WHEN 0 THEN 100.0 WHEN 1 THEN 300.0
                    ELSE 1000.0 END::DOUBLE AS advertised_download_mbps,
               CASE (c_custkey // 4) % 3 WHEN 0 THEN 10.0 WHEN 1 THEN 30.0
                    ELSE 100.0 END::DOUBLE AS advertised_upload_mbps,
               (DATE '2020-01-01' + (c_custkey % 1000)::INT)::DATE AS deployment_date
        FROM customer
        UNION ALL
        SELECT format('agg-{:02d}', n_nationkey), format('network-site-agg-{:02d}', n_nationkey),
               'transit', 'transit', 'fiber', 'aggregation_router', 'RTR-EDGE-2000',
               'aggregation', NULL, NULL, DATE '2020-01-01' FROM nation
        UNION ALL
        SELECT format('backhaul-{:02d}', r_regionkey),
               format('network-site-backhaul-{:02d}', r_regionkey),
               'transit', 'transit', 'fiber', 'backhaul_router', 'RTR-HAUL-4000', 'backhaul',
               NULL, NULL, DATE '2020-01-01' FROM region
        UNION ALL
        SELECT 'ixp-01', 'network-site-ixp-01', NULL, NULL, 'fiber', 'ixp_router',
               'RTR-CORE-9000', 'ixp', NULL, NULL, DATE '2020-01-01'""",
    "device_dependencies": """
        SELECT format('device-{:04d}', c_custkey) AS downstream_device_id,
               format('agg-{:02d}', c_nationkey) AS upstream_device_id,
               'access_aggregation' AS dependency_type FROM customer
        UNION ALL
        SELECT format('agg-{:02d}', n_nationkey), format('backhaul-{:02d}', n_regionkey),
               'aggregation_backhaul' FROM nation
        UNION ALL
        SELECT format('backhaul-{:02d}', r_regionkey), 'ixp-01', 'backhaul_ixp' FROM region""",
    "people": "SELECT c_nationkey, count(*) * 100 AS population FROM customer GROUP BY 1",
    "census_block_groups": """
        SELECT '05' || lpad(n_nationkey::VARCHAR, 10, '0') AS block_group_geoid,
               coalesce(population, 0)::BIGINT AS population,
               (1.0 + n_nationkey)::DOUBLE AS land_area_sq_miles,
               coalesce(population, 0)::DOUBLE / (1.0 + n_nationkey)::DOUBLE
                   AS population_density_per_sq_mile,
               33.0::DOUBLE + n_nationkey / 10.0::DOUBLE AS internal_latitude,
               -94.0::DOUBLE + n_nationkey / 10.0::DOUBLE AS internal_longitude
        FROM nation LEFT JOIN people ON n_nationkey = c_nationkey""",
    "manifest": """
        SELECT unnest(['census_block_groups', 'sites', 'devices', 'device_dependencies',
                       'access devices', 'infrastructure devices', 'service sites',
                       'network sites']) AS label,
               unnest([n, c + n + r + 1, c + n + r + 1, c + n + r, c, n + r + 1, c, n + r + 1])
                   AS expected
        FROM (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM nation) AS n,
                     (SELECT count(*) FROM region) AS r)""",
    "numbered_sites": """
        SELECT *, CASE WHEN site_id LIKE 'site-%' THEN substr(site_id, 6)::INT END AS n
        FROM sites""",
    "spoilt_sites": """
        SELECT * REPLACE (
            CASE WHEN n % 60 = 1 THEN NULL ELSE region END AS region,
            CASE WHEN n % 61 = 2 THEN 45.0::DOUBLE ELSE latitude END AS latitude,
            CASE WHEN n % 62 = 3 THEN '06' || substr(block_group_geoid, 3)
                 ELSE block_group_geoid END AS block_group_geoid,
            CASE WHEN n % 63 = 4 THEN -1.0::DOUBLE ELSE distance_to_nearest_place_km END
                AS distance_to_nearest_place_km)
        FROM numbered_sites""",
    "d_sites": """
        SELECT * FROM spoilt_sites UNION ALL SELECT * FROM spoilt_sites WHERE n % 64 = 5""",
    "spoilt_devices": """
        SELECT * REPLACE (
            CASE WHEN n % 70 = 1 THEN 'site-none' ELSE site_id END AS site_id,
            CASE WHEN n % 71 = 2 THEN NULL WHEN device_id LIKE 'agg-%1' THEN 100.0::DOUBLE
                 ELSE advertised_download_mbps END AS advertised_download_mbps,
            CASE WHEN n % 72 = 3 THEN NULL ELSE provider_id END AS provider_id,
            CASE WHEN n % 74 = 6 THEN '' ELSE technology END AS technology)
        FROM (SELECT *, CASE WHEN device_id LIKE 'device-%' THEN substr(device_id, 8)::INT END
                  AS n FROM devices)""",
    "d_devices": """
        SELECT * FROM spoilt_devices UNION ALL SELECT * FROM spoilt_devices WHERE n % 73 = 5
        UNION ALL SELECT * REPLACE ('ixp-02' AS device_id) FROM spoilt_devices
        WHERE device_id = 'ixp-01'""",
    "d_edges": """
        SELECT CASE WHEN n % 80 = 1 THEN 'gone-' || downstream_device_id
                    ELSE downstream_device_id END AS downstream_device_id,
               CASE WHEN n % 81 = 2 THEN 'agg-99' WHEN n % 83 = 4 THEN downstream_device_id
                    ELSE upstream_device_id END AS upstream_device_id,
               CASE WHEN n % 82 = 3 THEN 'aggregation_backhaul' ELSE dependency_type END
                   AS dependency_type
        FROM (SELECT *, CASE WHEN downstream_device_id LIKE 'device-%'
                  THEN substr(downstream_device_id, 8)::INT END AS n FROM device_dependencies)
        UNION ALL SELECT 'ixp-02', 'ixp-01', 'backhaul_ixp'""",
    "d_census": """
        SELECT * REPLACE (CASE WHEN substr(block_group_geoid, 3)::BIGINT % 7 = 3 THEN -5
            ELSE population END AS population) FROM census_block_groups""",
}


def with_model(body: str, **extra: str) -> str:
    """Put the model's CTEs that `body` (transitively) names in front of it.

    `extra` adds query-specific CTEs; they follow the model's. `body` is a SELECT.
    """
    known = {**CTES, **extra}
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_][a-z0-9_]*", text)):
            if word in known and word not in needed:
                needed.add(word)
                visit(known[word])

    visit(body)
    parts = [f"{name} AS ({known[name]})" for name in known if name in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def rounded(expression: str, digits: int) -> str:
    """Half-up rounding of a DOUBLE at its decimal digits, as Spark rounds."""
    return f"round(({expression})::DECIMAL(38,12), {digits})::DOUBLE"
