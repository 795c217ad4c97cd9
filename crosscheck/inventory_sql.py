"""SQL of the reference rules, the quality checks and the geographic queries."""

from __future__ import annotations

from .model_sql import rounded as r
from .model_sql import with_model as m
from .report_sql import ARRIVED_SINCE

TABLE_OF = {"census_block_groups": "d_census", "sites": "d_sites", "devices": "d_devices",
            "device_dependencies": "d_edges"}
KEY_OF = {"census_block_groups": "block_group_geoid", "sites": "site_id",
          "devices": "device_id", "device_dependencies": "downstream_device_id"}
REQUIRED = {
    "census_block_groups": "block_group_geoid population land_area_sq_miles "
                           "internal_latitude internal_longitude",
    "sites": "site_id latitude longitude region block_group_geoid inside_census_urban_area "
             "site_type critical_infrastructure",
    "devices": "device_id site_id technology device_class infrastructure_role deployment_date",
    "device_dependencies": "downstream_device_id upstream_device_id dependency_type",
}
NEGATIVE = {
    "census_block_groups": "population land_area_sq_miles population_density_per_sq_mile",
    "sites": "distance_to_nearest_urban_area_km distance_to_nearest_place_km",
    "devices": "advertised_download_mbps advertised_upload_mbps",
}
ACCESS = "infrastructure_role = 'subscriber_edge'"


def _per_column(rule: str, columns: dict[str, str], condition: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, '{t}.{c}' AS entity, count(*)::VARCHAR AS detail "
        f"FROM {TABLE_OF[t]} WHERE {condition.format(c)} HAVING count(*) > 0"
        for t, names in columns.items() for c in names.split())


RULES = {
    "ref_missing_required": _per_column(
        "missing required value", REQUIRED, "({0} IS NULL OR {0}::VARCHAR = '')"),
    "ref_duplicate_keys": " UNION ALL ".join(
        f"SELECT 'duplicate key' AS rule, '{t}.' || {k} AS entity, count(*)::VARCHAR AS detail "
        f"FROM {TABLE_OF[t]} GROUP BY {k} HAVING count(*) > 1" for t, k in KEY_OF.items()),
    "ref_count_mismatch": f"""
        SELECT 'count mismatch' AS rule, label AS entity,
               'file has ' || actual || ', manifest says ' || expected AS detail
        FROM manifest JOIN (
            SELECT 'census_block_groups' AS label, count(*) AS actual FROM d_census
            UNION ALL SELECT 'sites', count(*) FROM d_sites
            UNION ALL SELECT 'devices', count(*) FROM d_devices
            UNION ALL SELECT 'device_dependencies', count(*) FROM d_edges
            UNION ALL SELECT 'access devices', count(*) FILTER ({ACCESS}) FROM d_devices
            UNION ALL SELECT 'infrastructure devices', count(*) FILTER (NOT {ACCESS})
                FROM d_devices
            UNION ALL SELECT 'service sites',
                count(*) FILTER (site_type <> 'network_facility') FROM d_sites
            UNION ALL SELECT 'network sites',
                count(*) FILTER (site_type = 'network_facility') FROM d_sites) USING (label)
        WHERE actual <> expected""",
    "ref_bad_geoid": """
        SELECT DISTINCT 'malformed block group' AS rule, geoid AS entity, holder AS detail
        FROM (SELECT block_group_geoid AS geoid, 'census_block_groups' AS holder FROM d_census
              UNION ALL SELECT block_group_geoid, 'sites' FROM d_sites)
        WHERE NOT regexp_matches(geoid, '^05[0-9]{10}$')""",
    "ref_out_of_bounds": """
        SELECT 'site out of bounds' AS rule, site_id AS entity,
               latitude || ', ' || longitude AS detail FROM d_sites
        WHERE NOT (latitude BETWEEN 32.9::DOUBLE AND 36.6::DOUBLE
                   AND longitude BETWEEN -94.7::DOUBLE AND -89.5::DOUBLE)""",
    "ref_negative_values": _per_column("negative value", NEGATIVE, "{0} < 0"),
    "ref_orphans": """
        SELECT 'orphan' AS rule, site_id AS entity,
               'sites.block_group_geoid -> census_block_groups' AS detail FROM d_sites x
        WHERE NOT EXISTS (SELECT 1 FROM d_census c
                          WHERE c.block_group_geoid = x.block_group_geoid)
        UNION ALL SELECT 'orphan', device_id, 'devices.site_id -> sites' FROM d_devices x
        WHERE NOT EXISTS (SELECT 1 FROM d_sites s WHERE s.site_id = x.site_id)
        UNION ALL SELECT 'orphan', downstream_device_id,
            'device_dependencies.downstream_device_id -> devices' FROM d_edges x
        WHERE NOT EXISTS (SELECT 1 FROM d_devices d WHERE d.device_id = x.downstream_device_id)
        UNION ALL SELECT 'orphan', upstream_device_id,
            'device_dependencies.upstream_device_id -> devices' FROM d_edges x
        WHERE NOT EXISTS (SELECT 1 FROM d_devices d WHERE d.device_id = x.upstream_device_id)""",
    "ref_speed_rules": f"""
        SELECT 'access device without provider or speed' AS rule, device_id AS entity,
               infrastructure_role AS detail FROM d_devices
        WHERE {ACCESS} AND (advertised_download_mbps IS NULL OR provider_id IS NULL)
        UNION ALL SELECT 'infrastructure device with speed', device_id, infrastructure_role
        FROM d_devices WHERE NOT {ACCESS} AND advertised_download_mbps IS NOT NULL""",
    "ref_site_device_count": """
        SELECT 'service site without exactly one device' AS rule, s.site_id AS entity,
               coalesce(c.n, 0)::VARCHAR AS detail
        FROM d_sites s LEFT JOIN (SELECT site_id, count(*) AS n FROM d_devices GROUP BY 1) c
            ON c.site_id = s.site_id
        WHERE s.site_type <> 'network_facility' AND coalesce(c.n, 0) <> 1""",
    "ref_upstream_rules": """
        SELECT 'IXP with an upstream' AS rule, device_id AS entity, infrastructure_role AS detail
        FROM d_devices WHERE infrastructure_role = 'ixp'
          AND device_id IN (SELECT downstream_device_id FROM d_edges)
        UNION ALL SELECT 'device without an upstream', device_id, infrastructure_role
        FROM d_devices WHERE infrastructure_role <> 'ixp'
          AND device_id NOT IN (SELECT downstream_device_id FROM d_edges)""",
    "ref_unrooted_devices": """
        SELECT DISTINCT 'no path to an IXP' AS rule, device_id AS entity,
               infrastructure_role AS detail
        FROM d_devices WHERE device_id NOT IN (SELECT device_id FROM reached_)""",
    "ref_dependency_roles": """
        SELECT 'dependency type does not fit roles' AS rule, downstream_device_id AS entity,
               dependency_type || ' ' || low || ' ' || high AS detail
        FROM d_edges JOIN (SELECT DISTINCT device_id, infrastructure_role AS low FROM d_devices) a
            ON a.device_id = downstream_device_id
        JOIN (SELECT DISTINCT device_id, infrastructure_role AS high FROM d_devices) b
            ON b.device_id = upstream_device_id
        WHERE (dependency_type, low, high) NOT IN (
            ('access_aggregation', 'subscriber_edge', 'aggregation'),
            ('aggregation_backhaul', 'aggregation', 'backhaul'),
            ('backhaul_ixp', 'backhaul', 'ixp'))""",
}
REACHED = """
    SELECT device_id FROM d_devices WHERE infrastructure_role = 'ixp'
      AND device_id NOT IN (SELECT downstream_device_id FROM d_edges)
    UNION
    SELECT downstream_device_id FROM d_edges JOIN reached_ ON upstream_device_id = device_id"""


def _rule(name: str) -> str:
    sql = m(RULES[name], reached_=REACHED)
    return sql.replace("WITH ", "WITH RECURSIVE ", 1) if "reached_" in sql else sql


ALL_RULES = " UNION ALL ".join(f"SELECT * FROM ({sql})" for sql in RULES.values())

WINDOW = f"_kafka_timestamp >= {ARRIVED_SINCE}"
NOW = "(SELECT max(_kafka_timestamp) FROM accepted)"
AGE = f"(epoch_us({NOW}) - epoch_us(max(_kafka_timestamp)))::DOUBLE / 6e7"
LONELY = {
    "sites_orphan_block_group": ("sites", "block_group_geoid", "census_block_groups",
                                 "block_group_geoid", "true"),
    "devices_orphan_site": ("devices", "site_id", "sites", "site_id", "true"),
    "dependencies_orphan_downstream": (
        "device_dependencies", "downstream_device_id", "devices", "device_id", "true"),
    "dependencies_orphan_upstream": (
        "device_dependencies", "upstream_device_id", "devices", "device_id", "true"),
    "non_ixp_devices_without_upstream": (
        "devices", "device_id", "device_dependencies", "downstream_device_id",
        "infrastructure_role <> 'ixp'"),
}
VALUE_SQL = {
    **{f"{t}_row_count_vs_manifest":
       f"SELECT abs(count(*) - (SELECT expected FROM manifest WHERE label = '{t}')) FROM {t}"
       for t in KEY_OF},
    **{f"{t}_duplicate_keys": f"SELECT count(*) - count(DISTINCT {k}) FROM {t}"
       for t, k in KEY_OF.items()},
    **{name: f"SELECT count(*) FROM {t} x WHERE {cond} AND NOT EXISTS "
             f"(SELECT 1 FROM {target} y WHERE y.{tk} = x.{k})"
       for name, (t, k, target, tk, cond) in LONELY.items()},
    "events_from_unknown_devices":
        f"SELECT count(*) FROM accepted e LEFT JOIN devices d ON d.device_id = e.device_id "
        f"WHERE {WINDOW} AND d.device_id IS NULL",
    "events_with_wrong_site":
        f"SELECT count(*) FROM accepted e JOIN devices d ON d.device_id = e.device_id "
        f"WHERE {WINDOW} AND e.site_id <> d.site_id",
    "replay_duplicate_rows":
        "SELECT count(*) - count(DISTINCT (_kafka_topic, _kafka_partition, _kafka_offset)) "
        f"FROM accepted WHERE {WINDOW}",
    "upstream_duplicate_pct":
        "SELECT 100.0::DOUBLE * (count(*) - count(DISTINCT event_id)) / nullif(count(*), 0) "
        f"FROM accepted WHERE {WINDOW}",
    "reject_pct":
        f"SELECT 100.0::DOUBLE * r / nullif(r + a, 0) FROM (SELECT "
        f"(SELECT count(*) FROM rejects WHERE {WINDOW}) AS r, "
        f"(SELECT count(*) FROM accepted WHERE {WINDOW}) AS a)",
    "minutes_since_last_arrival": f"SELECT {AGE} FROM connectivity_events WHERE {WINDOW}",
    "stalled_beyond_kafka_retention":
        f"SELECT coalesce({AGE}, 1e9) FROM connectivity_events WHERE {WINDOW}",
    "source_clock_skew_minutes":
        "SELECT quantile_disc(epoch_us(_kafka_timestamp) - epoch_us(event_timestamp), 0.5)"
        f"::DOUBLE / 6e7 FROM connectivity_events WHERE {WINDOW}",
    "silent_access_devices":
        f"SELECT count(*) FROM devices WHERE {ACCESS} AND device_id NOT IN "
        f"(SELECT device_id FROM connectivity_events WHERE {WINDOW})",
}
LIMITS = {"upstream_duplicate_pct": 1.0, "reject_pct": 1.0, "minutes_since_last_arrival": 15,
          "stalled_beyond_kafka_retention": 120, "source_clock_skew_minutes": 5}
WARNS = ("replay_duplicate_rows", "upstream_duplicate_pct", "reject_pct",
         "minutes_since_last_arrival", "source_clock_skew_minutes", "silent_access_devices")


def _values(names) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, ({VALUE_SQL[n]})::DOUBLE AS value" for n in names)


def _named_like(*parts: str) -> list[str]:
    return [n for n in VALUE_SQL if any(p in n for p in parts)]


def _findings(names) -> str:
    cases = " ".join(f"WHEN '{n}' THEN {v}" for n, v in LIMITS.items())
    warns = ", ".join(f"'{n}'" for n in WARNS)
    events = ", ".join(f"'{n}'" for n in list(VALUE_SQL)[13:])
    return f"""
        SELECT name, CASE WHEN name IN ({events}) THEN 'event' ELSE 'reference' END AS category,
               severity, threshold, value,
               CASE WHEN value > threshold THEN severity ELSE 'ok' END AS status
        FROM (SELECT *, (CASE name {cases} ELSE 0 END)::DOUBLE AS threshold,
                     CASE WHEN name IN ({warns}) THEN 'warn' ELSE 'fail' END AS severity
              FROM ({_values(names)}))"""


HAVERSINE = """6371.0088::DOUBLE * 2 * asin(sqrt(
    pow(sin((radians(latitude) - radians(a.lat)) / 2), 2)
    + cos(radians(a.lat)) * cos(radians(latitude))
      * pow(sin(radians(longitude - a.lon) / 2), 2)))"""
LOCATED = """
    SELECT d.device_id, d.provider_id, d.technology, d.device_model, s.latitude, s.longitude,
           s.critical_infrastructure
    FROM devices d JOIN sites s ON s.site_id = d.site_id
    WHERE d.infrastructure_role = 'subscriber_edge'"""
ANCHOR = "SELECT latitude AS lat, longitude AS lon FROM located_ WHERE device_id = 'device-0000'"
DENSITY = """
    SELECT block_group_geoid,
           (2 * (rank() OVER (ORDER BY population_density_per_sq_mile) - 1)
            + count(*) OVER (PARTITION BY population_density_per_sq_mile) + 1)::DOUBLE
           / 2.0::DOUBLE / count(*) OVER () AS density_percentile
    FROM census_block_groups"""
SELECTOR = """('0x' || substr(sha256('42|' || event_type || '|' || user_id || '|' || event_id),
    1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0::DOUBLE"""

SQL: dict[str, str] = {
    **{name: _rule(name) for name in RULES},
    "ref_violation_summary": m(
        """SELECT rule, count(*) AS entities,
                  array_to_string(list_sort(list(entity))[1:5], ', ') AS examples
           FROM (SELECT DISTINCT rule, entity FROM all_) GROUP BY 1""",
        reached_=REACHED, all_=ALL_RULES).replace("WITH ", "WITH RECURSIVE ", 1),
    "dq_row_counts": m(_values(_named_like("_row_count_"))),
    "dq_duplicate_keys": m(_values(_named_like("_duplicate_keys"))),
    "dq_orphans": m(_values(LONELY)),
    "dq_unknown_devices": m(_values(["events_from_unknown_devices"])),
    "dq_wrong_site": m(_values(["events_with_wrong_site"])),
    "dq_replay_rows": m(_values(["replay_duplicate_rows"])),
    "dq_duplicate_pct": m(_values(["upstream_duplicate_pct"])),
    "dq_reject_pct": m(_values(["reject_pct"])),
    "dq_freshness": m(_values(["minutes_since_last_arrival", "stalled_beyond_kafka_retention"])),
    "dq_clock_skew": m(_values(["source_clock_skew_minutes"])),
    "dq_silent_devices": m(_values(["silent_access_devices"])),
    "dq_findings": m(_findings(VALUE_SQL)),
    "dq_summary": m(
        f"""SELECT count(*) FILTER (status = 'fail') AS fail,
              count(*) FILTER (status = 'warn') AS warn, count(*) FILTER (status = 'ok') AS ok,
              '' AS missing_groups, count(*) FILTER (status = 'fail') > 0 AS failed
            FROM ({_findings(VALUE_SQL)})"""),
    "dq_technology_signal": m(
        """SELECT technology, expected, sent, count(*) AS rows FROM (
             SELECT d.technology,
               CASE WHEN infrastructure_role <> 'subscriber_edge' THEN ''
                    WHEN d.technology = 'fiber' THEN 'optical_rx_power_dbm'
                    WHEN d.technology = 'coax' THEN 'snr_db'
                    WHEN d.technology = 'fixed_wireless' THEN 'signal_strength_dbm'
                    WHEN d.technology = 'satellite' THEN 'signal_quality_pct' ELSE '' END
                 AS expected,
               concat_ws(', ',
                 CASE WHEN optical_rx_power_dbm IS NOT NULL THEN 'optical_rx_power_dbm' END,
                 CASE WHEN snr_db IS NOT NULL THEN 'snr_db' END,
                 CASE WHEN signal_strength_dbm IS NOT NULL THEN 'signal_strength_dbm' END,
                 CASE WHEN signal_quality_pct IS NOT NULL THEN 'signal_quality_pct' END) AS sent
             FROM device_health_events e JOIN devices d ON d.device_id = e.device_id)
           WHERE sent <> expected GROUP BY 1, 2, 3"""),
    "dq_transition_order": m(
        """SELECT * FROM (
             SELECT subject, event_id, previous_state AS from_step, new_state AS to_step,
                (previous_state, new_state) NOT IN (('online', 'degraded'),
                  ('degraded', 'offline'), ('offline', 'degraded'), ('degraded', 'online'))
                  AS bad_step,
                coalesce(lag(new_state) OVER (PARTITION BY subject
                  ORDER BY event_timestamp, event_id) <> previous_state, false) AS broken_chain
             FROM states_
             UNION ALL
             SELECT subject, event_id, came_from, event_kind,
                (came_from, event_kind) NOT IN (('', 'congestion_started'),
                  ('congestion_started', 'outage_started'),
                  ('outage_started', 'recovery_started'), ('recovery_started', 'recovered')),
                false
             FROM kinds_) WHERE bad_step OR broken_chain""",
        states_="""SELECT DISTINCT device_id AS subject, event_timestamp, event_id,
            previous_state, new_state FROM connectivity_state_events""",
        kinds_="""SELECT *, coalesce(lag(event_kind) OVER (PARTITION BY subject
                ORDER BY event_timestamp, event_id), '') AS came_from
            FROM (SELECT DISTINCT incident_id AS subject, event_timestamp, event_id, event_kind
                  FROM infrastructure_events)"""),
    "density_percentile": m("SELECT * FROM density_", density_=DENSITY),
    "developed_score": m(
        f"""SELECT site_id, {r('''0.55::DOUBLE * density_percentile + 0.45::DOUBLE *
              CASE WHEN inside_census_urban_area THEN 1.0::DOUBLE
              ELSE exp(-distance_to_nearest_urban_area_km / 40.0::DOUBLE) END''', 9)}
              AS developed_score
            FROM sites JOIN density_ USING (block_group_geoid)""", density_=DENSITY),
    "nearest_devices": m(
        f"""SELECT device_id, {r('distance_km', 6)} AS distance_km FROM (
              SELECT device_id, {HAVERSINE} AS distance_km FROM located_, anchor_ a
              ORDER BY 2, 1 LIMIT 40)""", located_=LOCATED, anchor_=ANCHOR),
    "nearest_devices_all": m(
        f"""SELECT anchor_id, device_id, place, {r('distance_km', 6)} AS distance_km FROM (
              SELECT a.anchor_id, device_id, {HAVERSINE} AS distance_km, row_number() OVER (
                PARTITION BY a.anchor_id ORDER BY {HAVERSINE}, device_id)::INT AS place
              FROM located_, anchors_ a) WHERE place <= 5""",
        located_=LOCATED, anchors_="""SELECT d.device_id AS anchor_id, s.latitude AS lat, s.longitude AS lon
            FROM devices d JOIN sites s ON s.site_id = d.site_id
            WHERE d.infrastructure_role <> 'subscriber_edge'"""),
    "eligible_cohorts": m(
        f"""SELECT 'provider_technology' AS kind, provider_id || '|' || technology AS cohort,
              count(*) AS devices FROM located_
            WHERE provider_id IS DISTINCT FROM
                (SELECT provider_id FROM devices WHERE device_id = 'agg-00')
            GROUP BY provider_id, technology HAVING count(*) >= 25 AND count(*) FILTER (
              device_id IN (SELECT downstream_device_id FROM device_dependencies
                            WHERE upstream_device_id = 'agg-00')) = 0
            UNION ALL
            SELECT 'critical_router', upstream_device_id, count(*) FROM located_
            JOIN device_dependencies ON downstream_device_id = device_id
            GROUP BY upstream_device_id HAVING bool_or(critical_infrastructure)
            UNION ALL
            SELECT 'far_anchor', device_id, 1 FROM located_, anchor_ a WHERE {HAVERSINE} >= 150.0
            UNION ALL
            SELECT 'model_peers', device_id, n FROM located_ JOIN (
              SELECT device_model, count(*) AS n FROM located_ GROUP BY 1 HAVING count(*) >= 24)
              USING (device_model) WHERE NOT critical_infrastructure""",
        located_=LOCATED, anchor_=ANCHOR),
    "hash_bands": f"""
        SELECT event_type, user_id, event_id, selector,
          CASE WHEN selector < 0.0025::DOUBLE THEN 'duplicate'
               WHEN selector < 0.0025::DOUBLE + 0.001::DOUBLE THEN 'sequence_gap'
               WHEN selector < 0.0025::DOUBLE + 0.001::DOUBLE + 0.001::DOUBLE THEN 'out_of_order'
               WHEN selector < 0.0025::DOUBLE + 0.001::DOUBLE + 0.001::DOUBLE + 0.0005::DOUBLE
                 THEN 'late_arrival'
               WHEN selector < 0.0025::DOUBLE + 0.001::DOUBLE + 0.001::DOUBLE + 0.0005::DOUBLE
                 + 0.0002::DOUBLE THEN 'poison' ELSE 'clean' END AS label
        FROM (SELECT event_type, user_id, event_id, {SELECTOR} AS selector FROM events)""",
}
