"""SQL of the queries that write files first: what must be there to read back."""

from __future__ import annotations

from .inventory_sql import REACHED, RULES
from .model_sql import with_model as m
from .report_sql import SQL as REPORTS

DAYS = """
    SELECT table_name, event_timestamp::DATE AS day, count(*) AS rows FROM accepted GROUP BY 1, 2
    UNION ALL
    SELECT 'rejected_events', _kafka_timestamp::DATE, count(*) FROM rejects GROUP BY 1, 2"""
TOTALS = "SELECT table_name, sum(rows)::BIGINT AS rows FROM days_ GROUP BY 1"

COMPACTED = m("""SELECT event_id, sequence_number, _kafka_offset, latency_ms,
        event_timestamp::DATE AS event_day FROM connectivity_events""")


def _loaded() -> str:
    # The careless bundle's own manifest states what was delivered, so counts agree.
    careless = " UNION ALL ".join(
        f"SELECT * FROM ({sql})" for name, sql in RULES.items() if name != "ref_count_mismatch")
    body = f"""
        SELECT 'loaded' AS outcome, 'devices' AS what, count(*) AS n FROM devices
        UNION ALL SELECT 'loaded', 'census_block_groups', count(*) FROM census_block_groups
        UNION ALL SELECT 'loaded', 'sites', count(*) FROM sites
        UNION ALL SELECT 'loaded', 'device_dependencies', count(*)
            FROM device_dependencies
        UNION ALL SELECT 'refused', rule, count(*) FROM all_ GROUP BY 2"""
    return m(body, reached_=REACHED, all_=careless).replace("WITH ", "WITH RECURSIVE ", 1)


SQL: dict[str, str] = {
    "stream_ingest": m(
        """SELECT table_name, event_id, sequence_number, _kafka_partition, _kafka_offset,
                  NULL::VARCHAR AS rejection_reason FROM accepted
           UNION ALL
           SELECT 'rejected_events', NULL, NULL, _kafka_partition, _kafka_offset,
                  rejection_reason FROM rejects"""),
    "stream_progress": m(
        """SELECT topic, partition, committed_offset, earliest_offset,
                  greatest(earliest_offset - committed_offset, 0) AS lost_records
           FROM reached_ JOIN earliest_ USING (topic, partition)""",
        reached_="""SELECT _kafka_topic AS topic, _kafka_partition AS partition,
                  max(_kafka_offset) + 1 AS committed_offset FROM delivered GROUP BY 1, 2""",
        earliest_="""SELECT _kafka_topic AS topic, _kafka_partition AS partition,
                  min(_kafka_offset) FILTER (day(_kafka_timestamp) > 8 + _kafka_partition * 2)
                    AS earliest_offset
            FROM delivered GROUP BY 1, 2 HAVING earliest_offset IS NOT NULL"""),
    "route_batch": m(DAYS),
    "replay_batch": m(TOTALS, days_=DAYS),
    "partition_summary": m(DAYS),
    "ensure_table": m(
        """SELECT event_id, sequence_number, _kafka_offset, download_mbps,
                  CASE WHEN day(_kafka_timestamp) > 15 THEN _kafka_key END AS _kafka_key,
                  event_timestamp::DATE AS event_day FROM throughput_events"""),
    "file_stats": m(
        f"""SELECT table_name, rows AS records, true AS all_small, true AS all_small_bytes,
                   'by day' AS layouts FROM ({TOTALS})""", days_=DAYS),
    "maintenance_plan": m(
        f"""SELECT k AS min_small_files, table_name,
                   CASE k WHEN 2 THEN 'compact' ELSE 'skip' END AS action, rows AS records
            FROM ({TOTALS}), (SELECT unnest([2, 1000000]) AS k)""", days_=DAYS),
    "compact": COMPACTED,
    "compact_during_ingest": COMPACTED,
    "compact_large": COMPACTED,
    "curated_events": m("""
        SELECT DISTINCT ON (event_id) table_name, event_id, event_timestamp, device_id,
               sequence_number, _kafka_partition, _kafka_offset, event_timestamp::DATE AS event_day
        FROM accepted
        ORDER BY event_id, _kafka_timestamp, _kafka_topic, _kafka_partition, _kafka_offset"""),
    "file_listing": m("""
        SELECT table_name, event_timestamp::DATE AS day, count(*) AS rows,
               max(_kafka_timestamp) AS last_arrival, true AS has_bytes FROM accepted GROUP BY 1, 2
        UNION ALL
        SELECT 'rejected_events', _kafka_timestamp::DATE, count(*), max(_kafka_timestamp), true
        FROM rejects GROUP BY 2"""),
    **{f"lake_{short}": REPORTS[name] for short, name in (
        ("accepted_totals", "accepted_event_totals"), ("reconciliation", "reconciliation"),
        ("late_records", "late_records"), ("duplicate_origin", "duplicate_origin"))},
    "compact_verify": m(
        f"""SELECT table_name, rows AS rows_before, rows AS rows_after, true AS same_rows
            FROM ({TOTALS})""", days_=DAYS),
    "maintenance_report": m(
        f"""SELECT table_name, rows AS records_before, rows AS records_after,
                   'ok' AS status, true AS fewer_files FROM ({TOTALS})""", days_=DAYS),
    "read_reference": m("SELECT * FROM devices"),
    "header_check": "SELECT 'header' AS rule, 'device_dependencies' AS entity, "
                    "'child,parent,dependency_type' AS detail",
    "checksum_check": "SELECT 'checksum' AS rule, 'census_block_groups' AS entity",
    "publish_reference": m("SELECT *, 'inventory/v1/sites.csv' AS _source_file FROM sites"),
    "load_reference": _loaded(),
    "export_report": REPORTS["device_statistics"],
    "verify_export": m(
        """SELECT true AS sha256_matches, true AS row_count_matches, count(*) AS rows_read
           FROM (SELECT device_id FROM connectivity_events UNION
                 SELECT device_id FROM throughput_events)"""),
}
