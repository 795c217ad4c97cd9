"""Raw broker records to typed event rows and lossless reject rows.

Input everywhere is a DataFrame of the Kafka source's shape (key, value, topic,
partition, offset, timestamp), batch or streaming.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import ACCESS_DIGITS, IDENTIFIER, PAYLOADS
from ..functions.contract_rules import (
    PREFIX, contract_violation, payload_fields, quoted, surely_valid, typed_document, whole,
)
from ..model import FAMILIES, MEASURE_DDL, REJECTED_DDL, event_schema, family_of, schema_of

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSX"
# The routes of device topics network/<site>/<device>/<family>.
TOPIC_ROUTES = {
    "connectivity": "network.connectivity",
    "throughput": "network.throughput",
    "health": "network.device_health",
    "state": "network.state",
    "infrastructure": "network.infrastructure",
}


def once(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add computed columns so that they are computed once per row.

    Later filters and projections on a plain projection are merged into it, which would
    repeat the JSON parse for every rule that looks at it. A one-element generator keeps
    them apart, also in the generated code, whose methods the JVM leaves uncompiled beyond 8,000
    bytes.
    """
    members = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return df.selectExpr("*", f"inline(array(named_struct({members})))")


def _by_topic(attribute: str) -> str:
    cases = " ".join(f"WHEN '{f.topic}' THEN '{getattr(f, attribute)}'" for f in FAMILIES)
    return f"CASE topic {cases} END"


def classify(raw: DataFrame, access_digits: str = ACCESS_DIGITS) -> DataFrame:
    """One row per record: `target_table` when accepted, else `rejection_reason`, with
    the typed columns of all families (NULL where not the record's own).

    The first failing step gives the reason: empty value, encoding, JSON, object, event
    type, contract, topic, event type of the topic, timestamp. JSON objects with
    duplicate keys or NaN count as invalid JSON. `access_digits` says how many digits ids of
    access devices have.
    """
    readable = "IF(length(value) > 0 AND is_valid_utf8(string(value)), string(value), NULL)"
    parsed = once(raw, {"_json": f"try_parse_json({readable})"})
    opened = once(parsed, {
        "_doc": f"try_variant_get(_json, '$', '{typed_document()}')",
        "_shape": "schema_of_variant(_json)",
    })
    dated = once(opened, {
        "event_timestamp":
            f"try_to_timestamp(_doc.event_timestamp, {quoted(TIMESTAMP_FORMAT)})",
    })
    sound = f"""{surely_valid('_shape', '_doc', access_digits)}
        AND _doc.event_type = {_by_topic('event_type')}
        AND event_timestamp IS NOT NULL AND _doc.sequence_number IS NOT NULL"""
    # The lambda keeps the long explanation out of the generated code of sound records.
    explained = f"IF({sound}, NULL, transform(array(0), x -> {_explanation(access_digits)})[0])"
    reasoned = once(
        dated.selectExpr("*", f"{explained} AS _reason"), {"rejection_reason": "_reason"})
    return reasoned.selectExpr(
        f"IF(rejection_reason IS NULL, {_by_topic('table')}, NULL) AS target_table",
        "rejection_reason",
        "int(_doc.schema_version) AS schema_version",
        "_doc.event_id AS event_id", "_doc.event_type AS event_type",
        "event_timestamp",
        "_doc.device_session_id AS device_session_id",
        "_doc.sequence_number AS sequence_number",
        "_doc.site_id AS site_id", "_doc.device_id AS device_id",
        "topic AS _kafka_topic", "partition AS _kafka_partition", "offset AS _kafka_offset",
        "timestamp AS _kafka_timestamp",
        *[f"_doc.payload.{f.name} AS {f.name}" for f in payload_fields()],
        "IF(length(key) > 0, make_valid_utf8(string(key)), NULL) AS _kafka_key",
        "current_timestamp() AS _processed_at",
        "value AS raw_value",
    )


def _explanation(access_digits: str) -> str:
    """Why a record is rejected, or NULL when it is sound after all."""
    families = ", ".join(quoted(f) for f in PAYLOADS)
    event_type = "try_variant_get(_json, '$.event_type', 'string')"
    kind = "schema_of_variant(try_variant_get(_json, '$.event_type', 'variant'))"
    return f"""CASE
        WHEN value IS NULL OR length(value) = 0 THEN 'Empty Kafka value'
        WHEN NOT is_valid_utf8(string(value)) THEN 'Invalid JSON: not valid UTF-8'
        WHEN _json IS NULL THEN 'Invalid JSON: malformed document'
        WHEN NOT startswith(_shape, 'OBJECT<') THEN 'Invalid JSON: expected an object'
        WHEN NOT coalesce({kind} = 'STRING' AND {event_type} IN ({families}), false)
            THEN concat("Unknown or missing event_type: '", coalesce({event_type}, 'None'), "'")
        ELSE coalesce(
            '{PREFIX}' || {contract_violation('_json', event_type, access_digits)},
            CASE WHEN {_by_topic('table')} IS NULL THEN concat('Unmapped topic: ', topic)
                 WHEN {event_type} <> {_by_topic('event_type')} THEN concat(
                    "event_type '", {event_type}, "' not allowed on topic ", topic,
                    " (expected '", {_by_topic('event_type')}, "')")
                 WHEN event_timestamp IS NULL THEN concat(
                    'Cannot map to ', {_by_topic('table')}, ': no such date ',
                    _doc.event_timestamp)
                 WHEN _doc.sequence_number IS NULL THEN concat(
                    'Cannot map to ', {_by_topic('table')}, ': sequence_number out of range')
            END)
        END"""


def accepted_rows(classified: DataFrame, table: str) -> DataFrame:
    """The rows of one event table, in its stored schema."""
    return classified.where(F.col("target_table") == family_of(table).table).select(
        *[F.col("_processed_at").alias(c) if c == "_ingested_at" else F.col(c)
          for c in event_schema(table).names]
    )


def rejected_rows(classified: DataFrame) -> DataFrame:
    """The reject rows: exact bytes, readable copy, coordinates, reason, time."""
    text = F.make_valid_utf8(F.col("raw_value").cast("string"))
    sources = {
        "raw_payload": F.coalesce(text, F.lit("")), "rejected_at": F.col("_processed_at"),
    }
    return classified.where(F.col("rejection_reason").isNotNull()).select(
        *[sources.get(c, F.col(c)).alias(c) for c in schema_of(REJECTED_DDL).names]
    )


def typed_events(
    raw: DataFrame, table: str, access_digits: str = ACCESS_DIGITS
) -> DataFrame:
    return accepted_rows(classify(raw, access_digits), table)


def rejected(raw: DataFrame, access_digits: str = ACCESS_DIGITS) -> DataFrame:
    return rejected_rows(classify(raw, access_digits))


def measure_columns(table: str) -> list[str]:
    return schema_of(MEASURE_DDL[table]).names


def skipped_offsets(committed: DataFrame, earliest: DataFrame) -> DataFrame:
    """Records a consumer can no longer read, per topic partition.

    `committed` and `earliest` hold (topic, partition, offset). A negative or absent
    committed offset is a first start, not a loss; so is a partition without a known
    oldest offset.
    """
    keys = ["topic", "partition"]
    return (
        committed.where(F.col("offset") >= 0)
        .select(*keys, F.col("offset").alias("committed_offset"))
        .join(earliest.select(*keys, F.col("offset").alias("earliest_offset")), keys)
        .select(
            *keys, "committed_offset", "earliest_offset",
            F.greatest(F.col("earliest_offset") - F.col("committed_offset"), F.lit(0))
            .alias("lost_records"),
        )
    )


def route_messages(messages: DataFrame) -> DataFrame:
    """Target topic and key of device messages (`device_topic`, `payload`), or why not.

    A message is routed when its topic has no empty level, is network/<site>/<device>/
    <known family>, and its device level is a valid key.
    """
    levels = F.split("device_topic", "/")
    family = F.when((F.size(levels) == 4) & (levels[0] == "network"), levels[3])
    target = F.coalesce(*[F.when(family == k, F.lit(v)) for k, v in TOPIC_ROUTES.items()])
    problem = (
        F.when(F.col("device_topic").isNull(), "topic is missing")
        .when(F.array_contains(levels, ""), "topic has an empty level")
        .when(target.isNull(), "topic matches no route")
        .when(~levels[2].rlike(whole(IDENTIFIER)), "key level is not an identifier")
    )
    routed = messages.withColumns({"_target": target, "_key": levels[2], "routing_error": problem})
    sound = F.col("routing_error").isNull()
    return routed.select(
        "device_topic", "payload",
        F.when(sound, F.col("_target")).alias("kafka_topic"),
        F.when(sound, F.encode("_key", "UTF-8")).alias("kafka_key"),
        "routing_error",
    )
