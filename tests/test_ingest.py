from datetime import datetime

from pyspark.sql import functions as F

from beaconlake.model import ALL_TABLES, EVENT_TABLES, event_schema, family_of
from beaconlake.operators import ingest
from beaconlake.sources import benchdata

from .records import ARRIVED, BROKEN, CONNECTIVITY, VALID, changed, encoded, raw


def _reasons(spark, records):
    rows = ingest.classify(raw(spark, *records)).orderBy("_kafka_offset").collect()
    return [(r["target_table"], r["rejection_reason"]) for r in rows]


def test_valid_events_are_accepted(spark):
    found = _reasons(spark, [encoded(e) for e in VALID.values()])
    assert [r for r in found if r[1]] == []
    for (table, _), event in zip(found, VALID.values()):
        assert family_of(table).event_type == event["event_type"]


def test_each_broken_rule_is_rejected_with_a_contract_reason(spark):
    found = _reasons(spark, [encoded(e) for e in BROKEN.values()])
    for name, (table, reason) in zip(BROKEN, found):
        assert table is None, name
        assert reason.startswith("Schema validation error: "), (name, reason)


def test_unreadable_and_misrouted_records(spark):
    good = encoded(CONNECTIVITY)
    cases = {
        "Empty Kafka value": (b"", good[1]),
        "Empty Kafka value ": (None, good[1]),
        "Invalid JSON: malformed document": (b"{ bad json", good[1]),
        "Invalid JSON: not valid UTF-8": (b'{"a":"\xff\xfe"}', good[1]),
        "Invalid JSON: expected an object": (b"5", good[1]),
        "Invalid JSON: expected an object ": (b"[1, 2]", good[1]),
        "Invalid JSON: expected an object  ": (b"null", good[1]),
        "Unknown or missing event_type: 'reboot'": encoded(changed(event_type="reboot")),
        "Unknown or missing event_type: '5'": (
            good[0].replace(b'"connectivity_metric"', b"5"), good[1]),
        "Unmapped topic: network.unknown": (good[0], "network.unknown"),
        "event_type 'connectivity_metric' not allowed on topic network.state "
        "(expected 'connectivity_state')": (good[0], "network.state"),
        "Cannot map to connectivity_events: no such date 2026-13-45T18:00:00.000Z": encoded(
            changed(event_timestamp="2026-13-45T18:00:00.000Z")),
        "Cannot map to connectivity_events: no such date 2026-02-30T18:00:00.000Z": encoded(
            changed(event_timestamp="2026-02-30T18:00:00.000Z")),
        "Cannot map to connectivity_events: sequence_number out of range": encoded(
            changed(sequence_number=2 ** 70)),
    }
    found = _reasons(spark, list(cases.values()))
    assert [r for _, r in found] == [name.rstrip() for name in cases]


def test_the_first_failing_step_gives_the_reason(spark):
    both = changed(schema_version=2, event_timestamp="2026-13-45T18:00:00.000Z")
    value, _ = encoded(both)
    (_, reason), = _reasons(spark, [(value, "network.unknown")])
    assert reason == "Schema validation error: schema_version must be 1"


def test_rejects_keep_the_exact_bytes(spark):
    value = b'{"a":"\xff\xfe"}'
    row = ingest.rejected(raw(spark, (value, "network.state"))).first()
    assert bytes(row["raw_value"]) == value
    assert row["raw_payload"] == '{"a":"��"}'
    assert (row["_kafka_topic"], row["_kafka_offset"], row["_kafka_key"]) == (
        "network.state", 0, CONNECTIVITY["device_id"])


def test_typed_rows_have_the_stored_schema_and_values(spark):
    df = ingest.typed_events(raw(spark, encoded(CONNECTIVITY)), "connectivity_events")
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in event_schema("connectivity_events")]
    row = df.first()
    sent = datetime.strptime(CONNECTIVITY["event_timestamp"], "%Y-%m-%dT%H:%M:%S.%fZ")
    assert (row["event_timestamp"], row["_kafka_timestamp"]) == (sent, ARRIVED)
    assert {name: row[name] for name in CONNECTIVITY["payload"]} == CONNECTIVITY["payload"]


def test_every_record_is_accepted_or_rejected_once(spark, sf_dir):
    classified = ingest.classify(
        benchdata.raw_records(spark, sf_dir), benchdata.ACCESS_DIGITS).cache()
    total = classified.count()
    accepted = classified.where("target_table IS NOT NULL").count()
    rejected = classified.where("rejection_reason IS NOT NULL").count()
    assert total == accepted + rejected and rejected > 0


def test_json_is_parsed_once_per_record(spark):
    plan = ingest.typed_events(raw(spark, encoded(CONNECTIVITY)), "connectivity_events")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("VariantExpressionEvalUtils.parseJson") == 1


def test_routing(spark):
    topics = {
        "network/site-1/device-1/health": ("network.device_health", None),
        "network//device-1/health": (None, "topic has an empty level"),
        "network/site-1/device-1/firmware": (None, "topic matches no route"),
        "network/site-1/device-1": (None, "topic matches no route"),
        "network/site-1/Device-1/health": (None, "key level is not an identifier"),
        "network/site-1/device-1\n/health": (None, "key level is not an identifier"),
        "other/site-1/device-1/health": (None, "topic matches no route"),
    }
    messages = spark.createDataFrame(
        [(t, b"x") for t in topics], "device_topic string, payload binary")
    for row in ingest.route_messages(messages).collect():
        assert (row["kafka_topic"], row["routing_error"]) == topics[row["device_topic"]]


def test_skipped_offsets_ignore_first_starts(spark):
    schema = "topic string, partition int, offset bigint"
    committed = spark.createDataFrame([("a", 0, 10), ("a", 1, -1), ("b", 0, 50)], schema)
    earliest = spark.createDataFrame([("a", 0, 25), ("a", 1, 99), ("b", 0, 40)], schema)
    lost = {(r["topic"], r["partition"]): r["lost_records"]
            for r in ingest.skipped_offsets(committed, earliest).collect()}
    assert lost == {("a", 0): 15, ("b", 0): 0}


def test_table_names_are_known():
    assert len(ALL_TABLES) == 10


def test_ids_of_five_digits_are_accepted_when_the_contract_says_so(spark, sf_dir, tmp_path):
    """Bench events of user ids over 9,999: every delivery is accepted or rejected, and the
    event tables are what validation accepts."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.withColumn("user_id", F.col("user_id") + 12_000).write.parquet(
        str(tmp_path / "events.parquet"))
    for table in ("customer", "nation", "region"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(
            str(tmp_path / f"{table}.parquet"))
    benchdata.raw_records(spark, str(tmp_path)).write.parquet(str(tmp_path / "raw"))
    records = spark.read.parquet(str(tmp_path / "raw"))
    by_table = ingest.classify(records, benchdata.ACCESS_DIGITS).groupBy(
        "target_table").count().collect()
    found = {r["target_table"]: r["count"] for r in by_table}
    tables = benchdata.network_tables(spark, str(tmp_path))
    assert sum(found.values()) == records.count()
    for table in EVENT_TABLES:
        assert found[table] == tables.table(table).count()
    assert ingest.classify(records).where("target_table IS NOT NULL").count() < (
        sum(found.values()) - found[None])
