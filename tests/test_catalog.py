"""Catalog changes that die at every step and are finished by the next call."""

import uuid

import pytest
from pyspark.sql import functions as F

from beaconlake.model import table_schema
from beaconlake.sources import catalog, intents, storage

from .records import ARRIVED

TABLE = "throughput_events"


@pytest.fixture
def database(spark, tmp_path):
    name = f"catalog_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/database'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def stopping(spark, monkeypatch, stop_at):
    """Let the stop_at-th changing step fail, before (even) or after (odd) it took effect."""
    count, sql, session = [0], spark.sql, type(spark)

    def step(run, *args):
        count[0] += 1
        if count[0] == stop_at // 2 + 1 and stop_at % 2 == 0:
            raise OSError("lost")
        out = run(*args)
        if count[0] == stop_at // 2 + 1:
            raise OSError("lost")
        return out

    def counted(self, text, *args, **kwargs):
        if text.startswith(("ALTER", "DROP TABLE", "CREATE TABLE", "MSCK")):
            return step(lambda: sql(text))
        return sql(text, *args, **kwargs)

    monkeypatch.setattr(session, "sql", counted)
    write, create, delete = catalog.write_by_day, storage.create_once, storage.delete
    monkeypatch.setattr(catalog, "write_by_day", lambda *a: step(write, *a))
    monkeypatch.setattr(storage, "create_once", lambda *a: step(create, *a))
    monkeypatch.setattr(storage, "delete", lambda *a: step(delete, *a))
    return count


def old_table(spark, database, folder):
    rows = spark.range(5).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) if f.name not in ("event_timestamp", "sequence_number")
          else F.lit(ARRIVED).alias(f.name) if f.name == "event_timestamp" else F.col("id").alias(f.name)
          for f in table_schema(TABLE).fields])
    rows.drop("_kafka_key", "_ingested_at").write.parquet(folder)
    spark.sql(f"CREATE TABLE {database}.{TABLE} USING PARQUET LOCATION '{folder}'")


@pytest.mark.parametrize("stop_at", range(0, 12))
def test_a_table_converges_after_a_crash_at_any_step(spark, database, tmp_path, monkeypatch, stop_at):
    folder = str(tmp_path / TABLE)
    old_table(spark, database, folder)
    with monkeypatch.context() as broken:
        count = stopping(spark, broken, stop_at)
        try:
            catalog.ensure_table(spark, database, TABLE, folder)
        except OSError:
            pass
        else:
            assert count[0] <= stop_at // 2
    for _ in range(3):
        catalog.ensure_table(spark, database, TABLE, folder)
    found = spark.table(f"{database}.{TABLE}")
    assert {"event_day", "_kafka_key"} <= set(found.columns)
    assert sorted(r["sequence_number"] for r in found.collect()) == list(range(5))
    assert catalog.ensure_table(spark, database, TABLE, folder) == []
    assert not storage.exists(spark, catalog._intent_path(folder))


@pytest.mark.parametrize("stop_at", range(0, 10))
@pytest.mark.parametrize("kind", ["string", "int"])
def test_publishing_with_a_new_column_after_a_crash_at_any_step(
        spark, database, tmp_path, monkeypatch, stop_at, kind):
    """The second bundle has one column more, and (for int) another type for an old one."""
    root = str(tmp_path / "sites")
    spark.range(3).selectExpr("id as n", "cast(id as string) as code").write.parquet(f"{root}/a")
    catalog.publish(spark, database, "sites", f"{root}/a", {"sha": "a"})
    spark.range(4).selectExpr("id as n", f"cast(id as {kind}) as code", "'x' as region").write.parquet(f"{root}/b")
    with monkeypatch.context() as broken:
        stopping(spark, broken, stop_at)
        try:
            catalog.publish(spark, database, "sites", f"{root}/b", {"sha": "b"})
        except OSError:
            pass
    catalog.finish_publishing(spark, database, "sites", root)
    if catalog.published_properties(spark, database, "sites").get("sha") != "b":
        catalog.publish(spark, database, "sites", f"{root}/b", {"sha": "b"})
    found = spark.table(f"{database}.sites")
    assert sorted(found.columns) == ["code", "n", "region"] and dict(found.dtypes)["code"] == kind
    assert found.where("region = 'x'").count() == 4
    assert not storage.exists(spark, catalog._intent_path(root))


def test_a_change_that_is_written_down_comes_first(spark, tmp_path):
    path, taken = str(tmp_path / "i.json"), []
    storage.create_once(spark, path, '{"n": 1}')
    intents.carry_out(spark, path, {"n": 2}, lambda wanted: taken.append(wanted["n"]))
    assert taken == [1, 2] and not intents.finish(spark, path, taken.append)
