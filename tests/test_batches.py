"""What a batch of the ingestion stream costs: work for all cores, compiled code, one validation."""

import re

from beaconlake.sources import benchdata, storage
from beaconlake.sources import lake as lake_module
from beaconlake.sources.lake import Lake
from beaconlake.streaming.ingest_stream import route_batch
from crosscheck import lake_queries

from .records import CONNECTIVITY, encoded
from .records import raw as raw_rows


def test_the_archive_has_more_files_with_more_records(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(lake_queries, "RECORDS_PER_FILE", 50)
    path = lake_queries._raw_folder(spark, sf_dir, str(tmp_path))
    files = storage.matching(spark, f"{path}/*.parquet")
    records = benchdata.raw_records(spark, sf_dir).count()
    assert spark.read.parquet(path).count() == records
    assert len(files) >= 0.9 * benchdata.event_count(spark, sf_dir) / 50 > 6


def test_generated_methods_of_raw_records_are_small_enough_to_be_compiled(spark, sf_dir):
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = benchdata.raw_records(spark, sf_dir)._jdf.queryExecution()
        code = spark.sparkContext._jvm.PythonSQLUtils.explainString(plan, "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_a_batch_is_validated_before_its_tables_are_written(spark, tmp_path):
    held = []

    class Watching(Lake):
        def write_batch(self, table, rows, batch_id):
            infos = self.spark.sparkContext._jsc.sc().getRDDStorageInfo()
            held.append([(i.numCachedPartitions(), i.numPartitions()) for i in infos])
            super().write_batch(table, rows, batch_id)

    lake = Watching(spark, str(tmp_path / "lake"))
    batch = raw_rows(spark, encoded(CONNECTIVITY), (b"", "network.state"))
    route_batch(lake, batch, "run-0000000000")
    assert any(cached == all_ > 0 for cached, all_ in held[0])
    assert lake.read("connectivity_events").count() == 1
    rejects = lake.read("rejected_events").select("raw_value", "rejection_reason").collect()
    assert [bytes(r["raw_value"]) for r in rejects] == [b""]


def test_records_are_dealt_over_files_before_their_text_is_made(spark, sf_dir):
    dealt, whole = benchdata.raw_records(spark, sf_dir, 7), benchdata.raw_records(spark, sf_dir)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("named_struct(body") < plan.index("RepartitionByExpression")
    assert dealt.rdd.getNumPartitions() == 7
    assert dealt.exceptAll(whole).isEmpty() and whole.exceptAll(dealt).isEmpty()


def test_a_batch_is_held_as_three_columns(spark, tmp_path):
    plans = []

    class Watching(Lake):
        def write_batch(self, table, rows, batch_id):
            plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
            super().write_batch(table, rows, batch_id)

    lake = Watching(spark, str(tmp_path / "lake"))
    route_batch(lake, raw_rows(spark, encoded(CONNECTIVITY)), "run-0000000000")
    held = [re.search(r"InMemoryRelation \[(.*?)\]", plan).group(1).split(",") for plan in plans]
    assert {len(columns) for columns in held} == {3}
    assert lake.read("connectivity_events").count() == 1


def test_paths_are_made_once_a_file(spark, tmp_path, monkeypatch):
    lake, rows = Lake(spark, str(tmp_path / "a + b %41")), []
    made = lake_module.logged_path

    def watched(file_path):
        rows.append(file_path)
        return made(file_path)

    monkeypatch.setattr(lake_module, "logged_path", watched)
    batch = raw_rows(spark, *[encoded(CONNECTIVITY)] * 3)
    route_batch(lake, batch, "run-0000000000")
    assert set(rows) == {"path"}
    files = lake.log("connectivity_events").head().files.collect()
    assert sum(f["rows"] for f in files) == 3
    assert all((tmp_path / "a + b %41" / "connectivity_events" / f["path"]).exists() for f in files)


def test_a_version_is_compacted_once_while_the_stream_runs(spark, sf_dir, monkeypatch):
    versions = []

    def compacted(lake, table):
        versions.append(lake.log(table).head().number)

    monkeypatch.setattr(lake_queries.maintenance, "compact", compacted)
    rows = lake_queries.compact_during_ingest(spark, sf_dir)
    # The first version is empty, three batches follow, and once more it is compacted at the end.
    assert versions == sorted(versions) and len(versions) <= 5
    assert rows.count() > 0
