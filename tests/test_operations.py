import csv
import io
import json
import os
import random
import re
import threading
from datetime import datetime, timedelta

import pytest

from beaconlake.operators import export, maintenance, quality
from beaconlake.sources import benchdata, storage
from beaconlake.sources.lake import STREAMED_TABLES, Lake
from beaconlake.streaming.ingest_stream import batch_name, route_batch

from .records import CONNECTIVITY, encoded, raw


def _lake(spark, path, batches=4):
    lake = Lake(spark, str(path))
    for n in range(batches):
        route_batch(lake, raw(spark, encoded({**CONNECTIVITY, "sequence_number": n + 1}),
                              encoded({**CONNECTIVITY, "sequence_number": n + 1})),
                    batch_name("run", n))
    return lake


def test_plan_is_justified_and_bounded(spark):
    mb = maintenance.MB
    rows = [("few", 5, 5, mb, mb, 10, ["by day"]), ("much", 100, 100, 5000 * mb, 5000 * mb, 10,
                                                    ["by day"]),
            ("fine", 100, 100, 10 * mb, 10 * mb, 10, ["by day", "unpartitioned"])]
    stats = spark.createDataFrame(
        rows, "table string, data_files int, small_files int, small_bytes bigint, "
        "total_bytes bigint, records bigint, layouts array<string>")
    plan = {r["table"]: (r["action"], r["reason"])
            for r in maintenance.maintenance_plan(stats).collect()}
    assert plan["few"][0] == "skip" and "min_small_files" in plan["few"][1]
    assert plan["much"][0] == "compact" and "2,952.0 MB are left to later runs" in plan["much"][1]
    assert plan["fine"][0] == "compact" and "day partitions" in plan["fine"][1]


def test_only_known_tables_are_maintained():
    for wrong in ([], ["sites"], ["rejected_events", "rejected_events;--"]):
        with pytest.raises(ValueError):
            maintenance.chosen_tables(wrong)
    shuffled = sorted(STREAMED_TABLES, reverse=True)
    assert maintenance.chosen_tables(shuffled + shuffled[:2]) == list(STREAMED_TABLES)


def test_compaction_keeps_rows_and_the_newest_batch(spark, tmp_path):
    lake = _lake(spark, tmp_path / "lake")
    before = maintenance.fingerprint(lake.read("connectivity_events"))
    result = maintenance.compact(lake, "connectivity_events")
    assert result["status"] == "ok" and result["files_replaced"] >= 3
    assert maintenance.fingerprint(lake.read("connectivity_events")) == before
    held = {r[0] for r in lake.stored("connectivity_events").select("batch_id").distinct()
            .collect()}
    assert batch_name("run", 3) in held and len(held) == 2
    # The newest batch can still be replayed without doubling.
    route_batch(lake, raw(spark, encoded({**CONNECTIVITY, "sequence_number": 4}),
                          encoded({**CONNECTIVITY, "sequence_number": 4})), batch_name("run", 3))
    numbers = [r[0] for r in lake.read("connectivity_events").select("sequence_number").collect()]
    assert sorted(numbers) == [1, 1, 2, 2, 3, 3, 4, 4]


def test_a_batch_that_arrives_during_compaction_stays(spark, tmp_path, monkeypatch):
    lake = _lake(spark, tmp_path / "lake")
    write, arrived = Lake.write_files, []

    def slow_write(lake_, table, rows, batch_id):
        files = write(lake_, table, rows, batch_id)
        if not arrived:
            arrived.append(True)
            for n in (4, 5):
                route_batch(lake, raw(spark, encoded({**CONNECTIVITY, "sequence_number": n + 1})),
                            batch_name("run", n))
        return files

    monkeypatch.setattr(Lake, "write_files", slow_write)
    result = maintenance.compact(lake, "connectivity_events")
    assert result["status"] == "ok" and result["files_replaced"] >= 3
    numbers = [r[0] for r in lake.read("connectivity_events").select("sequence_number").collect()]
    assert sorted(numbers) == [1, 1, 2, 2, 3, 3, 4, 4, 5, 6]


def test_readers_across_the_switch_see_every_row_of_one_version(spark, tmp_path):
    lake, table = _lake(spark, tmp_path / "lake"), "connectivity_events"
    version = lake.log(table).head()
    older = lake.read(table, version)
    maintenance.compact(lake, table)
    newer = lake.read(table)
    assert lake.log(table).head().number == version.number + 1
    assert older.count() == newer.count() == lake.read(table, version).count() == 8
    for df in (older, newer):
        plan = df.where("event_day > '2000-01-01'")._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan
    files = [set(maintenance.files(lake, table, v).select("path").toPandas().path)
             for v in (version, lake.log(table).head())]
    assert len(files[0] & files[1]) == 1 and len(files[1]) < len(files[0])


def test_compactions_follow_each_other_while_old_files_stay(spark, tmp_path):
    lake = _lake(spark, tmp_path / "lake")
    for n in (4, 5):
        assert maintenance.compact(lake, "connectivity_events")["status"] == "ok"
        route_batch(lake, raw(spark, encoded({**CONNECTIVITY, "sequence_number": n + 1})),
                    batch_name("run", n))
    stats = maintenance.file_stats(lake, ["connectivity_events"]).first()
    assert stats["records"] == lake.read("connectivity_events").count() == 10
    assert lake.log("connectivity_events").expire(0) >= 4
    assert lake.read("connectivity_events").count() == 10


def test_a_settled_table_is_not_rewritten_again(spark, tmp_path):
    lake = _lake(spark, tmp_path / "lake")
    assert maintenance.compact(lake, "connectivity_events")["chunks"] == 1
    again = maintenance.compact(lake, "connectivity_events")
    assert (again["chunks"], again["files_replaced"], again["chunks_left"]) == (0, 0, 0)


def test_clean_up_leaves_no_empty_folders(spark, tmp_path):
    lake = _lake(spark, tmp_path / "lake")
    maintenance.compact(lake, "connectivity_events", kept_for=timedelta(0))
    stored = tmp_path / "lake" / "connectivity_events"
    assert len(list(stored.glob("batch_id=run-*"))) == 1
    assert lake.read("connectivity_events").count() == 8
    assert lake.log("connectivity_events").expire(0) == 0


def test_a_large_table_is_worked_off_over_several_runs(spark, tmp_path):
    """More small bytes than a run may rewrite; a run that dies in between loses nothing."""
    lake, table = _lake(spark, tmp_path / "lake", batches=9), "connectivity_events"
    before = maintenance.fingerprint(lake.read(table))
    sizes = [r["size"] for r in maintenance.files(lake, table).collect()]
    budget = 3.5 * max(sizes) / maintenance.MB
    chunk = 3 * (max(sizes) + maintenance.OPENING_BYTES) / maintenance.MB
    left, runs = [], 0
    while not left or left[-1]:
        done = maintenance.compact(lake, table, max_rewrite_mb=budget, chunk_mb=chunk)
        assert done["status"] == "ok" and (done["mb_left"] > 0) == (done["chunks_left"] > 0)
        assert maintenance.fingerprint(lake.read(table)) == before
        left.append(done["chunks_left"])
        runs += 1
    assert runs > 1 and left == sorted(left, reverse=True)
    assert maintenance.files(lake, table).count() < len(sizes)


def test_a_compaction_that_dies_at_any_step_leaves_every_row(spark, tmp_path, monkeypatch):
    from beaconlake.sources.table_log import TableLog

    lake, table = _lake(spark, tmp_path / "lake"), "connectivity_events"
    before = maintenance.fingerprint(lake.read(table))

    def dies(*_, **__):
        raise OSError("executor and driver lost")

    for owner, step in ((Lake, "write_files"), (maintenance, "fingerprint"), (storage, "create_once"),
                        (TableLog, "remove_only_if_live")):
        with monkeypatch.context() as broken:
            broken.setattr(owner, step, dies)
            with pytest.raises(OSError):
                maintenance.compact(lake, table)
        assert maintenance.fingerprint(lake.read(table)) == before
    assert maintenance.compact(lake, table)["files_replaced"] >= 3
    with monkeypatch.context() as broken:
        broken.setattr(storage, "delete", dies)
        with pytest.raises(OSError):
            lake.log(table).expire(0)
    assert maintenance.fingerprint(lake.read(table)) == before
    assert lake.log(table).expire(0) >= 3
    stored = tmp_path / "lake" / table
    named = {r["path"] for r in maintenance.files(lake, table).collect()}
    assert {str(p.relative_to(stored)) for p in stored.glob("batch_id=*/**/*.parquet")} == named
    assert maintenance.fingerprint(lake.read(table)) == before


def test_of_two_compactions_of_the_same_files_one_lands(spark, tmp_path, monkeypatch):
    lake, table = _lake(spark, tmp_path / "lake"), "connectivity_events"
    write, other = Lake.write_files, []

    def slow_write(lake_, *args):
        files = write(lake_, *args)
        if not other:
            other.append(True)
            other.append(maintenance.compact(lake, table))
        return files

    monkeypatch.setattr(Lake, "write_files", slow_write)
    first = maintenance.compact(lake, table)
    assert first["files_replaced"] == 0 and other[1]["files_replaced"] >= 3
    assert lake.read(table).count() == 8


def test_statistics_equal_the_footers(spark, tmp_path):
    import duckdb

    lake = _lake(spark, tmp_path / "lake", batches=3)
    maintenance.compact(lake, "connectivity_events")
    for table in STREAMED_TABLES:
        listed = {str(tmp_path / "lake" / table / r["path"]): (r["rows"], r["size"])
                  for r in maintenance.files(lake, table).collect()}
        for path, (rows, size) in listed.items():
            footer = duckdb.sql(f"SELECT num_rows FROM parquet_file_metadata('{path}')").fetchall()[0]
            assert (rows, size) == (footer[0], os.path.getsize(path))
    listing = maintenance.file_listing(lake, ["connectivity_events"]).collect()
    assert sum(r["rows"] for r in listing) == lake.read("connectivity_events").count() == 6


def test_a_table_without_files_has_nothing_to_compact(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "nothing"))
    assert maintenance.compact(lake, "rejected_events")["files_replaced"] == 0
    assert maintenance.file_stats(lake, ["rejected_events"]).first()["data_files"] == 0


def test_doubles_survive_an_export(spark, tmp_path):
    values = [1.25e-14, 1e300, -0.0, 0.1, 123456789.123456789, 5e-324]
    metadata = export.export_rows(
        spark.createDataFrame([(v,) for v in values], "x double"), str(tmp_path / "doubles"))
    read = [float(r["x"]) for r in export.read_export(spark, metadata["folder"]).collect()]
    assert sorted(map(repr, read)) == sorted(map(repr, values))


def test_csv_reads_back_and_tampering_shows(spark, tmp_path):
    """Texts that need quoting, and every kind of value, next to Python's own CSV reader."""
    texts = ["plain", "a,b", 'quote " inside', " spaced ", "ünï"]
    moment = datetime(2024, 2, 29, 6, 7, 8)
    df = spark.createDataFrame(
        [(i, t, None, i % 2 == 0, moment + timedelta(days=i)) for i, t in enumerate(texts)],
        "n int, t string, missing string, even boolean, at timestamp").coalesce(1)
    metadata = export.export_rows(df, str(tmp_path / "out"))
    part, = (tmp_path / "out").glob("*.csv")
    with open(part, newline="", encoding="utf-8") as f:
        header, *rows = list(csv.reader(f))
    assert header == df.columns and metadata["rows"] == len(rows) == len(texts)
    for i, got in enumerate(rows):
        assert got[:4] == [str(i), texts[i], "", str(i % 2 == 0).lower()]
        assert datetime.fromisoformat(got[4]).replace(tzinfo=None) == moment + timedelta(days=i)
    assert part.read_bytes().endswith(b"\r\n")
    assert json.loads((tmp_path / "out.json").read_text())["sha256"] == metadata["sha256"]
    assert export.verify_export(spark, metadata).first().asDict() == {
        "sha256_matches": True, "row_count_matches": True, "rows_read": len(texts)}
    with pytest.raises(Exception, match="already exists"):
        export.export_rows(df, str(tmp_path / "out"))
    (part.parent / f".{part.name}.crc").unlink()  # the file system's own tamper check
    part.write_bytes(part.read_bytes() + b"9,extra,,true,\r\n")
    tampered = export.verify_export(spark, metadata).first()
    assert not tampered["sha256_matches"] and not tampered["row_count_matches"]


@pytest.mark.parametrize("value", ["two\nlines", "tail\r"])
def test_line_breaks_inside_a_value_survive_an_export(spark, tmp_path, value):
    df = spark.createDataFrame([(value,)], "t string")
    export.export_rows(df, str(tmp_path / "out"))
    part, = (tmp_path / "out").glob("*.csv")
    assert f'"{value}"'.encode() in part.read_bytes()
    assert [r["t"] for r in export.read_export(spark, str(tmp_path / "out")).collect()] == [value]


def test_exported_lines_equal_those_of_a_plain_writer(spark, tmp_path, monkeypatch):
    """Hostile texts over several files, each with a header, next to Python's own CSV writer."""
    monkeypatch.setattr(export, "ROWS_PER_FILE", 7)
    rng = random.Random(8)
    rows = [(i, rng.choice([None, "", "".join(rng.choices('ab,"\r\n é\\#', k=rng.randint(1, 9)))]),
             rng.choice([None, "x"])) for i in range(60)]
    names = ["n", 'odd, "name"', "last`one"]
    df = spark.createDataFrame(rows, "a int, b string, c string").repartition(3).toDF(*names)
    metadata = export.export_rows(df, str(tmp_path / "out"))
    parts = sorted((tmp_path / "out").glob("*.csv"))
    assert len(parts) == len(metadata["files"]) >= 60 // 7 and metadata["rows"] == 60
    got = []
    for part in parts:
        text = part.read_bytes().decode()
        head, *body = list(csv.reader(io.StringIO(text, newline="")))
        plain = io.StringIO(newline="")
        csv.writer(plain, lineterminator="\r\n").writerows([head, *body])
        assert head == names and text == plain.getvalue() and 0 < len(body) <= 7
        got += body
    assert sorted(got, key=lambda r: int(r[0])) == [[str(a), b or "", c or ""] for a, b, c in rows]
    assert export.verify_export(spark, metadata).first()["row_count_matches"]


def test_exports_of_nothing_and_of_one_empty_field(spark, tmp_path):
    none = export.export_rows(spark.range(0), str(tmp_path / "none"))
    assert none["rows"] == 0 and none["bytes"] == len("id\r\n") and len(none["files"]) == 1
    assert export.read_export(spark, none["folder"]).columns == ["id"]
    empty = export.export_rows(
        spark.createDataFrame([(None,), ("",), ("x",)], "t string").coalesce(1), str(tmp_path / "one"))
    part, = (tmp_path / "one").glob("*.csv")
    assert part.read_bytes() == b't\r\n""\r\n""\r\nx\r\n'
    assert export.verify_export(spark, empty).first()["row_count_matches"]


def test_exports_refuse_duplicate_columns_and_leave_nothing_on_failure(spark, tmp_path):
    with pytest.raises(ValueError, match="duplicate column"):
        export.export_rows(spark.sql("SELECT 1 AS a, 2 AS a"), str(tmp_path / "a"))
    with pytest.raises(Exception, match="boom"):
        export.export_rows(spark.sql("SELECT string(raise_error('boom')) AS a"), str(tmp_path / "b"))
    assert not list((tmp_path / "b").glob("*.csv")) and not (tmp_path / "b.json").exists()


def test_export_names_are_unique_per_run_and_attempt():
    runs = ["nightly 7:30", "nightly+7:31", "by-hand/1"]
    names = [export.export_folder("out", report, run, attempt)
             for report in ("late_records", "incident_impact") for run in runs
             for attempt in (1, 2)]
    assert len(set(names)) == len(names)
    assert all(re.fullmatch(r"out/[A-Za-z0-9_.-]+", n) for n in names)


def test_a_value_over_the_threshold_fires_with_its_severity(spark):
    values = spark.createDataFrame([
        ("reject_pct", 1.5, None), ("upstream_duplicate_pct", 1.0, None),
        ("devices_orphan_site", 1.0, None), ("minutes_since_last_arrival", None, None),
        ("silent_access_devices", None, "table not found")],
        "name string, value double, error string")
    status = {r["name"]: r["status"] for r in quality.evaluated(values).collect()}
    assert status == {"reject_pct": "warn", "upstream_duplicate_pct": "ok",
                      "devices_orphan_site": "fail", "minutes_since_last_arrival": "ok",
                      "silent_access_devices": "fail"}


def test_one_failing_probe_does_not_hide_the_others(spark, sf_dir):
    tables = benchdata.network_tables(spark, sf_dir)
    probes = quality.event_probes(tables)  # everything is far in the past: empty window
    bad = quality.Probe("event", ("reject_pct",), lambda: spark.table("no_such_table"))
    kept = [p for p in probes if "reject_pct" not in p.checks]
    found = quality.run(spark, [bad, *kept])
    status = {r["name"]: (r["status"], r["error"]) for r in found.collect()}
    assert status["reject_pct"][0] == "fail" and "no_such_table" in status["reject_pct"][1]
    assert status["minutes_since_last_arrival"] == ("ok", None)
    assert status["stalled_beyond_kafka_retention"][0] == "fail"
    total = quality.summary(found).first()
    assert total["missing_groups"] == "reference" and total["failed"]


def test_warnings_never_fail_a_run(spark):
    found = quality.evaluated(spark.createDataFrame(
        [("reject_pct", 50.0, None), ("devices_orphan_site", 0.0, None)],
        "name string, value double, error string"))
    total = quality.summary(found).first()
    assert (total["warn"], total["fail"], total["failed"]) == (1, 0, False)
    assert [r["name"] for r in quality.ordered_findings(found).collect()] == [
        "reject_pct", "devices_orphan_site"]
    assert len(quality.CHECKS) == 22


def test_tables_are_compacted_side_by_side(spark, tmp_path, monkeypatch):
    meet = threading.Barrier(2)

    def compacted(lake, table, small_file_bytes):
        meet.wait(20)
        if table == "state_events":
            raise ValueError("lost")
        return {"table": table, "status": "ok"}

    monkeypatch.setattr(maintenance, "compact", compacted)
    plan = spark.createDataFrame(
        [("connectivity_events", "compact"), ("state_events", "compact"), ("x", "skip")], "table string, action string")
    results = maintenance.compact_planned(Lake(spark, str(tmp_path)), plan, 1)
    assert {r["table"]: r["status"] for r in results} == {"connectivity_events": "ok", "state_events": "failed"}
