from datetime import timedelta

import pytest

from beaconlake.model import CURATED_TABLE, table_schema
from beaconlake.operators import maintenance
from beaconlake.operators.ingest import classify
from beaconlake.sources.lake import Lake
from beaconlake.sources.raw import file_records
from beaconlake.streaming import curate_stream

from .records import ARRIVED, CONNECTIVITY, encoded, raw

IDS = [f"00000000-0000-4000-8000-{i:012d}" for i in range(6)]


def rows(spark, *records):
    """(number of the event, seconds after the first arrival, offset)"""
    schema = table_schema(CURATED_TABLE)
    base = curate_stream.accepted_envelopes(classify(raw(spark, encoded(CONNECTIVITY)))).first().asDict()
    made = [{**base, "event_id": IDS[i], "_kafka_timestamp": ARRIVED + timedelta(seconds=s), "_kafka_offset": o}
            for i, s, o in records]
    return spark.createDataFrame([[r[c] for c in schema.names] for r in made], schema)


def held(lake):
    return sorted((IDS.index(r["event_id"]), r["_kafka_offset"]) for r in lake.read(CURATED_TABLE).collect())


def test_the_earliest_record_stays_whatever_the_order(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    curate_stream.merge(lake, rows(spark, (0, 5, 50), (0, 9, 90), (1, 5, 51)), "b-0")
    assert held(lake) == [(0, 50), (1, 51)]
    # A later copy changes nothing, an earlier one replaces, a new event is added.
    curate_stream.merge(lake, rows(spark, (0, 7, 70), (1, 2, 21), (2, 1, 10)), "b-1")
    assert held(lake) == [(0, 50), (1, 21), (2, 10)]
    before = lake.log(CURATED_TABLE).head().number
    assert curate_stream.merge(lake, rows(spark, (0, 5, 50), (2, 1, 10)), "b-1") == {
        "files_added": 0, "files_replaced": 0}
    assert lake.log(CURATED_TABLE).head().number == before
    curate_stream.merge(lake, rows(spark), "b-2")
    assert held(lake) == [(0, 50), (1, 21), (2, 10)]


def test_an_event_in_very_many_copies_is_one(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    copies = rows(spark, (3, 5, 500)).crossJoin(spark.range(20_000)).selectExpr(
        "* except (id, _kafka_offset)", "_kafka_offset + id as _kafka_offset").repartition(8)
    curate_stream.merge(lake, copies.select(*table_schema(CURATED_TABLE).names), "b-0")
    assert held(lake) == [(3, 500)]


def test_a_merge_that_was_overtaken_looks_again(spark, tmp_path, monkeypatch):
    lake, write, once = Lake(spark, str(tmp_path / "lake")), Lake.write_files, []
    curate_stream.merge(lake, rows(spark, (0, 5, 50)), "b-0")

    def overtaken(lake_, *args):
        files = write(lake_, *args)
        if not once:
            once.append(True)
            curate_stream.merge(lake, rows(spark, (1, 1, 11)), "other-0")
        return files

    monkeypatch.setattr(Lake, "write_files", overtaken)
    curate_stream.merge(lake, rows(spark, (1, 5, 51), (2, 5, 52)), "b-1")
    assert held(lake) == [(0, 50), (1, 11), (2, 52)]


def test_a_merge_that_dies_leaves_the_version_before(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    curate_stream.merge(lake, rows(spark, (0, 5, 50)), "b-0")
    with monkeypatch.context() as broken:
        broken.setattr("beaconlake.sources.storage.create_once", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            curate_stream.merge(lake, rows(spark, (0, 1, 1), (1, 5, 51)), "b-1")
    assert held(lake) == [(0, 50)]
    curate_stream.merge(lake, rows(spark, (0, 1, 1), (1, 5, 51)), "b-1")
    assert held(lake) == [(0, 1), (1, 51)]
    assert maintenance.compact(lake, CURATED_TABLE, kept_for=timedelta(0))["status"] == "ok"
    assert held(lake) == [(0, 1), (1, 51)]


def test_without_state_the_merge_drops_replays(spark, tmp_path):
    archive, held_as = str(tmp_path / "raw"), {}
    once = raw(spark, encoded(CONNECTIVITY)).coalesce(1)
    for _ in range(2):
        once.unionByName(once).coalesce(1).write.mode("append").parquet(archive)
    for name, given in {"state": {}, "none": {"state_for": None}}.items():
        lake, at = Lake(spark, str(tmp_path / name)), str(tmp_path / f"{name}-checkpoint")
        stream = curate_stream.start_curation(file_records(spark, archive, 1), lake, at, name, None, **given)
        stream.awaitTermination()
        held_as[name] = [r["_kafka_offset"] for r in lake.read(CURATED_TABLE).collect()]
        assert (tmp_path / f"{name}-checkpoint" / "state").exists() == (name == "state")
    assert held_as["none"] == held_as["state"] and len(held_as["none"]) == 1


def test_of_records_at_one_place_the_smallest_sequence_number_stays(spark):
    one = rows(spark, (0, 5, 50))
    for numbers in ((7, 5, 6), (5, 6, 7), (6, 7, 5)):
        copies = [one.selectExpr("* except (sequence_number)", f"{n}L as sequence_number") for n in numbers]
        met = copies[0].unionByName(copies[1]).unionByName(copies[2]).coalesce(1)
        assert [r["sequence_number"] for r in curate_stream.earliest(met).collect()] == [5]
