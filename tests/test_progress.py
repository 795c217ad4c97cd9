import pytest

from beaconlake.sources.lake import Lake
from beaconlake.streaming import progress

COLUMNS = "_kafka_topic string, _kafka_partition int, _kafka_offset bigint"


def _reached(lake):
    return {(r["topic"], r["partition"]): r["offset"] for r in progress.committed_offsets(lake).collect()}


@pytest.fixture
def note(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))

    def noted(batch_id, *rows):
        progress.record_progress(lake, spark.createDataFrame(rows, COLUMNS), batch_id)
        return _reached(lake)
    return lake, noted


def test_offsets_of_quiet_partitions_stay(note):
    lake, noted = note
    assert _reached(lake) == noted("run-0000000000") == {}
    assert noted("run-0000000000", ("a", 0, 4), ("a", 0, 5), ("a", 1, 9)) == {("a", 0): 6, ("a", 1): 10}
    assert noted("run-0000000001", ("a", 0, 7)) == {("a", 0): 8, ("a", 1): 10}
    assert noted("run-0000000002") == {("a", 0): 8, ("a", 1): 10}


def test_a_batch_written_again_and_other_runs(note):
    lake, noted = note
    noted("run-0000000000", ("a", 0, 4))
    noted("run-0000000001", ("a", 0, 9))
    assert noted("run-0000000001", ("a", 0, 8)) == {("a", 0): 9}
    assert noted("other-run-0000000000", ("a", 0, 2), ("b", 0, 1)) == {("a", 0): 9, ("b", 0): 2}


def test_old_files_go(note, monkeypatch, tmp_path):
    monkeypatch.setattr(progress, "KEPT", 2)
    lake, noted = note
    for n in range(5):
        noted(f"run-{n:010d}", ("a", 0, n))
    assert len(list((tmp_path / "lake" / "_progress" / "run").glob("*.json"))) == 3
    assert _reached(lake) == {("a", 0): 5}


def test_what_the_broker_dropped_is_counted(note, spark):
    lake, noted = note
    noted("run-0000000000", ("a", 0, 4), ("a", 1, 9))
    earliest = spark.createDataFrame([("a", 0, 8), ("a", 1, 3)], "topic string, partition int, offset bigint")
    assert {(r["partition"], r["lost_records"]) for r in progress.lost_records(lake, earliest).collect()} \
        == {(0, 3), (1, 0)}
