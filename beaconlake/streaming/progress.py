"""How far ingestion has come: the next offset of every topic partition, kept with the lake.

    <root>/_progress/<run>/<number>.json     one line per topic partition

A batch's file is made after its tables are written, and states the next offsets of all partitions
its run has ever read, so the newest file says all and older ones are deleted. A batch that is
written again replaces its file; offsets never go back. A file has as many lines as the broker has
partitions, whatever the number of records.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ingest import skipped_offsets
from ..sources import storage
from ..sources.lake import Lake

KEPT = 20
_COLUMNS = "topic string, partition int, offset bigint"


def _folder(lake: Lake, run: str) -> str:
    return f"{lake.root}/_progress/{run}"


def _offsets(lake: Lake, paths: list[str]) -> DataFrame:
    spark = lake.spark
    if not paths:
        return spark.createDataFrame([], _COLUMNS)
    return spark.read.schema(_COLUMNS).json(paths).groupBy("topic", "partition").agg(
        F.max("offset").alias("offset"))


def last_offsets(records: DataFrame) -> list[tuple[str, int, int]]:
    """The largest offset of each topic partition (`_kafka_topic`, `_kafka_partition`,
    `_kafka_offset`) among the records."""
    found = records.groupBy("_kafka_topic", "_kafka_partition").agg(F.max("_kafka_offset"))
    return [tuple(row) for row in found.collect()]


def record_progress(lake: Lake, records: DataFrame, batch_id: str) -> None:
    """Note the next offsets after this batch of records."""
    note_offsets(lake, last_offsets(records), batch_id)


def note_offsets(lake: Lake, offsets: list[tuple[str, int, int]], batch_id: str) -> None:
    """Note the next offsets after a batch that ends at these (topic, partition, offset). A batch
    without records says what the one before it said, and leaves no file while nothing was ever
    read."""
    run, _, number = batch_id.rpartition("-")
    folder = _folder(lake, run or "unnamed")
    path = f"{folder}/{number}.json"
    earlier = [p for p in storage.matching(lake.spark, f"{folder}/*.json")
               if p.rpartition("/")[2] < f"{number}.json"]
    # As many rows as partitions are read, so they are merged here rather than in another job.
    reached = {}
    if earlier:
        for line in storage.read_text(lake.spark, earlier[-1]).splitlines():
            row = json.loads(line)
            reached[row["topic"], row["partition"]] = row["offset"]
    for topic, partition, last in offsets:
        reached[topic, partition] = max(last + 1, reached.get((topic, partition), 0))
    lines = [json.dumps({"topic": t, "partition": p, "offset": reached[t, p]})
             for t, p in sorted(reached)]
    if storage.exists(lake.spark, path):
        storage.delete(lake.spark, path)
    if lines:
        storage.create_once(lake.spark, path, "".join(line + "\n" for line in lines))
    storage.delete_all(lake.spark, earlier[:-KEPT])


def committed_offsets(lake: Lake) -> DataFrame:
    """(topic, partition, offset): where reading goes on, over all runs into this lake."""
    newest: dict[str, str] = {}
    for path in storage.matching(lake.spark, f"{_folder(lake, '*')}/*.json"):
        newest[path.rpartition("/")[0]] = path
    return _offsets(lake, list(newest.values()))


def lost_records(lake: Lake, earliest: DataFrame) -> DataFrame:
    """Records of each partition that the broker dropped before they were read. `earliest` has the
    oldest offset it still holds (topic, partition, offset)."""
    return skipped_offsets(committed_offsets(lake), earliest)
