"""The ingestion stream: validate a micro-batch once, append it to six tables."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import ACCESS_DIGITS
from ..model import REJECT_TABLE
from ..operators.ingest import accepted_rows, classify, rejected_rows
from ..sources.lake import STREAMED_TABLES, Lake
from .progress import last_offsets, note_offsets


def route_batch(
    lake: Lake, raw: DataFrame, batch_id: str, access_digits: str = ACCESS_DIGITS
) -> None:
    """Write one batch of raw records to the five event tables and the reject table.

    The batch's files of all six tables are replaced, also with nothing, so a batch written
    half and retried leaves one copy even when a record now goes to another table.
    """
    # Only rejects keep their bytes; those of sound records would be most of what is held. The
    # rest is held as one value: most columns are empty in most rows, and a holder for each of them
    # took a quarter of the time.
    classified = classify(raw, access_digits).withColumn(
        "raw_value", F.when(F.col("rejection_reason").isNotNull(), F.col("raw_value")))
    outer = ["target_table", "rejection_reason"]
    held = classified.select(
        *outer, F.struct(*[c for c in classified.columns if c not in outer]).alias("_record"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    classified = held.select(*outer, "_record.*")

    @inheritable_thread_target(raw.sparkSession)
    def write(table: str) -> None:
        rows = rejected_rows(classified) if table == REJECT_TABLE \
            else accepted_rows(classified, table)
        lake.write_batch(table, rows, batch_id)

    # Six small jobs at once instead of in turn; any failure fails the batch. The records are
    # validated before, by the job that looks for their offsets: side by side, the jobs would wait
    # for each other's blocks, or validate them again on another executor.
    try:
        offsets = last_offsets(classified)
        with ThreadPoolExecutor(len(STREAMED_TABLES)) as writers:
            for written in [writers.submit(write, t) for t in STREAMED_TABLES]:
                written.result()
        note_offsets(lake, offsets, batch_id)
    finally:
        held.unpersist()


def batch_name(run: str, number: int) -> str:
    """Ids sort like their numbers; another checkpoint must use another run name."""
    return f"{run}-{number:010d}"


def start_ingest(
    records: DataFrame, lake: Lake, checkpoint: str, run: str = "ingest",
    every: str | None = "5 seconds",
    route: Callable[[Lake, DataFrame, str], None] = route_batch,
) -> StreamingQuery:
    """Run the stream; `every=None` works off what is there and ends.

    Progress is recorded in the checkpoint after the batch is written. A crash in between
    repeats the same records under the same batch id, which replaces what was written.
    """
    lake.ready()

    def write(batch: DataFrame, number: int) -> None:
        route(lake, batch, batch_name(run, number))

    writer = records.writeStream.queryName(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None \
        else writer.trigger(processingTime=every)
    return writer.foreachBatch(write).start()
