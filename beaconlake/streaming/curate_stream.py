"""The curated table: every accepted event once, however often it was delivered.

An event that is delivered again, as a replay of the same record or as a resend under another
offset, keeps its earliest record. The stream's state drops replays of a record within
`STATE_FOR`; everything else is merged into the table, whatever its age: files whose events have
an earlier record now are written anew without them, new events are added, in one commit. Merging
a batch again changes nothing, so a restart leaves one copy. The merge drops replays as well, so a
run over an archive does without state, which would hold all of its records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..contracts import ACCESS_DIGITS
from ..model import CURATED_TABLE, table_schema
from ..operators.ingest import classify
from ..session import ensure_checkpoint_dir
from ..sources.lake import Lake, logged_path
from ..sources.table_log import Conflict

RECORD = ("_kafka_timestamp", "_kafka_topic", "_kafka_partition", "_kafka_offset")
STATE_FOR = "2 hours"
ATTEMPTS = 20


def _record(prefix: str = "") -> Column:
    return F.struct(*[F.col(f"{prefix}{c}") for c in RECORD])


def accepted_envelopes(classified: DataFrame) -> DataFrame:
    """Sound records of all families, as the curated table stores them."""
    sources = {"table_name": F.col("target_table"), "_ingested_at": F.col("_processed_at")}
    return classified.where(F.col("target_table").isNotNull()).select(
        *[sources.get(c, F.col(c)).alias(c) for c in table_schema(CURATED_TABLE).names])


def earliest(rows: DataFrame) -> DataFrame:
    """One row per event, its earliest record; of records at one place, which a broker does not have,
    that with the smallest sequence number. Copies are reduced before they are shuffled."""
    columns = [c for c in table_schema(CURATED_TABLE).names]
    return rows.groupBy("event_id").agg(F.min_by(
        F.struct(*columns), F.struct(_record(), "sequence_number")).alias("row")).select("row.*")


def merge(lake: Lake, rows: DataFrame, batch_id: str) -> dict[str, int]:
    """Bring a batch into the curated table; returns what changed.

    Copies of an event carry the same measurement time, so only files of the batch's days are
    looked at, and of those only ids and coordinates. When another commit comes first, the batch is
    compared with the table anew.
    """
    ensure_checkpoint_dir(lake.spark)
    new = earliest(rows).checkpoint()
    days = [r["day"] for r in new.select(F.to_date("event_timestamp").alias("day")).distinct().collect()]
    log = lake.log(CURATED_TABLE)
    for _ in range(ATTEMPTS):
        base = log.head()
        there = base.files.where(F.col("event_day").isin(days)) if base.number >= 0 and days else None
        paths = [r["path"] for r in there.select("path").collect()] if there is not None else []
        held = lake.read_files(CURATED_TABLE, paths)
        held = held.select("event_id", _record().alias("held"), F.col("_metadata.file_path").alias("path")) if paths \
            else held.select("event_id", _record().alias("held"), F.lit("").alias("path"))
        met = new.select("event_id", _record().alias("new")).join(held, "event_id").checkpoint()
        older = met.where("new >= held").select("event_id")
        replaced = met.where("new < held").select("event_id", "path")
        touched = [r["path"] for r in replaced.select("path").distinct().select(
            logged_path("path").alias("path")).collect()]
        kept = lake.read_files(CURATED_TABLE, touched).select(*new.columns).join(
            replaced.select("event_id"), "event_id", "left_anti")
        put = kept.unionByName(new.join(older, "event_id", "left_anti"))
        added = lake.write_files(CURATED_TABLE, put, batch_id)
        changed = {"files_added": len(added), "files_replaced": len(touched)}
        if not added and not touched:
            return changed

        def unchanged(head):
            if head.number != base.number:
                raise Conflict(f"version {head.number} came first")
            return added, touched

        try:
            log.commit("merge", unchanged)
        except Conflict:
            continue
        return changed
    raise RuntimeError(f"{batch_id}: {ATTEMPTS} other commits came first")


def start_curation(
    records: DataFrame, lake: Lake, checkpoint: str, run: str = "curate",
    every: str | None = "1 minute", access_digits: str = ACCESS_DIGITS, merge_batch=merge,
    state_for: str | None = STATE_FOR,
) -> StreamingQuery:
    """Keep the curated table up to date with the records; `every=None` works off what is there.

    State is kept by the time of processing, on which no record is late: late measurements and old
    records pass on to the merge. Of an archive worked off within `state_for` the state would hold all
    records; `state_for=None` keeps none and leaves replays to the merge too. A checkpoint goes on as it
    began, with state or without.
    """
    once = accepted_envelopes(classify(records, access_digits))
    if state_for:
        once = once.withColumn("_seen", F.current_timestamp()).withWatermark(
            "_seen", state_for).dropDuplicatesWithinWatermark(["event_id", *RECORD]).drop("_seen")

    def write(batch: DataFrame, number: int) -> None:
        merge_batch(lake, batch, f"{run}-{number:010d}")

    writer = once.writeStream.queryName(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.foreachBatch(write).start()
