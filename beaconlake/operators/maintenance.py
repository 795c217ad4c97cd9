"""Small-file maintenance of the streamed tables: measure, decide, compact, verify.

Measures come from the table's log, which knows each file's size, rows and days: no data is read.
A compaction works through small files in chunks of days, one commit each, up to a budget; what is
left is planned anew by the next run, so a run that dies loses at most the chunk in its hands.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.lake import STREAMED_TABLES, Lake, day_source, day_sources
from ..sources.table_log import FILE_DDL, Conflict, Version

MB = 1024 * 1024
# Defaults of the maintenance job.
SMALL_FILE_MB, MIN_SMALL_FILES, MAX_REWRITE_MB = 32, 20, 2048
# What one commit rewrites. Opening a file counts as so many bytes, which bounds files as well.
CHUNK_MB = 512
OPENING_BYTES = 64 * 1024
# Replaced files stay this long: longer than any query that began before the compaction.
KEPT_FOR = timedelta(days=1)


def chosen_tables(names: Iterable[str]) -> list[str]:
    """The named tables in their fixed order; unknown names or none are refused."""
    names = set(names)
    unknown = sorted(names - set(STREAMED_TABLES))
    if unknown or not names:
        raise ValueError(f"unknown tables {unknown}; choose from {', '.join(STREAMED_TABLES)}"
                         if unknown else "no tables selected")
    return [t for t in STREAMED_TABLES if t in names]


def files(lake: Lake, table: str, version: Version | None = None) -> DataFrame:
    """One row per data file: path, size, rows, batch, days, clock bounds, layout."""
    version = version or lake.log(table).head()
    day, _ = day_source(table)
    found = version.files if version.number >= 0 else lake.spark.createDataFrame([], FILE_DDL)
    return found.withColumn(
        "layout", F.when(F.col(day).isNull(), "unpartitioned").otherwise("by day"))


def file_listing(lake: Lake, tables: Iterable[str] = STREAMED_TABLES) -> DataFrame:
    """Files, bytes, rows and clock bounds per table and day."""
    def of(table: str) -> DataFrame:
        day, _ = day_source(table)
        return files(lake, table).groupBy(F.lit(table).alias("table"), F.col(day).alias("day")).agg(
            F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows"),
            F.timestamp_micros(F.min("first_arrival")).alias("first_arrival"),
            F.timestamp_micros(F.max("last_arrival")).alias("last_arrival"))

    return reduce(DataFrame.unionByName, [of(t) for t in chosen_tables(tables)])


def file_stats(
    lake: Lake, tables: Iterable[str] = STREAMED_TABLES, small_file_bytes: int = SMALL_FILE_MB * MB
) -> DataFrame:
    """Files, small files and their bytes, records and layouts per table."""
    small = F.col("size") < small_file_bytes

    def of(table: str) -> DataFrame:
        return files(lake, table).agg(
            F.count(F.lit(1)).alias("data_files"),
            F.count_if(small).alias("small_files"),
            F.coalesce(F.sum(F.when(small, F.col("size"))), F.lit(0)).alias("small_bytes"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("records"),
            F.array_sort(F.collect_set("layout")).alias("layouts"),
        ).select(F.lit(table).alias("table"), "*")

    return reduce(DataFrame.unionByName, [of(t) for t in chosen_tables(tables)])


def maintenance_plan(
    stats: DataFrame, min_small_files: int = MIN_SMALL_FILES, max_rewrite_mb: int = MAX_REWRITE_MB
) -> DataFrame:
    """Compact where it is worth it (enough small files). A run rewrites `max_rewrite_mb` at most;
    `later_mb` says what is left to the runs after it."""
    small_mb = F.col("small_bytes") / F.lit(MB)
    few = F.col("small_files") < min_small_files
    later = F.when(few, 0.0).otherwise(F.greatest(small_mb - max_rewrite_mb, F.lit(0.0)))
    legacy = F.when(F.size("layouts") > 1, " Older files move to day partitions.").otherwise("")
    rest = F.when(later > 0, F.concat(
        F.lit(" "), F.format_number(later, 1),
        F.lit(f" MB are left to later runs (max_rewrite_mb={max_rewrite_mb})."))).otherwise("")
    count = F.col("small_files").cast("string")
    reason = F.when(few, F.concat(count, F.lit(
        f" small files, fewer than min_small_files={min_small_files}"))).otherwise(
        F.concat(count, F.lit(" small files, "), F.format_number(small_mb, 1), F.lit(" MB."),
                 rest, legacy))
    return stats.select(
        "table", F.when(few, "skip").otherwise("compact").alias("action"),
        reason.alias("reason"), later.alias("later_mb"), *[c for c in stats.columns if c != "table"])


def fingerprint(rows: DataFrame) -> tuple[int, int]:
    """Row count and the sum of row hashes: equal for equal rows in any order or files."""
    columns = sorted(c for c in rows.columns if c not in ("batch_id", "write_id", "event_day", "arrival_day"))
    total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    row = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(total, F.lit(0)).alias("hash"))
    found = row.first()
    return found["rows"], int(found["hash"])


def _settled(found: DataFrame) -> DataFrame:
    """Of the files found, those of batches that cannot be replayed any more: all but the
    newest of each run. The stream starts a batch only after the one before it is committed."""
    run = F.regexp_extract("batch_id", r"^(.*)-\d+$", 1)
    newest = found.where(run != "").groupBy(run.alias("run")).agg(
        F.max("batch_id").alias("batch_id"))
    return found.join(newest.select("batch_id"), "batch_id", "left_anti")


def chunks(found: DataFrame, days: list[str], small_file_bytes: int, chunk_bytes: int) -> DataFrame:
    """`chunk`, `path`, `size` and `rows` of the files worth rewriting: small ones whose day has another small
    one, dealt in the order of their days into chunks of about `chunk_bytes`. Sums of days are
    added up first, so only they meet in one task."""
    small = found.where(F.col("size") < small_file_bytes).withColumn("weight", F.col("size") + OPENING_BYTES)
    day = Window.partitionBy(*days)
    several = small.withColumn("together", F.count(F.lit(1)).over(day)).where("together > 1")
    inside = several.withColumn("inside", F.sum("weight").over(day.orderBy("path")) - F.col("weight"))
    sums = several.groupBy(*days).agg(F.sum("weight").alias("of_day"))
    # Equal days meet, also where an old file has none.
    before = sums.select(*[F.col(d).alias(f"{d}_") for d in days], (
        F.sum("of_day").over(Window.orderBy(*days)) - F.col("of_day")).alias("before"))
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"{d}_")) for d in days])
    place = F.floor((F.col("before") + F.col("inside")) / chunk_bytes)
    return inside.join(before, same).select(place.alias("chunk"), "path", "size", "rows")


def compact(
    lake: Lake, table: str, small_file_bytes: int = SMALL_FILE_MB * MB,
    kept_for: timedelta = KEPT_FOR, max_rewrite_mb: float = MAX_REWRITE_MB,
    chunk_mb: float = CHUNK_MB,
) -> dict[str, object]:
    """Rewrite the table's settled small files into full-size ones, chunk by chunk.

    The files are those of one version, so batches that arrive meanwhile are left as they are. A
    chunk's new files are written out of sight and verified, then replace the old ones in one commit
    of the log. Readers have a version before it or one after it. Chunks follow until they hold
    `max_rewrite_mb`; `chunks_left` and `mb_left` name the rest. When another compaction was faster with a
    chunk, that chunk is left to it. Larger files are not touched. Replaced files are deleted by a run
    that comes `kept_for` later.
    """
    ensure_checkpoint_dir(lake.spark)
    log, run = lake.log(table), uuid.uuid4().hex[:12]
    log.expire(kept_for.total_seconds())
    version = log.head()
    listed = chunks(_settled(files(lake, table, version)), list(day_sources(table)), small_file_bytes,
                    int(chunk_mb * MB)).checkpoint()
    sizes = listed.groupBy("chunk").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("files")).where(
        "files > 1").orderBy("chunk").collect()
    done = {"table": table, "status": "ok", "rows": 0, "files_replaced": 0, "chunks": 0}
    begun = 0
    for place, chunk in enumerate(sizes):
        if begun and begun + chunk["size"] > max_rewrite_mb * MB:
            left = sizes[place:]
            return {**done, "chunks_left": len(left), "mb_left": sum(c["size"] for c in left) / MB}
        begun += chunk["size"]
        paths = [r["path"] for r in listed.where(F.col("chunk") == chunk["chunk"]).select("path").collect()]
        old = lake.read_files(table, paths).drop("batch_id", "write_id", *day_sources(table))
        before = fingerprint(old)
        added = lake.write_files(table, old, f"compact_{run}_{place}")
        after = fingerprint(lake.read_files(table, [f["path"] for f in added]))
        if before != after:
            # The new files were never named; they expire.
            return {**done, "status": "failed", "detail": f"rows and hash {after} after, {before} before"}
        try:
            log.commit("compact", lambda base: (added, log.remove_only_if_live(paths, base)))
        except Conflict:
            continue
        done["rows"] += before[0]
        done["files_replaced"] += len(paths)
        done["chunks"] += 1
    log.expire(kept_for.total_seconds())
    return {**done, "chunks_left": 0, "mb_left": 0.0}


def side_by_side(spark: SparkSession, work: Callable[[str], object], tables: Sequence[str]) -> list:
    """What `work` returns for each table, all of them at once: it is many small jobs, which leave
    most cores free when they run in turn."""
    with ThreadPoolExecutor(max(1, len(tables))) as workers:
        return list(workers.map(inheritable_thread_target(spark)(work), tables))


def compact_planned(lake: Lake, plan: DataFrame, small_file_bytes: int) -> list[dict]:
    """Compact every table the plan names; one table's failure does not stop the others."""
    def compacted(table: str) -> dict:
        try:
            return compact(lake, table, small_file_bytes)
        except Exception as error:
            return {"table": table, "status": "failed", "detail": str(error)}

    planned = plan.where("action = 'compact'").select("table").collect()
    return side_by_side(lake.spark, compacted, [row["table"] for row in planned])


def maintenance_report(before: DataFrame, after: DataFrame, results: Iterable[dict] = ()) -> DataFrame:
    """Files and small files per table before and after, and what became of each table: `ok`,
    `failed` with its detail, or `skipped`."""
    spark = before.sparkSession
    told = spark.createDataFrame(
        [(r["table"], r["status"], r.get("detail"), r.get("mb_left", 0.0)) for r in results],
        "table string, status string, detail string, mb_left double")
    return before.select(
        "table", F.col("data_files").alias("files_before"),
        F.col("small_files").alias("small_before"), F.col("records").alias("records_before"),
    ).join(after.select(
        "table", F.col("data_files").alias("files_after"),
        F.col("small_files").alias("small_after"), F.col("records").alias("records_after"),
    ), "table", "full").join(told, "table", "left").withColumn(
        "status", F.coalesce("status", F.lit("skipped"))).orderBy("table")
