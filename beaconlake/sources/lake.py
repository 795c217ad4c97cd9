"""Event tables on plain Parquet: a folder per write, day partitions inside, a log of the files.

    <root>/<table>/batch_id=<run>-<n>/write_id=<id>/event_day=<date>/arrival_day=<date>/*.parquet
    <root>/<table>/_log/                                        see table_log

Each write goes to a folder of its own, out of sight until the log names its files. Writing a batch
again (a retry, a replay after a crash) replaces the files that the log has for it, in one commit; a
compaction replaces small files by large ones in the same way. A reader takes the files of one
version of the log: no file is listed, joined or filtered away, and the version stays readable
until its files expire.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..model import (
    ALL_TABLES, CLOCK_DAYS, CURATED_TABLE, EVENT_TABLES, REJECT_TABLE, NetworkTables, table_schema,
)
from . import storage
from .table_log import TableLog, Version

# How stored files are written.
TARGET_FILE_BYTES = 128 * 1024 * 1024
COMPRESSION = "zstd"
STREAMED_TABLES = (*EVENT_TABLES, REJECT_TABLE)
# A safety limit; the rebalance before each write keeps files near the target size.
MAX_RECORDS_PER_FILE = 5_000_000
# The clocks whose bounds the log keeps of each file.
LOGGED_CLOCKS = {"event_timestamp": "event", "_kafka_timestamp": "arrival"}


def logged_path(file_path: str) -> Column:
    """The path of a file as the log has it, from Spark's `_metadata.file_path`. To be made once a
    file, not once a row."""
    path = F.url_decode(F.regexp_replace(file_path, r"\+", "%2B"))
    return F.regexp_replace(path, r"^.*?(batch_id=[^/]*/write_id=)", "$1")


def day_sources(table: str) -> dict[str, str]:
    """Partition columns of a table, outermost first, and the clocks they are the days of.
    Nearly all records arrive on the day they were measured, so the second day of events
    adds few folders."""
    days = {day: clock for clock, day in CLOCK_DAYS.items()}
    return {"arrival_day": days["arrival_day"]} if table == REJECT_TABLE else days


def day_source(table: str) -> tuple[str, str]:
    """Outermost partition column of a table and its clock."""
    return next(iter(day_sources(table).items()))


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        if table not in (*ALL_TABLES, CURATED_TABLE):
            raise ValueError(f"unknown table {table!r}; known: {', '.join(ALL_TABLES)}")
        return f"{self.root}/{table}"

    def log(self, table: str) -> TableLog:
        return TableLog(self.spark, self.path(table))

    def write_batch(self, table: str, rows: DataFrame, batch_id: str) -> None:
        """Put the rows in as this batch, in place of what it held before."""
        added = self.write_files(table, rows, batch_id)

        def replacing(base: Version):
            held = base.files.where(F.col("batch_id") == batch_id).select("path").collect() \
                if base.number >= 0 else []
            return added, [r["path"] for r in held]

        self.log(table).commit("batch", replacing)

    def write_files(self, table: str, rows: DataFrame, batch_id: str) -> list[dict]:
        """Write rows to a new folder that no version names yet; its files as the log has them.
        One pass over the two clocks counts the rows of each file and finds their bounds."""
        write_id = uuid.uuid4().hex
        folder = f"{self.path(table)}/batch_id={batch_id}/write_id={write_id}"
        write_by_day(rows, table, folder)
        days = list(day_sources(table))
        clocks = {c: name for c, name in LOGGED_CLOCKS.items() if c in table_schema(table).names}
        found = self._read(table, [folder]).groupBy(
            F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), *days
        ).agg(
            F.count(F.lit(1)).alias("rows"),
            *[F.unix_micros(f(F.col(c).cast("timestamp"))).alias(f"{side}_{name}")
              for c, name in clocks.items() for f, side in ((F.min, "first"), (F.max, "last"))]
        ).withColumn("path", logged_path("path"))
        return [{**r.asDict(), **{d: r[d] and r[d].isoformat() for d in days},
                 "batch_id": batch_id, "write_id": write_id} for r in found.collect()]

    def _read(self, table: str, paths: list[str]) -> DataFrame:
        schema = T.StructType([
            *table_schema(table).fields, T.StructField("batch_id", T.StringType()),
            T.StructField("write_id", T.StringType()),
            *[T.StructField(day, T.DateType()) for day in day_sources(table)],
        ])
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def read_files(self, table: str, paths: list[str]) -> DataFrame:
        """Rows of some files, named as in the log."""
        return self._read(table, [f"{self.path(table)}/{p}" for p in paths])

    def stored(self, table: str, version: Version | None = None) -> DataFrame:
        """All rows of the newest or the given version, with `batch_id` and day columns."""
        version = version or self.log(table).head()
        return self._read(table, version.paths() if version.number >= 0 else []).drop("write_id")

    def read(self, table: str, version: Version | None = None) -> DataFrame:
        """The table's columns and its day columns, for reports and checks."""
        return self.stored(table, version).drop("batch_id")

    def tables(self, **reference: DataFrame) -> NetworkTables:
        """Reports run on this: streamed tables from here, reference tables as given. Rows and
        bounds of a table are of one version, the newest when it was first asked for."""
        pinned: dict[str, Version] = {}

        def version(table: str) -> Version:
            return pinned.setdefault(table, self.log(table).head())

        def newest(table: str, clock: str) -> Column:
            micros = version(table).newest(f"last_{LOGGED_CLOCKS[clock]}") \
                if version(table).number >= 0 else None
            return F.timestamp_micros(F.lit(micros).cast("bigint"))

        return NetworkTables(
            lambda name: self.read(name, version(name)) if name in STREAMED_TABLES else reference[name],
            newest=newest)

    def create_views(self) -> None:
        """The streamed tables by name for SQL, each as of its newest version."""
        for table in STREAMED_TABLES:
            self.read(table).createOrReplaceTempView(table)

    def ready(self) -> None:
        """Make the streamed tables there, with a first version, before anything is written."""
        for table in STREAMED_TABLES:
            log = self.log(table)
            if log.head().number < 0:
                try:
                    storage.create_once(
                        self.spark, f"{log.folder}/{0:012d}.json", '{"action": "commit", "kind": "created", "at": 0}\n')
                except storage.AlreadyThere:
                    pass


def write_by_day(
    rows: DataFrame, table: str, path: str, days: dict[str, str] | None = None
) -> None:
    """Write rows as day partitions, those of `day_sources` if not told. REBALANCE splits a day that
    holds most rows over several tasks and merges small ones, by their size at run time."""
    days = days or day_sources(table)
    dated = rows.withColumns({day: F.to_date(clock) for day, clock in days.items()})
    (
        dated.hint("rebalance", *days).write.mode("overwrite").partitionBy(*days)
        .option("compression", COMPRESSION).option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .parquet(path)
    )
