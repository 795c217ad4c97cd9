"""Report export to CSV: new folder per run and attempt, sidecar, verification."""

from __future__ import annotations

import hashlib
import inspect
import json
import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import report
from ..sources import storage

# The CSV contract (UTF-8, header, CRLF, quotes only where needed and
# doubled inside, NULL and empty text as an empty field, ISO timestamps in UTC).
READ_OPTIONS = {"header": "true", "encoding": "UTF-8", "quote": '"', "escape": '"'}
LINE_END = "\r\n"
NEEDS_QUOTES = '[",\r\n]'
ISO = {"timestamp": ("yyyy-MM-dd'T'HH:mm:ss", "xxx"), "timestamp_ntz": ("yyyy-MM-dd'T'HH:mm:ss", "")}
ROWS_PER_FILE = 1_000_000


def export_folder(out_root: str, name: str, run_id: str, attempt: int) -> str:
    """Own folder per run and attempt, so a rerun never meets an earlier export."""
    return f"{out_root}/{name}__{re.sub(r'[^A-Za-z0-9._-]', '_', run_id)}__try{attempt}"


def _texts(df: DataFrame) -> list[Column]:
    """The values as text: doubles as the shortest text that reads back as the same number,
    timestamps in ISO form with a fraction only where there is one, nested values as JSON."""
    columns = []
    for name, kind in df.dtypes:
        column = F.col("`" + name.replace("`", "``") + "`")
        if kind in ISO:
            seconds, zone = ISO[kind]
            column = F.when(
                F.date_format(column, "SSSSSS") == "000000", F.date_format(column, seconds + zone)
            ).otherwise(F.date_format(column, f"{seconds}.SSSSSS{zone}"))
        elif kind.startswith(("array", "map", "struct")):
            column = F.to_json(column)
        columns.append(column.cast("string"))
    return columns


def _field(text: Column) -> Column:
    doubled = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce(F.when(text.rlike(NEEDS_QUOTES), doubled).otherwise(text), F.lit(""))


def _line(texts: list[Column]) -> Column:
    """A record; one of a single empty field is quoted, as an empty line is no record."""
    line = F.concat_ws(",", *[_field(t) for t in texts])
    return F.when(line == "", F.lit('""')).otherwise(line) if len(texts) == 1 else line


def _header(names: list[str]) -> str:
    return ",".join(
        '"' + n.replace('"', '""') + '"' if re.search(NEEDS_QUOTES, n) else n for n in names)


def _lines(df: DataFrame) -> DataFrame:
    """The CSV lines. Spark's CSV writer changes line breaks inside values, so lines are written
    as text. A task starts a file at its first row and after each ROWS_PER_FILE; these rows have
    the header before them."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    header = F.lit(_header(df.columns) + LINE_END)
    line = _line(_texts(df))
    return df.select(
        F.when(row % ROWS_PER_FILE == 0, F.concat(header, line)).otherwise(line).alias("value"))


def file_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(file, bytes, sha256) of the CSV parts; parts are bounded by ROWS_PER_FILE."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"),
                F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    )


def export_rows(df: DataFrame, folder: str, details: dict | None = None) -> dict:
    """Write a result to a new folder and its sidecar next to it.

    An existing folder is refused. Parts get their names as CSV when the whole job has
    committed, so a failed export leaves no readable CSV; one without a sidecar is not whole.
    """
    if len(set(df.columns)) != len(df.columns):
        raise ValueError(f"duplicate column names: {df.columns}")
    spark = df.sparkSession
    started = datetime.now(timezone.utc).isoformat()
    counted = Observation()
    (
        _lines(df.observe(counted, F.count(F.lit(1)).alias("rows")))
        .write.mode("errorifexists").option("lineSep", LINE_END)
        .option("maxRecordsPerFile", ROWS_PER_FILE).text(folder)
    )
    # Spark writes a file for its first task also when that has no row, and no header then.
    sizes = storage.matching_sizes(spark, f"{folder}/part-*.txt")
    storage.delete_all(spark, [path for path, size in sizes if size == 0])
    written = [path for path, size in sizes if size > 0]
    storage.rename_all(spark, [(path, path.removesuffix("txt") + "csv") for path in written])
    if not written:
        storage.write_text(spark, f"{folder}/part-00000.csv", _header(df.columns) + LINE_END)
    parts = [r.asDict() for r in file_checksums(spark, folder).orderBy("file").collect()]
    metadata = {
        **(details or {}), "folder": folder, "columns": df.columns, "rows": counted.get["rows"],
        "bytes": sum(p["bytes"] for p in parts), "files": parts,
        "sha256": hashlib.sha256("".join(p["sha256"] for p in parts).encode()).hexdigest(),
        "started_at": started, "finished_at": datetime.now(timezone.utc).isoformat(),
    }
    storage.write_text(spark, f"{folder}.json", json.dumps(metadata, indent=2))
    return metadata


def export_report(
    name: str, tables, out_root: str, run_id: str, attempt: int = 1, **parameters
) -> dict:
    """Run one registered report and export it; unknown names are refused."""
    build = report(name)
    source = hashlib.sha256(inspect.getsource(build).encode()).hexdigest()
    details = {"report": name, "report_sha256": source, "run_id": run_id, "attempt": attempt}
    return export_rows(
        build(tables, **parameters), export_folder(out_root, name, run_id, attempt), details)


def read_export(spark: SparkSession, folder: str) -> DataFrame:
    """The exported rows as text columns."""
    return spark.read.options(**READ_OPTIONS, multiLine="true").csv(folder)


def verify_export(spark: SparkSession, metadata: dict) -> DataFrame:
    """Read the export again and compare checksums and row count with the sidecar's."""
    folder = metadata["folder"]
    stated = spark.createDataFrame(
        [(p["file"], p["sha256"]) for p in metadata["files"]], "file string, stated string")
    compared = file_checksums(spark, folder).join(stated, "file", "full")
    same = F.coalesce(F.bool_and(F.col("sha256").eqNullSafe(F.col("stated"))), F.lit(True))
    rows = read_export(spark, folder).agg(F.count(F.lit(1)).alias("rows_read")).scalar()
    return compared.agg(same.alias("sha256_matches")).select(
        "sha256_matches", (rows == F.lit(metadata["rows"])).alias("row_count_matches"),
        rows.alias("rows_read"))
