"""Reference tables from delivered CSV files: read, check against the manifest, publish.

A table's CSV is one file or a folder of part files. `binaryFile` holds a file in one
row, which suits inventories (parts of up to a few hundred MB), not event data.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import REFERENCE_DDL, schema_of
from ..operators import reference_rules
from ..session import ensure_checkpoint_dir
from . import catalog, intents, storage

# Where each table's file and manifest are, and how the manifest counts.
FILES = {
    "census_block_groups": ("census/v1", "census_block_groups.csv"),
    "sites": ("inventory/v1", "sites.csv"),
    "devices": ("inventory/v1", "devices.csv"),
    "device_dependencies": ("inventory/v1", "device_dependencies.csv"),
}
MANIFEST_COUNTS = {
    "census_block_groups": ("census/v1", "block_groups"),
    "sites": ("inventory/v1", "sites"),
    "devices": ("inventory/v1", "devices"),
    "device_dependencies": ("inventory/v1", "dependencies"),
    "access devices": ("inventory/v1", "access_devices"),
    "infrastructure devices": ("inventory/v1", "infrastructure_devices"),
    "service sites": ("inventory/v1", "service_sites"),
    "network sites": ("inventory/v1", "network_sites"),
}
# Raise when schemas or transformations change, so unchanged files are loaded again.
LOADER_VERSION = "1"
SHA_PROPERTY, VERSION_PROPERTY = "reference.source-sha256", "reference.loader-version"


@dataclass
class Bundle:
    """The delivered files of one root, lazily read."""

    spark: SparkSession
    root: str
    manifests: dict[str, dict] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return "/".join((self.root, *FILES[table]))

    def manifest(self, part: str) -> dict:
        if part not in self.manifests:
            self.manifests[part] = json.loads(
                storage.read_text(self.spark, f"{self.root}/{part}/manifest.json"))
        return self.manifests[part]

    def counts(self) -> DataFrame:
        """(label, expected) as the manifests state them."""
        return self.spark.createDataFrame(
            [(label, self.manifest(part).get("counts", {}).get(key))
             for label, (part, key) in MANIFEST_COUNTS.items()], "label string, expected bigint")

    def files(self, table: str) -> DataFrame:
        """Per delivered file: its name in the manifest, header line and SHA-256."""
        part, name = FILES[table]
        inside = F.substring_index("path", f"/{part}/", -1)
        line = F.substring_index(F.decode("content", "UTF-8"), "\n", 1)
        return (
            self.spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .load(self.path(table))
            .select(F.lit(table).alias("table"), inside.alias("file"),
                    F.rtrim(line, F.lit("\r")).alias("header"),
                    F.sha2("content", 256).alias("sha256"))
        )

    def all_files(self) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.files(t) for t in FILES])

    def stated_checksums(self) -> DataFrame:
        stated = [
            (table, file, output.get("sha256"))
            for table, (part, name) in FILES.items()
            for file, output in self.manifest(part).get("outputs", {}).items()
            if file == name or file.startswith(f"{name}/")
        ]
        return self.spark.createDataFrame(stated, "table string, file string, stated string")

    def read(self, table: str) -> DataFrame:
        """Rows with explicit types; a row that does not parse fails the job."""
        return (
            self.spark.read.schema(schema_of(REFERENCE_DDL[table]))
            .option("header", "true").option("mode", "FAILFAST").option("enforceSchema", "true")
            .csv(self.path(table))
        )

    def tables(self) -> dict[str, DataFrame]:
        return {t: self.read(t) for t in FILES}


def header_check(bundle: Bundle) -> DataFrame:
    """Files whose header is not the contract's column list."""
    expected = F.coalesce(*[
        F.when(F.col("table") == t, F.lit(",".join(schema_of(REFERENCE_DDL[t]).names)))
        for t in FILES])
    wrong = bundle.all_files().where(F.col("header") != expected)
    return wrong.select(F.lit("header").alias("rule"), F.col("table").alias("entity"),
                        F.col("header").alias("detail"))


def checksum_check(bundle: Bundle) -> DataFrame:
    """Files whose SHA-256 is not the manifest's, missing and unlisted files included."""
    compared = bundle.all_files().join(bundle.stated_checksums(), ["table", "file"], "full")
    wrong = compared.where(~F.col("sha256").eqNullSafe(F.col("stated")))
    return wrong.select(
        F.lit("checksum").alias("rule"), F.col("table").alias("entity"),
        F.concat_ws(" ", F.col("file"), F.coalesce("sha256", F.lit("missing")),
                    F.coalesce("stated", F.lit("unlisted"))).alias("detail"))


def parse_check(bundle: Bundle, tables: Iterable[str] = tuple(FILES)) -> DataFrame:
    """Tables with rows that do not parse under the explicit types, and how many."""
    ensure_checkpoint_dir(bundle.spark)
    parts = []
    for table in tables:
        schema = schema_of(REFERENCE_DDL[table]).add("_unparsed", "string")
        rows = (
            bundle.spark.read.schema(schema).option("header", "true")
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_unparsed")
            .csv(bundle.path(table))
        )
        # A scan parses only the columns asked for; the checkpoint asks for all of them.
        bad = rows.select("_unparsed", *schema.names[:-1]).checkpoint().agg(
            F.count_if(F.col("_unparsed").isNotNull()).alias("n"))
        parts.append(bad.where("n > 0").select(
            F.lit("unreadable rows").alias("rule"), F.lit(table).alias("entity"),
            F.col("n").cast("string").alias("detail")))
    return reduce(DataFrame.unionByName, parts)


def table_checksum(bundle: Bundle) -> dict[str, str]:
    """One checksum per table: its file's, or that of its part checksums in order."""
    row = F.when(F.count(F.lit(1)) == 1, F.max("sha256")).otherwise(F.sha2(F.concat_ws(
        "", F.sort_array(F.collect_list("sha256"))), 256))
    found = bundle.all_files().groupBy("table").agg(row.alias("sha256")).collect()
    return {r["table"]: r["sha256"] for r in found}  # four rows


def publish_reference(bundle: Bundle, database: str, warehouse: str) -> dict[str, str]:
    """Replace each table unless it already holds this very source; action per table. A location
    is written once: one that is complete, and may be live, is never written again."""
    spark, actions = bundle.spark, {}
    for table, sha in table_checksum(bundle).items():
        catalog.finish_publishing(spark, database, table, f"{warehouse}/{table}")
        held = catalog.published_properties(spark, database, table)
        if held.get(SHA_PROPERTY) == sha and held.get(VERSION_PROPERTY) == LOADER_VERSION:
            actions[table] = "unchanged"
            continue
        location = f"{warehouse}/{table}/{sha[:16]}-v{LOADER_VERSION}"
        rows = bundle.read(table).withColumns({
            "_source_file": F.lit("/".join(FILES[table])), "_source_sha256": F.lit(sha),
            "_loaded_at": F.current_timestamp(),
        })
        if not intents.complete(spark, location):
            rows.write.mode("overwrite").option("compression", "zstd").parquet(location)
        catalog.publish(spark, database, table, location,
                        {SHA_PROPERTY: sha, VERSION_PROPERTY: LOADER_VERSION})
        actions[table] = "loaded"
    return actions


def load_reference(
    spark: SparkSession, root: str, database: str, warehouse: str
) -> tuple[dict[str, str], DataFrame]:
    """Validate everything, then publish; on any violation nothing is written.

    Returns the action per table (empty when refused) and the violations found. Row
    rules are only looked at when every file parses.
    """
    bundle = Bundle(spark, root)
    ensure_checkpoint_dir(spark)
    found = header_check(bundle).unionByName(checksum_check(bundle)).unionByName(
        parse_check(bundle)).checkpoint()
    if found.where("rule IN ('header', 'unreadable rows')").isEmpty():
        rows = reference_rules.violations(bundle.tables(), bundle.counts())
        found = found.unionByName(rows).checkpoint()
    if not found.isEmpty():
        return {}, found
    return publish_reference(bundle, database, warehouse), found
