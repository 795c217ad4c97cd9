"""Catalog tables over stored files: created when absent, converged when they drifted.

Changes of several steps are written down before the first one (see `intents`), so a crash in
between leaves a table that the next call brings to the end of them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..model import table_schema
from . import intents
from .lake import COMPRESSION, day_source, write_by_day

# Table properties kept on every table.
TABLE_PROPERTIES = {
    "parquet.compression": COMPRESSION,
    "write.target-file-size-bytes": str(128 * 1024 * 1024),
}


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _literals(properties: dict[str, str]) -> str:
    return ", ".join(f"'{k}' = '{v}'" for k, v in sorted(properties.items()))


def _intent_path(location: str) -> str:
    folder, _, name = location.rstrip("/").rpartition("/")
    return f"{folder}/_intents/{name}.json"


def _columns(schema: list) -> str:
    return ", ".join(f"`{c}` {t}" for c, t in schema)


def _add_missing(spark: SparkSession, name: str, columns: list) -> list[str]:
    """Columns the table does not show yet; old files read NULL there."""
    existing = {c.lower() for c in spark.table(name).columns}
    missing = [(c, t) for c, t in columns if c.lower() not in existing]
    if missing:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(missing)})")
    return [c for c, _ in missing]


def _create(spark: SparkSession, name: str, columns: list, location: str, properties: dict,
            day: str | None) -> None:
    parts = f", `{day}` date) USING PARQUET PARTITIONED BY (`{day}`)" if day else ") USING PARQUET"
    spark.sql(f"CREATE TABLE {name} ({_columns(columns)}{parts} LOCATION '{location}' "
              f"TBLPROPERTIES ({_literals(properties)})")
    if day:
        spark.sql(f"MSCK REPAIR TABLE {name}")


def ensure_table(
    spark: SparkSession, database: str, table: str, location: str, partitioned: bool = True
) -> list[str]:
    """Create the table or bring it to its definition; returns what was done.

    Columns are only added, never dropped or retyped; old files stay readable and show NULL there.
    Stale properties are set. A table from before day partitioning is copied once into day
    partitions next to its files and switched over; running again does nothing. The switch drops one
    definition and makes the other: a session that dies in between leaves the change written down.
    """
    name, path = f"{database}.{table}", _intent_path(location)
    day, clock = day_source(table)
    columns = [(f.name, f.dataType.simpleString()) for f in table_schema(table).fields]
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def repartition(wanted: dict) -> None:
        target = wanted["location"]
        if not intents.complete(spark, target):
            rows = spark.table(name)
            kept = [c for c, _ in columns if c in rows.columns]
            write_by_day(rows.select(*kept), table, target, {day: clock})
        if spark.catalog.tableExists(name) and day not in spark.table(name).columns:
            spark.sql(f"DROP TABLE {name}")  # external: the old files stay
        if not spark.catalog.tableExists(name):
            _create(spark, name, columns, target, TABLE_PROPERTIES, day)
        else:
            spark.sql(f"MSCK REPAIR TABLE {name}")

    if intents.finish(spark, path, repartition):
        return ["partitioned by day"]
    if not spark.catalog.tableExists(name):
        _create(spark, name, columns, location, TABLE_PROPERTIES, day if partitioned else None)
        return ["created"]
    if partitioned and day not in spark.table(name).columns:
        intents.carry_out(spark, path, {"location": f"{location}-by-day"}, repartition)
        return ["partitioned by day"]
    actions: list[str] = []
    added = _add_missing(spark, name, columns)
    if added:
        actions.append(f"added {', '.join(added)}")
    current = _properties(spark, name)
    stale = {k: v for k, v in TABLE_PROPERTIES.items() if current.get(k) != v}
    if stale:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_literals(stale)})")
        actions.append(f"set {', '.join(sorted(stale))}")
    return actions


def _same_type(spark: SparkSession, name: str, columns: list) -> bool:
    shown = {c.lower(): t for c, t in spark.table(name).dtypes}
    return all(shown.get(c.lower(), t) == t for c, t in columns)


def _switch(spark: SparkSession, name: str):
    def steps(wanted: dict) -> None:
        columns, properties = wanted["columns"], wanted["properties"]
        if spark.catalog.tableExists(name) and not _same_type(spark, name, columns):
            spark.sql(f"DROP TABLE {name}")  # external: the files stay
        if not spark.catalog.tableExists(name):
            _create(spark, name, columns, wanted["location"], properties, None)
        else:
            # New columns first: until the location follows they read NULL.
            _add_missing(spark, name, columns)
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{wanted['location']}'")
            spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({_literals(properties)})")
        spark.catalog.refreshTable(name)
    return steps


def publish(
    spark: SparkSession, database: str, table: str, location: str, properties: dict[str, str]
) -> None:
    """Point a reference table at a complete new location, with its columns. Readers see the old
    rows or the new ones; columns that are new are shown, ones that are gone read NULL. Only a
    column of another type makes the definition anew."""
    name = f"{database}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    columns = [[f.name, f.dataType.simpleString()] for f in spark.read.parquet(location).schema.fields]
    intents.carry_out(spark, _intent_path(location.rpartition("/")[0]),
                      {"location": location, "columns": columns, "properties": properties},
                      _switch(spark, name))


def finish_publishing(spark: SparkSession, database: str, table: str, folder: str) -> bool:
    """End a publication that died between its steps; `folder` holds the table's locations."""
    return intents.finish(spark, _intent_path(folder), _switch(spark, f"{database}.{table}"))


def published_properties(spark: SparkSession, database: str, table: str) -> dict[str, str]:
    name = f"{database}.{table}"
    return _properties(spark, name) if spark.catalog.tableExists(name) else {}
