"""Changes of a catalog table in several steps, finished after a crash at any of them.

A catalog has no transaction over copying files, replacing a definition, setting a location and
properties. So what is wanted is written down first, in one small file next to the table's data; then
the steps follow, each of which may be repeated; then the file goes. Whoever touches the table next
finishes what is written down before anything else.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from . import storage


def carry_out(spark: SparkSession, path: str, wanted: dict, steps: Callable[[dict], None]) -> None:
    """Finish what `path` holds, then do the same for `wanted`."""
    finish(spark, path, steps)
    try:
        storage.create_once(spark, path, json.dumps(wanted))
    except storage.AlreadyThere as error:
        raise RuntimeError(f"another session changes this table: {path}") from error
    finish(spark, path, steps)


def finish(spark: SparkSession, path: str, steps: Callable[[dict], None]) -> bool:
    """Take the steps of a change that was written down; False if there is none."""
    if not storage.exists(spark, path):
        return False
    steps(json.loads(storage.read_text(spark, path)))
    storage.delete(spark, path)
    return True


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder ended: Spark's marker comes last."""
    return storage.exists(spark, f"{folder}/_SUCCESS")
