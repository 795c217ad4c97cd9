"""Session settings the library is meant to run with."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Adaptive execution splits skewed join partitions and sizes the reduce side at run time;
# shuffle.partitions is only its starting point. The broadcast limit is checked by
# Catalyst against the size of the side; beyond it the join sorts and shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.compression.codec": "zstd",
}


def local_session(name: str, cpus: int = 8) -> SparkSession:
    """A session for tests and the bench. On a cluster, pass SETTINGS to spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="beaconlake-warehouse-"))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _machine_local(spark: SparkSession, prefix: str) -> str:
    """A temporary folder of this machine, where one machine is all there is."""
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return tempfile.mkdtemp(prefix=prefix)


def work_folder(spark: SparkSession) -> str:
    """A new folder for intermediate tables: in the shared folder the cluster names in
    `spark.checkpoint.dir`, or machine-local where that is unset and the master is local (tests)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return f"{shared.rstrip('/')}/beaconlake-{uuid.uuid4().hex}"
    return _machine_local(spark, "beaconlake-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let `DataFrame.checkpoint()` work where the cluster has not set a folder (tests)."""
    context = spark.sparkContext
    if not context.getConf().get("spark.checkpoint.dir") and not context.getCheckpointDir():
        context.setCheckpointDir(_machine_local(spark, "beaconlake-checkpoint-"))
