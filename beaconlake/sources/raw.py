"""Sources of raw broker records: the broker itself, or files of the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..model import FAMILIES, RAW_RECORD_DDL


def kafka_records(
    spark: SparkSession, bootstrap_servers: str, max_records_per_batch: int = 5_000_000
) -> DataFrame:
    """The five topics from their oldest record; needs the Kafka connector on the class path.

    A record deleted before it was read fails the query (`failOnDataLoss`) instead of
    being skipped silently.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", ",".join(f.topic for f in FAMILIES))
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "true")
        .option("maxOffsetsPerTrigger", max_records_per_batch)
        .load().select("key", "value", "topic", "partition", "offset", "timestamp")
    )


def file_records(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files of raw records as a stream, e.g. a broker archive."""
    return (
        spark.readStream.schema(RAW_RECORD_DDL)
        .option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
