"""What several operators share: reading documents, cutting lineage, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, work_folder

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The rows as they are now, in the shared checkpoint folder: computed once, and read again
    from there if an executor is lost."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """The rows as they are now, as compressed Parquet in the shared folder; for rows that are too
    wide for `saved`, which does not compress."""
    folder = work_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def id_crc(column: str = "doc_id") -> Column:
    """crc32 of the id as text: deals documents into folds."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def components(edges: DataFrame) -> DataFrame:
    """(`node`, `component`) of every node of the edges (`a`, `b`): the smallest node that can be
    reached. Large-star and small-star steps alternate; each gives at most one edge per edge it
    gets, so a hub of any degree costs its degree. Rounds grow with the logarithm of the size."""
    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = saved(ordered.where("a > b").distinct())
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a > b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_least, "a")
        small = joined.select("a", F.col("m").alias("b")).union(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")))
        now = saved(small.where("a > b").distinct())
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b") % 1_000_003),
                           F.sum(F.xxhash64("b", "a") % 998_244_353)).first())


FILTER_BITS = 24


def id_filter(ids: DataFrame) -> np.ndarray:
    """A bit for each hash of the ids (`doc_id`), 2 MB at any size: what to skip early when a scan
    looks for few documents. It lets some others through, so a join by id must follow."""
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    found = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 32 as int))")).alias("bits")).toPandas()
    words = np.zeros(1 << (FILTER_BITS - 5), np.uint32)
    words[found.word.to_numpy(np.int64)] = found.bits.to_numpy(np.uint32)
    return words


def hash_slot() -> Column:
    """The slot of `doc_id` in an id_filter."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).cast("int").alias("slot")


def in_filter(words: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (words[slots >> 5] >> (slots & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
