"""Exact deduplication with the heavy hitters taken out before the shuffle.

Texts are equal when they are the same after each run of space and 09-0D became one space. The
text is read once, into a table of ids and SHA-256 digests. Misra-Gries counters (`freqItems`, at
most 1 / SUPPORT of them per task) name every digest that may hold more than SUPPORT of all rows.
Their exact counts verify them; the winners, fewer than 1 / SUPPORT rows by definition, are
broadcast and their rows are settled where they are read. What remains has no group larger than
SUPPORT of the rows, so an ordinary shuffle by digest is even.

DataFrame functions only.

Cases: a null text is empty; empty texts are copies of each other. The smallest doc_id of a group
stays; a null doc_id comes last. If rows repeat the doc_id that stays, with the same text, exactly
one of them is kept. Other columns may have any name: only `doc_id` and `text` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

SUPPORT = 1 / 1024


def text_digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(spaced.cast("binary"), 256)


def _group(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.min("place").alias("first"),
                                      F.count(F.lit(1)).alias("group_size"))


def heavy_digests(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Digest, first place and size of each group with over `support` of all rows."""
    total = rows.count()
    candidates = rows.freqItems(["digest"], support).select(
        F.explode("digest_freqItems").alias("digest"))
    return _group(rows.join(F.broadcast(candidates), "digest", "left_semi")).where(
        F.col("group_size") > support * total)


def exact_duplicates(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: `doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256`."""
    rows = saved(docs.select(
        F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").cast("long").alias("id"),
                 F.monotonically_increasing_id().alias("row")).alias("place"),
        text_digest(F.col("text")).alias("digest")))
    heavy = saved(heavy_digests(rows, support))
    # At most 1 / support rows: see heavy_digests.
    settled = rows.join(F.broadcast(heavy), "digest")
    group = Window.partitionBy("digest")
    others = rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "digest", "place", F.min("place").over(group).alias("first"),
        F.count(F.lit(1)).over(group).alias("group_size"))
    return settled.unionByName(others).select(
        F.col("place.id").alias("doc_id"), F.col("first.id").alias("keep_id"), "group_size",
        (F.col("place") == F.col("first")).alias("kept"), F.col("digest").alias("text_sha256"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    digest, id_ = _free(docs, "digest"), _free(docs, "id")
    keep = exact_duplicates(docs.select("doc_id", "text")).where("kept").select(
        F.col("doc_id").alias(id_), F.col("text_sha256").alias(digest))
    # Null ids meet as equals; rows that repeat both id and text are one document.
    named = docs.withColumn(digest, text_digest(F.col("text"))).alias("d")
    met = named.join(keep.alias("k"), F.col(f"d.{digest}").eqNullSafe(F.col(f"k.{digest}"))
                     & F.col("d.doc_id").eqNullSafe(F.col(f"k.{id_}")), "left_semi")
    return met.dropDuplicates(["doc_id", digest]).drop(digest)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that docs does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


ORACLE_SQL = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
FROM n WINDOW g AS (PARTITION BY h)
"""
