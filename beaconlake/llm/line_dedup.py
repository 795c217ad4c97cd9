"""Lines that several documents hold stay in one of them only.

A text is split at line breaks. The key of a line is the line without spaces and 09-0D at both
ends, A-Z read as a-z; keys shorter than `least_chars` code points are left alone. Lines are
exploded with their place, their keys hashed to 128 bits of SHA-256, and distinct documents counted
per hash. A hash that at least `least_docs` documents hold loses its lines everywhere but in the
document with the smallest doc_id, where all of them stay. The places to drop are gathered per
document, and the text is put together again from the stretches of lines between them.

Only hashes meet in the counting. A key in over SUPPORT of all rows is one of fewer than
1 / SUPPORT keys by definition: those are broadcast, and their rows are settled where they are
read. The rest is shuffled by hash, where no group is larger than that share. Counting itself is in
two levels (by hash and document, then by hash) with sums added up before each shuffle.

DataFrame functions only.

Cases: a null or empty text is one empty line. A null doc_id is a document of its own, after all
others. Rows that repeat a doc_id are the same document to the counts, and each row gets a result
of its own; lines repeated inside one document only stay. An empty table gives an empty result.
Only `doc_id` and `text` are read, so other columns may have any name.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

LEAST_CHARS = 10
LEAST_DOCS = 2
SUPPORT = 1 / 1024
BLANKS = " \t\n\x0b\f\r"


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def _texts(docs: DataFrame) -> DataFrame:
    """`doc_id`, `text_hash` (tells rows apart that repeat an id with another text) and `lines`."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("text_hash"), F.split(text, "\n", -1).alias("lines"))


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """`doc_id`, `text_hash`, `place` from 0 and `hash` of each line with a long enough key."""
    lines = _texts(docs).select("doc_id", "text_hash", F.posexplode("lines").alias("place", "line"))
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= least_chars)
    digest = F.substring(F.unhex(F.sha2(F.col("key").cast("binary"), 256)), 1, 16)
    return keyed.select("doc_id", "text_hash", "place", digest.alias("hash"))


def repeated_hashes(lines: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """`hash`, `n_docs` and `first_id` of each hash that enough documents hold."""
    return lines.groupBy("hash").agg(
        (F.count_distinct("doc_id") + F.max(F.col("doc_id").isNull().cast("int"))).alias("n_docs"),
        F.min("doc_id").alias("first_id")).where(F.col("n_docs") >= least_docs)


def dropped_places(lines: DataFrame, least_docs: int = LEAST_DOCS,
                   support: float = SUPPORT) -> DataFrame:
    """`doc_id`, `text_hash` and the sorted `places` of the lines that it loses."""
    repeated = saved(repeated_hashes(lines, least_docs))
    # Fewer than 1 / support of them, as no row has two hashes.
    heavy = repeated.where(F.col("n_docs") > support * lines.count())
    settled = lines.join(F.broadcast(heavy), "hash")
    others = lines.join(F.broadcast(heavy.select("hash")), "hash", "left_anti").join(repeated, "hash")
    lost = settled.unionByName(others).where(~F.col("doc_id").eqNullSafe(F.col("first_id")))
    return lost.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set("place")).alias("places"))


def without_repeated_lines(docs: DataFrame, least_chars: int = LEAST_CHARS,
                           least_docs: int = LEAST_DOCS, support: float = SUPPORT) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_lines`, `n_dropped` and `kept_text`."""
    lines = saved(hashed_lines(docs, least_chars))
    lost = dropped_places(lines, least_docs, support).alias("lost")
    texts = _texts(docs).alias("t")
    met = texts.join(lost, F.col("t.doc_id").eqNullSafe(F.col("lost.doc_id"))
                     & (F.col("t.text_hash") == F.col("lost.text_hash")), "left")
    places = F.coalesce("places", F.array().cast("array<int>"))
    # The stretches between a place and the next one: each line is touched once.
    gaps = F.arrays_zip(F.concat(F.array(F.lit(-1)), places).alias("after"),
                        F.concat(places, F.array(F.size("lines"))).alias("before"))
    kept = F.flatten(F.transform(gaps, lambda gap: F.slice(
        "lines", gap["after"] + 2, gap["before"] - gap["after"] - 1)))
    return met.select(
        F.col("t.doc_id").alias("doc_id"), F.size("lines").cast("long").alias("n_lines"),
        F.size(places).cast("long").alias("n_dropped"), F.array_join(kept, "\n").alias("kept_text"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (
  SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (
  SELECT k.*, coalesce(k.doc_id <> g.first_id, false) AS lost
  FROM k LEFT JOIN g ON k.key = g.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), ''))
         AS kept_sha256
FROM m GROUP BY r
"""
