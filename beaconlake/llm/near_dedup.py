"""MinHash near-duplicate detection by one-permutation hashing.

Documents are sets of five-word shingles. One hash per shingle fills all BINS minima: the hash
space is cut into BINS ranges and each keeps its smallest hash; an empty bin borrows from the
first filled bin in an order of its own (optimal densification). ROWS bins make a band, equal
bands make a bucket. Within a bucket documents are compared with hubs only (stars), so candidates
are bounded by buckets times hubs, never all pairs.

Nothing is dropped by that: where a bucket's documents are not in one component after the star
round, those apart from its hub meet the whole bucket in blocks, inside tasks, and the pairs whose
signatures agree in LIKELY of the bins come out. Every candidate link is confirmed on the full
shingle sets. What can be missed is a pair that shares no band at all, (1 - 0.75**5)**64 = 3e-8 at
the threshold, or whose signatures are off by five deviations; both are less above it.

Cases: a null or empty text, or one without words, has no shingles and is its own component; one
to four words are one shingle. Equal sets are one node of the graph. Rows that repeat a doc_id
are one node as well. A row without doc_id is linked with nothing, has no component and is kept.
Only `doc_id` and `text` are read; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import components, hash_slot, id_filter, in_filter, saved, written

SHINGLE_WORDS = 5
PERCENT = 75
BANDS, ROWS = 64, 5
BINS = BANDS * ROWS
BLOCK = 256
# Left blocks of a bucket that one task compares with the whole bucket.
TOGETHER = 8
# Of 320 bins 240 agree on average at the threshold, with a deviation below 7.8.
LIKELY = 0.62


class Shingler:
    """Sorted distinct 64-bit shingle hashes of each document of a batch."""

    def __init__(self):
        self.hasher = tb.Hasher(5, lower=True)

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        for chunk in tb.chunks(texts):
            words = tb.words(chunk)
            h = self.hasher.ranges(chunk.buf, words.start, words.end)
            shingles = tb.window_hashes(h, SHINGLE_WORDS)
            for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
                if b - a >= SHINGLE_WORDS:
                    yield np.unique(shingles[a: b - SHINGLE_WORDS + 1])
                elif b > a:
                    yield tb.combine(tb.window_hashes(h[a:b], b - a),
                                     np.array([b - a], np.uint64))
                else:
                    yield np.zeros(0, np.uint64)


def preferences() -> np.ndarray:
    """For each bin the rank of every other bin as a lender; the diagonal is never asked."""
    return tb.spread(BINS * BINS, 9).reshape(BINS, BINS)


def signature(shingles: np.ndarray, order: np.ndarray) -> np.ndarray:
    """BINS minima of a non-empty sorted set."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    lead = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = bins[lead]
    minima = np.zeros(BINS, np.uint64)
    minima[filled] = shingles[lead]
    if len(filled) < BINS:
        empty = np.ones(BINS, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        minima[empty] = minima[filled[order[np.ix_(empty, filled)].argmin(axis=1)]]
    return minima


def band_keys(minima: np.ndarray) -> np.ndarray:
    """One bucket key per band; the band's number is part of it."""
    rows = minima.reshape(-1, BANDS, ROWS)
    key = np.broadcast_to(tb.spread(BANDS, 3), rows.shape[:2]).copy()
    for r in range(ROWS):
        key = tb.combine(key, rows[:, :, r])
    return key


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler, order = Shingler(), preferences()
    for batch in batches:
        count, high, low, keys, lengths, minima = [], [], [], [], [], []
        for s in shingler.sets(batch.column("text")):
            count.append(len(s))
            digest = tb.combine(s, tb.spread(1, len(s))).sum(dtype=np.uint64), np.bitwise_xor.reduce(
                tb.mix(s ^ np.uint64(len(s) * 2 + 1))) if len(s) else np.uint64(0)
            high.append(digest[0])
            low.append(digest[1])
            lengths.append(BANDS if len(s) else 0)
            if len(s):
                keys.append(signature(s, order))
            minima.append((keys[-1] & np.uint64(255)).astype(np.uint8).tobytes() if len(s) else b"")
        flat = band_keys(np.array(keys, np.uint64)).reshape(-1) if keys else np.zeros(0, np.uint64)
        places = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(count, pa.int64()),
            pa.array(np.array(high, np.uint64).view(np.int64)),
            pa.array(np.array(low, np.uint64).view(np.int64)),
            pa.ListArray.from_arrays(pa.array(places), pa.array(flat.view(np.int64))),
            pa.array(minima, pa.binary()),
        ], names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "minima"])


def _filtered_sets(words: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in batches:
            batch = batch.filter(pa.array(in_filter(words, batch.column("slot").to_numpy())))
            sets = list(shingler.sets(batch.column("text")))
            places = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"),
                 pa.ListArray.from_arrays(pa.array(places), pa.array(flat.view(np.int64)))],
                names=["doc_id", "shingles"])
    return run


def shingle_sets(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """`doc_id`, `shingles` of the documents in `ids` (and a few others): the texts are scanned
    again rather than shuffled."""
    return texts.where("doc_id is not null").select("doc_id", "text", hash_slot()).mapInArrow(
        _filtered_sets(id_filter(ids)), "doc_id long, shingles array<long>")


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those of the pairs whose signatures agree in LIKELY of the bins."""
    low = nodes.select("doc_id", "minima")
    met = pairs.join(low.toDF("a", "low_a"), "a").join(low.toDF("b", "low_b"), "b")
    return met.mapInArrow(_agreeing, "a long, b long").distinct()


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                    for c in ("low_a", "low_b"))
        yield batch.filter(pa.array((one == two).sum(axis=1) >= LIKELY * BINS)).select(["a", "b"])


def confirmed(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs (`a`, `b`) whose full sets are similar enough."""
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("doc_id"), "a", "b"),
        F.struct(F.col("b").alias("doc_id"), "a", "b"))).alias("e")).select("e.*")
    sets = shingle_sets(texts, ends.select("doc_id"))
    shared = F.size(F.array_intersect("x.shingles", "y.shingles"))
    # Rows that repeat a doc_id bring a set each; the document is similar if one of them is.
    met = ends.join(sets, "doc_id").groupBy("a", "b").agg(
        F.collect_list(F.struct("doc_id", "shingles")).alias("sets"))
    sides = met.select(
        "a", "b", F.explode(F.filter("sets", lambda s: s.doc_id == F.col("a"))).alias("x"), "sets")
    sides = sides.select(
        "a", "b", "x", F.explode(F.filter("sets", lambda s: s.doc_id == F.col("b"))).alias("y"))
    total = F.size("x.shingles") + F.size("y.shingles")
    return sides.where(100 * shared >= PERCENT * (total - shared)).select("a", "b").distinct()


def links(texts: DataFrame, sketches: DataFrame) -> DataFrame:
    """(`node`, `component`) of every document that is linked with a different set."""
    rows = sketches.where("doc_id is not null and n_shingles > 0")
    nodes = rows.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("doc_id"))
    # Every step below looks at the nodes; unsaved, each would shuffle all sketches for them.
    nodes = saved(rows.join(nodes, ["set_a", "set_b", "doc_id"], "left_semi").select("doc_id", "bands", "minima"))
    banded = nodes.select("doc_id", F.explode("bands").alias("key"))
    hubs = banded.groupBy("key").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("size"))
    hubs = hubs.where("size > 1")
    # BANDS rows for a document with copies: the most rows of all that is kept, so kept compressed.
    buckets = written(banded.join(hubs, "key"))
    stars = buckets.where("doc_id > hub").select(
        F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    found = saved(confirmed(texts, saved(likely(stars, nodes))))
    return components(found.union(cross_links(texts, buckets, components(found), nodes)))


def cross_links(texts: DataFrame, buckets: DataFrame, member: DataFrame,
                nodes: DataFrame) -> DataFrame:
    """Links (`a` < `b`) inside buckets whose documents are in different components after the
    star round. Documents apart from their bucket's hub are compared with the rest of the bucket,
    in blocks of about BLOCK documents on either side: first by signature, which leaves the
    documents that are likely to have a link, then those on their full sets. A pair is looked at
    in the first of its buckets only. (The hub has met everyone already.)"""
    own = F.coalesce("component", "doc_id")
    placed = buckets.where("size > 2").join(member, F.col("doc_id") == F.col("node"), "left").select(
        "key", "size", "hub", "doc_id", own.alias("component"))
    heads = placed.where("doc_id = hub").select("key", F.col("component").alias("of"))
    placed = saved(placed.where("doc_id > hub").join(heads, "key").select(
        "key", "size", "doc_id", "component", (F.col("component") != F.col("of")).alias("apart")))
    open_ = placed.join(placed.where("apart").select("key").distinct(), "key")
    short = nodes.select("doc_id", "minima", F.transform(
        "bands", lambda x: F.shiftright(x, 32).cast("int")).alias("bands")).dropDuplicates(["doc_id"])
    active = saved(_met_in_blocks(open_.join(short, "doc_id"), ["minima", "bands"]).mapInArrow(
        _likely_members, "key long, doc_id long").distinct())
    sets = shingle_sets(texts, active.select("doc_id"))
    carried = short.join(sets, "doc_id").dropDuplicates(["doc_id"])
    again = placed.join(active, ["key", "doc_id"]).join(carried, "doc_id")
    return _met_in_blocks(again, ["minima", "bands", "shingles"]).mapInArrow(
        _block_links, "a long, b long").distinct()


def _met_in_blocks(rows: DataFrame, carried: list[str]) -> DataFrame:
    """`key`, `left`, `right`: each block of a bucket's apart rows with each block of all. One
    exchange serves both sides and their join. A bucket of more than TOGETHER blocks is dealt over
    several tasks: each has so many of its left blocks, and all right ones stream through it."""
    blocks = F.ceil(F.col("size") / BLOCK)
    shares = F.sequence(F.lit(0).cast("bigint"), F.floor((blocks - 1) / TOGETHER))
    inside = rows.select("key", F.pmod(F.xxhash64("doc_id"), blocks).alias("block"), "apart", F.struct(
        "doc_id", "component", *carried).alias("m"), F.explode(shares).alias("share")).repartition("key", "share")
    right = inside.groupBy("key", "share", "block").agg(F.collect_list("m").alias("right"))
    own = F.floor(F.col("block") / TOGETHER) == F.col("share")
    left = inside.where(F.col("apart") & own).groupBy("key", "share", "block").agg(
        F.collect_list("m").alias("left"))
    return left.select("key", "share", "left").join(
        right.select("key", "share", "right"), ["key", "share"]).select("key", "left", "right")


class _Members:
    """Documents of a block: row `row` of a column of lists."""

    def __init__(self, column: pa.Array, row: int):
        at = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
        part = column.values.slice(at[0], at[1] - at[0])
        self.ids, self.component = (part.field(n).to_numpy() for n in ("doc_id", "component"))
        self.bands = part.field("bands").flatten().to_numpy().reshape(-1, BANDS)
        self.minima = np.frombuffer(
            b"".join(part.field("minima").to_pylist()), np.uint8).reshape(-1, BINS)
        if "shingles" in {f.name for f in part.type}:
            sets = part.field("shingles")
            self.shingles = sets.flatten().to_numpy().view(np.uint64)
            self.first = np.concatenate([[0], np.cumsum(sets.value_lengths().to_numpy())])

    def set(self, i: int) -> np.ndarray:
        return self.shingles[self.first[i]: self.first[i + 1]]


def _near(left: _Members, i: int, right: _Members, key: int) -> np.ndarray:
    """Places on the right that the left's document i is likely to be linked with, and meets
    first in this bucket."""
    near = np.flatnonzero((right.component != left.component[i]) & (
        (right.minima == left.minima[i]).sum(axis=1) >= LIKELY * BINS))
    same = right.bands[near] == left.bands[i]
    first = left.bands[i][same.argmax(axis=1)]
    return near[same.any(axis=1) & (first == key >> 32)]


def _linked(left: _Members, i: int, right: _Members, near: np.ndarray) -> np.ndarray:
    """Ids at these places whose sets are similar enough to that of the left's document i."""
    own = left.set(i)
    sizes = right.first[near + 1] - right.first[near]
    values = np.concatenate([right.set(j) for j in near])
    at = np.minimum(np.searchsorted(own, values), len(own) - 1)
    shared = np.add.reduceat(own[at] == values, np.cumsum(sizes) - sizes)
    return right.ids[near[100 * shared >= PERCENT * (sizes + len(own) - shared)]]


def _meetings(batches: Iterator[pa.RecordBatch]):
    """For each batch its (key, left, place on the left, right, likely places on the right)."""
    for batch in batches:
        found = []
        for row, key in enumerate(batch.column("key").to_pylist()):
            left, right = (_Members(batch.column(side), row) for side in ("left", "right"))
            for i in range(len(left.ids)):
                near = _near(left, i, right, key)
                if len(near):
                    found.append((key, left, i, right, near))
        yield found


def _likely_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _meetings(batches):
        keys = [np.full(len(near) + 1, key) for key, _, _, _, near in found]
        ids = [np.append(right.ids[near], left.ids[i]) for _, left, i, right, near in found]
        both = np.stack([np.concatenate([np.zeros(0, np.int64), *x]) for x in (keys, ids)])
        yield _two_columns(np.unique(both, axis=1), "key", "doc_id")


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _meetings(batches):
        out = [np.zeros((2, 0), np.int64)]
        for _, left, i, right, near in found:
            other = _linked(left, i, right, near)
            out.append(np.stack([np.minimum(other, left.ids[i]), np.maximum(other, left.ids[i])]))
        yield _two_columns(np.unique(np.concatenate(out, axis=1), axis=1), "a", "b")


def _two_columns(values: np.ndarray, *names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values[0]), pa.array(values[1])], names=list(names))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of docs: `doc_id`, `n_shingles`, `component_id`, `kept`."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = saved(texts.mapInArrow(
        _sketches, "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, "
        "minima binary"))
    member = links(texts, sketches)
    slim = sketches.drop("bands", "minima")
    nodes = slim.where("n_shingles > 0").groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"))
    nodes = nodes.join(member, "node", "left").select(
        "set_a", "set_b", F.coalesce("component", "node").alias("component"))
    # Equal sets under a doc_id that also has another set: both rows are the same document.
    placed = slim.join(nodes, ["set_a", "set_b"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return placed.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def kept_documents(docs: DataFrame) -> DataFrame:
    """Documents with one of each group of near-duplicates left; all columns stay. Of rows that
    repeat the doc_id of a kept document all stay (exact deduplication comes before)."""
    keep = near_duplicates(docs.select("doc_id", "text")).where("kept and doc_id is not null")
    named = docs.join(keep.select("doc_id").distinct(), "doc_id", "left_semi")
    return named.unionByName(docs.where("doc_id is null"))


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) END)
    AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT a AS root, b AS node FROM both_
  UNION SELECT root, b FROM reached JOIN both_ ON a = node),
component AS (SELECT node, min(root) AS root FROM reached GROUP BY node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, least(doc_id, coalesce(root, doc_id)) AS component_id,
       doc_id <= coalesce(root, doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN component ON node = doc_id
"""
