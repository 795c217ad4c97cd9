"""Sharding by a k-d tree over document metadata, cut at weighted medians.

Units are groups of equal texts, so that copies stay in one shard; a group of more than half a
shard's bytes is cut into parts. Each unit is a point: text size, source, language and id. A node
of the tree is split along its widest axis where the bytes divide as its leaves do, until a node
is one shard. (If a large group lies across the cut of the widest axis, so that it would be more
than CLOSE off, the axis with the closest cut is taken.)

The medians are found in the data, all nodes and axes of a level together: a histogram of bytes
over BINS ranges of each node's axis, then the same inside the range that holds the median, until
the cut is close or falls between two units. Only histograms move, never the units.

DataFrame functions only. The law is `bytes`: sizes of shards are near equal.

Cases: a null text has no bytes and counts 1, as every row counts its bytes plus 1; null source,
language or id are points of their own. Rows that repeat are copies of each other. An empty table
gives an empty result. Only the five document columns are read, others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

AXES = ("by_size", "by_source", "by_lang", "by_id")
BINS = 4096
CLOSE = 0.005
GRID = 65_535
ROWS_PER_BUCKET = 4096
_TIE = 1 << 31


def _rows(docs: DataFrame) -> DataFrame:
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("digest"), F.crc32(F.coalesce("source", F.lit("")).cast("binary")).alias("by_source"),
        F.crc32(F.coalesce("lang", F.lit("")).cast("binary")).alias("by_lang"))


def _units(rows: DataFrame, target: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their part, and units with their points on the grid."""
    groups = rows.groupBy("digest").agg(F.sum("size").alias("group_bytes"))
    # Groups over half a target: at most twice the number of shards.
    large = groups.where(F.col("group_bytes") > target / 2).select(
        "digest", F.ceil(F.col("group_bytes") / (target / 4)).alias("parts"))
    cut = rows.join(F.broadcast(large), "digest", "left").withColumn("part", F.coalesce(
        F.pmod(F.xxhash64("doc_id"), "parts"), F.lit(0)).cast("int")).drop("parts")
    first = F.struct("doc_id", "by_source", "by_lang")
    points = cut.groupBy("digest", "part").agg(
        F.sum("size").alias("weight"), F.log2(F.max("size")).alias("by_size"), F.min(first).alias("first"))
    points = saved(points.select(
        "digest", "part", "weight", "by_size", "first.by_source", "first.by_lang",
        F.coalesce("first.doc_id", F.lit(-1)).alias("by_id")))
    ends = points.agg(*[F.struct(F.min(a), F.max(a) - F.min(a)).alias(a) for a in AXES]).first()
    tie = F.pmod(F.xxhash64("digest", "part"), F.lit(_TIE))
    on_grid = [
        (F.floor((F.col(a) - F.lit(ends[a][0])) / F.lit(max(ends[a][1] or 0, 1e-9)) * GRID)
         * _TIE + F.pmod(tie * (2 * i + 1), F.lit(_TIE))).cast("long").alias(a)
        for i, a in enumerate(AXES)]
    return cut, points.select("digest", "part", "weight", *on_grid)


def _axis_rows(units: DataFrame) -> DataFrame:
    """A row per unit and axis."""
    return units.select("node", "weight", F.explode(F.array(*[
        F.struct(F.lit(i).alias("axis"), F.col(a).alias("key")) for i, a in enumerate(AXES)
    ])).alias("p")).select("node", "weight", "p.axis", "p.key")


def _cuts(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """(`node`, `axis`, `cut`): units with a key below `cut` on that axis go left."""
    points = _axis_rows(units)
    whole = points.groupBy("node", "axis").agg(
        F.min("key").alias("low"), (F.max("key") + 1).alias("high"), F.sum("weight").alias("total"))
    width = F.floor(F.col("high") / _TIE) - F.floor(F.col("low") / _TIE)
    # Nodes are at most as many as shards; so is all that is broadcast here, times the axes.
    state = _small(whole.join(F.broadcast(nodes), "node").select(
        "node", "axis", "low", "high", "total", width.alias("width"),
        (F.col("total") * F.floor(F.col("leaves") / 2) / F.col("leaves")).alias("wanted"),
        F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("cut"),
        F.lit(None).cast("double").alias("off")))
    while not (open_ := state.where("cut is null")).isEmpty():
        step = F.ceil((F.col("high") - F.col("low")) / F.lit(float(BINS))).cast("long")
        inside = points.join(F.broadcast(open_.select("node", "axis", "low", "high", step.alias("step"))),
                             ["node", "axis"]).where("key >= low and key < high")
        bins = inside.groupBy("node", "axis", F.floor((F.col("key") - F.col("low")) / F.col("step"))
                              .alias("bin")).agg(F.sum("weight").alias("w"), F.count(F.lit(1)).alias("n"))
        up_to = Window.partitionBy("node", "axis").orderBy("bin")
        summed = bins.join(F.broadcast(open_), ["node", "axis"]).withColumns({
            "step": step, "upper": F.col("below") + F.sum("w").over(up_to)})
        summed = summed.withColumn("lower", F.col("upper") - F.col("w"))
        near_low = F.col("wanted") - F.col("lower") <= F.col("upper") - F.col("wanted")
        start = F.col("low") + F.col("bin") * F.col("step")
        off = F.least(F.col("wanted") - F.col("lower"), F.col("upper") - F.col("wanted"))
        done = (F.col("n") == 1) | (F.col("step") == 1) | (off <= CLOSE / 4 * F.col("total"))
        # Both halves get a unit: a cut at the very end would leave one empty.
        chosen = summed.where("lower < wanted and upper >= wanted").select(
            "node", "axis", start.alias("low"), F.least("high", start + F.col("step")).alias("high"),
            "total", "width", "wanted", F.col("lower").alias("below"),
            F.when(done, F.when(near_low & (F.col("lower") > 0), start).otherwise(start + F.col("step")))
            .alias("cut"), F.when(done, off / F.col("total")).alias("off"))
        state = _small(state.where("cut is not null").unionByName(chosen))
    best = Window.partitionBy("node").orderBy(
        F.col("off") > CLOSE, F.when(F.col("off") > CLOSE, F.col("off")), F.col("width").desc(), "axis")
    return state.withColumn("place", F.row_number().over(best)).where("place = 1").select(
        "node", "axis", "cut")


def _small(rows: DataFrame) -> DataFrame:
    """A few rows per node, kept in one part."""
    return saved(rows.repartition(1))


def assign(units: DataFrame, shards: int) -> DataFrame:
    """(`digest`, `part`, `shard`): leaves of the tree, numbered from left to right."""
    axis_key: Column = F.element_at(F.array(*AXES), F.col("axis") + 1)
    units = units.withColumn("node", F.lit(0).cast("long"))
    nodes = units.sparkSession.range(1).select(
        F.col("id").alias("node"), F.lit(shards).cast("long").alias("leaves"))
    deepest = shards
    # A node is named by its first shard.
    while deepest > 1:
        nodes = _small(nodes.join(F.broadcast(_cuts(units, nodes.where("leaves > 1"))), "node", "left"))
        left = F.floor(F.col("leaves") / 2)
        goes_right = (F.col("leaves") > 1) & (axis_key >= F.col("cut"))
        units = units.join(F.broadcast(nodes), "node").select(
            (F.col("node") + F.when(goes_right, left).otherwise(0)).alias("node"),
            "digest", "part", "weight", *AXES)
        units = saved(units)
        nodes = nodes.where("leaves = 1").select("node", "leaves").union(
            nodes.where("leaves > 1").select(F.explode(F.array(
                F.struct(F.col("node"), left.alias("leaves")),
                F.struct((F.col("node") + left).alias("node"), (F.col("leaves") - left).alias("leaves"))
            )).alias("n")).select("n.*"))
        deepest = deepest - deepest // 2
    return units.select("digest", "part", F.col("node").cast("int").alias("shard"))


def numbered(rows: DataFrame, within: str) -> DataFrame:
    """`slot`: a gapless number from 0 in each value of `within`. Rows are numbered in hashed
    buckets of about ROWS_PER_BUCKET, and each bucket starts where those before it end."""
    buckets = max(1, -(-rows.count() // ROWS_PER_BUCKET))
    bucketed = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_crc32", "row"), F.lit(buckets)))
    before = Window.partitionBy(within).orderBy("bucket")
    starts = bucketed.groupBy(within, "bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select(within, "bucket", (F.sum("n").over(before) - F.col("n")).alias("start"))
    place = F.row_number().over(Window.partitionBy(within, "bucket").orderBy("doc_id", "row"))
    return bucketed.withColumn("place", place).join(starts, [within, "bucket"]).withColumn(
        "slot", F.col("start") + F.col("place") - 1).drop("bucket", "place", "start")


def shards(docs: DataFrame, count: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """One row per row of docs with its `shard` and `slot`: as many shards as given, or as it takes
    to have about `target_bytes` in each."""
    rows = saved(_rows(docs).withColumn("row", F.monotonically_increasing_id()))
    total = rows.agg(F.sum("size")).first()[0] or 0
    count = count or max(1, -(-total // (target_bytes or total or 1)))
    cut, units = _units(rows, max(total / count, 1))
    placed = cut.join(assign(units, count), ["digest", "part"])
    return numbered(saved(placed.select("doc_id", "size", "text_crc32", "row", "shard")), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
