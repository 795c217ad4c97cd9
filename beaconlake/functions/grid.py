"""Nearest neighbours of many places by a grid, exact and without pairs of all with all.

Places are points of the unit sphere, so there is no seam and there are no poles, and the straight
distance through the sphere grows with the one on it. Space is cut into cubes whose side doubles
from level to level. Counts per cube tell for each anchor the finest level at which the 27 cubes
around it hold enough points. The n-th nearest of those is a bound: nothing farther away can be among the n nearest.
All cubes of the next level that the bound can reach are then looked at, and no others.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geo import distance_km

# Side of the cubes of each level: 2 ** level. The finest are some six metres wide; at the coarsest
# the cubes around any point hold the whole sphere.
LEVELS = tuple(range(-20, 2, 1))
AXES = ("x", "y", "z")
# Coordinates are rounded; what is that near to the bound is looked at.
SLACK = 1e-9


def _point(latitude: Column, longitude: Column) -> list[Column]:
    a, b = F.radians(latitude), F.radians(longitude)
    return [(F.cos(a) * F.cos(b)).alias("x"), (F.cos(a) * F.sin(b)).alias("y"), F.sin(a).alias("z")]


def _cell(axis: str, side: Column) -> Column:
    return F.floor(F.col(axis) / side).cast("bigint")


def _side(level: Column) -> Column:
    return F.pow(F.lit(2.0), level.cast("double"))


def _shifted(radius: Column) -> Column:
    """All cells within `radius` cells of one on each axis."""
    steps = F.sequence(-radius, radius)
    return F.flatten(F.flatten(F.transform(steps, lambda i: F.transform(steps, lambda j: F.transform(
        steps, lambda k: F.struct((F.col("cx") + i).alias("x"), (F.col("cy") + j).alias("y"),
                                  (F.col("cz") + k).alias("z")))))))


def nearest(anchors: DataFrame, places: DataFrame, n: int) -> DataFrame:
    """The n places nearest to each anchor, ties by id: `anchor_id`, `place_id`, `distance_km`, `place`.

    `anchors` has anchor_id, latitude and longitude, `places` has place_id, latitude and longitude.
    Rows without a position are left out. Where there are fewer than n places, all are given.
    """
    positions = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    points = places.where(positions).select(
        "place_id", "latitude", "longitude", *_point(F.col("latitude"), F.col("longitude")))
    around = anchors.where(positions).select(
        "anchor_id", F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon"),
        *_point(F.col("latitude"), F.col("longitude")))
    level = F.explode(F.array(*[F.lit(x) for x in LEVELS])).alias("level")
    cells = [_cell(a, _side(F.col("level"))).alias(f"c{a}") for a in AXES]
    key = ["level", "cx", "cy", "cz"]
    # How many places each cube of each level holds.
    counts = points.select(*AXES, level).select("level", *cells).groupBy(*key).agg(
        F.count(F.lit(1)).alias("held"))
    near = F.explode(F.array(*[
        F.struct(*[F.lit(s).alias(a) for s, a in zip(step, AXES)]) for step in product((-1, 0, 1), repeat=3)]))
    blocks = around.select("*", level).select("*", *cells).withColumn("s", near).select(
        "anchor_id", "level", *[(F.col(f"c{a}") + F.col(f"s.{a}")).alias(f"c{a}") for a in AXES])
    enough = blocks.join(counts, key).groupBy("anchor_id", "level").agg(F.sum("held").alias("held"))
    top = LEVELS[-1]
    chosen = around.join(
        enough.where(F.col("held") >= n).groupBy("anchor_id").agg(F.min("level").alias("level")),
        "anchor_id", "left").withColumn("level", F.coalesce("level", F.lit(top)))
    # The bound: distance to the n-th of the places in the block, or to all there are.
    leveled = points.select("*", level).select("*", *cells)
    block = chosen.select("*", *cells).withColumn("s", near).select(
        *[F.col(c) for c in ("anchor_id", "a_lat", "a_lon", "level")],
        *[F.col(a).alias(f"a{a}") for a in AXES],
        *[(F.col(f"c{a}") + F.col(f"s.{a}")).alias(f"c{a}") for a in AXES])
    chord = F.sqrt(sum((F.pow(F.col(a) - F.col(f"a{a}"), F.lit(2.0)) for a in AXES), F.lit(0.0)))
    by_chord = Window.partitionBy("anchor_id").orderBy("chord")
    bound = block.join(leveled, key).select("anchor_id", chord.alias("chord")).withColumn(
        "nth", F.row_number().over(by_chord)).where(F.col("nth") <= n).groupBy("anchor_id").agg(
        F.max("chord").alias("bound"))
    reach = chosen.join(bound, "anchor_id").withColumn(
        "level", F.least(F.col("level") + 1, F.lit(top))).select(
        "*", *cells, F.ceil((F.col("bound") + SLACK) / _side(F.col("level"))).cast("bigint").alias("radius"))
    wanted = reach.withColumn("cell", F.explode(_shifted(F.col("radius")))).select(
        "anchor_id", "a_lat", "a_lon", "bound", "level", *[F.col(a).alias(f"a{a}") for a in AXES],
        *[F.col(f"cell.{a}").alias(f"c{a}") for a in AXES])
    order = Window.partitionBy("anchor_id").orderBy("distance_km", "place_id")
    return wanted.join(leveled, key).where(chord <= F.col("bound") + SLACK).select(
        "anchor_id", "place_id", distance_km(F.col("a_lat"), F.col("a_lon"), F.col("latitude"),
                                             F.col("longitude")).alias("distance_km")).withColumn(
        "place", F.row_number().over(order)).where(F.col("place") <= n)
