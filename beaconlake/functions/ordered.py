"""Ordered per-key functions that stay parallel inside one hot key.

A plain window over a key sorts that key's whole history in one task. These variants
cut each key's order into buckets, run the window inside the buckets and carry one
summary row per bucket across them, so a key holding a third of all rows is spread over
as many tasks as it has buckets. The result is the same as that of the plain window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_next_value(
    df: DataFrame, keys: list[str], order: list[str], bucket: Column, name: str
) -> DataFrame:
    """Add `lead(order[0])` per key as `name`. `bucket` must rise with `order[0]`."""
    value = order[0]
    cut = df.withColumn("_bucket", bucket)
    inside = cut.withColumn(
        "_next_inside", F.lead(value).over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    )
    heads = (
        df.select(*keys, value).withColumn("_bucket", bucket)
        .groupBy(*keys, "_bucket").agg(F.min(value).alias("_head"))
    )
    following = heads.select(
        *keys, "_bucket",
        F.lead("_head").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_next_bucket"),
    )
    return (
        inside.join(following, [*keys, "_bucket"], "left")
        .withColumn(name, F.coalesce("_next_inside", "_next_bucket"))
        .drop("_bucket", "_next_inside", "_next_bucket")
    )


def with_previous_max(
    df: DataFrame, keys: list[str], order: str, value: str, bucket: Column, name: str
) -> DataFrame:
    """Add the maximum of `value` over all earlier rows of the key (NULL on the first)."""
    cut = df.withColumn("_bucket", bucket)
    earlier = (
        Window.partitionBy(*keys, "_bucket").orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = cut.withColumn("_inside", F.max(value).over(earlier))
    tops = (
        df.select(*keys, order, value).withColumn("_bucket", bucket)
        .groupBy(*keys, "_bucket").agg(F.max(value).alias("_top"))
    )
    carried = tops.select(
        *keys, "_bucket",
        F.max("_top").over(
            Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        ).alias("_carried"),
    )
    return (
        inside.join(carried, [*keys, "_bucket"], "left")
        .withColumn(name, F.greatest("_inside", "_carried"))
        .drop("_bucket", "_inside", "_carried")
    )


def with_row_number(
    df: DataFrame, keys: list[str], order: str, bucket: Column, name: str
) -> DataFrame:
    """Add `row_number()` per key. `bucket` must rise with `order`."""
    cut = df.withColumn("_bucket", bucket)
    inside = cut.withColumn(
        "_place", F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(order))
    )
    sizes = (
        df.select(*keys, order).withColumn("_bucket", bucket)
        .groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    )
    offsets = sizes.select(
        *keys, "_bucket",
        F.coalesce(
            F.sum("_size").over(
                Window.partitionBy(*keys).orderBy("_bucket")
                .rowsBetween(Window.unboundedPreceding, -1)
            ), F.lit(0)
        ).alias("_before"),
    )
    return (
        inside.join(offsets, [*keys, "_bucket"], "left")
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("bigint"))
        .drop("_bucket", "_place", "_before")
    )


def with_previous_value(
    df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, name: str
) -> DataFrame:
    """Add `lag(value)` per key as `name`. `bucket` must rise with `order`."""
    cut = df.withColumn("_bucket", bucket)
    inside = cut.withColumn(
        "_inside", F.lag(value).over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    )
    tails = cut.groupBy(*keys, "_bucket").agg(
        F.max_by(F.col(value), F.struct(*order)).alias("_tail"))
    carried = tails.select(
        *keys, "_bucket",
        F.lag("_tail").over(Window.partitionBy(*keys).orderBy("_bucket")).alias("_carried"),
    )
    return (
        inside.join(carried, [*keys, "_bucket"], "left")
        .withColumn(name, F.coalesce("_inside", "_carried"))
        .drop("_bucket", "_inside", "_carried")
    )
