"""Time arithmetic on TIMESTAMP columns, exact to the microsecond."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import CLOCK_DAYS


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def minutes(micros: Column) -> Column:
    return micros.cast("double") / F.lit(60_000_000.0)


def seconds(micros: Column) -> Column:
    return micros.cast("double") / F.lit(1_000_000.0)


def before(moment: Column, window: timedelta) -> Column:
    return moment - F.lit(window)


def since(df: DataFrame, clock: str, bound: Column, day_column: str | None = None) -> DataFrame:
    """Rows at or after `bound` on the given clock.

    Stored tables carry their partition days (`event_day` of the measurement time,
    `arrival_day` of the arrival); the same bound is then also put on that column so that
    whole day partitions are skipped. Files from before day partitioning sit in the
    NULL day and are always read.
    """
    day_column = day_column or CLOCK_DAYS[clock]
    kept = F.col(clock) >= bound
    if day_column in df.columns:
        kept = kept & (F.col(day_column).isNull() | (F.col(day_column) >= F.to_date(bound)))
    return df.where(kept)
