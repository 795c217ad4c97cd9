"""Aggregates shared by the statistics reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The digest is exact while a group holds fewer rows than this and has a relative rank
# error of 1/accuracy beyond. Digests merge map-side, so a hot group shuffles only its
# digests, never its rows.
PERCENTILE_ACCURACY = 100_000


def percentile(column: str | Column, p: float) -> Column:
    return F.percentile_approx(column, F.lit(p), F.lit(PERCENTILE_ACCURACY))


def percentiles(column: str | Column, *ps: float) -> Column:
    """Several percentiles from one digest, as an array in the order given."""
    wanted = F.array(*[F.lit(float(p)) for p in ps])
    return F.percentile_approx(column, wanted, F.lit(PERCENTILE_ACCURACY))


def percent_of(part: Column, whole: Column) -> Column:
    """100 * part / whole as DOUBLE, NULL when the whole is zero."""
    return F.try_divide(F.lit(100.0) * part.cast("double"), whole.cast("double"))
