"""Geographic and key-hash Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean earth radius.
EARTH_RADIUS_KM = 6371.0088


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance by the haversine formula."""
    a, b = F.radians(lat1), F.radians(lat2)
    dlat, dlon = b - a, F.radians(lon2 - lon1)
    h = (F.pow(F.sin(dlat / 2), F.lit(2.0))
         + F.cos(a) * F.cos(b) * F.pow(F.sin(dlon / 2), F.lit(2.0)))
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(h))


def stable_uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) fixed by its key parts: the first 8 bytes of their SHA-256."""
    digest = F.sha2(F.concat_ws("|", *parts).cast("binary"), 256)
    head = F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
    return head.cast("double") / F.lit(float(2 ** 64))


def banded(number: Column, bands: dict[str, float], otherwise: str) -> Column:
    """The first label whose cumulative rate lies above the number."""
    upper, label = 0.0, None
    for name, rate in bands.items():
        upper += rate
        label = F.when(number < upper, name) if label is None else label.when(number < upper, name)
    return label.otherwise(otherwise)
