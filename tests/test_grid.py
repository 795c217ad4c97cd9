import math
import random

import pytest

from beaconlake.functions.grid import nearest


def km(a, b):
    (la, lo), (lb, lob) = a, b
    p, q = math.radians(la), math.radians(lb)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lob - lo) / 2) ** 2
    return 6371.0088 * 2 * math.asin(math.sqrt(h))


def places(kind, rng, n):
    if kind == "spread":
        return [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(n)]
    if kind == "town":  # most in one town, some far away, two at the poles
        town = [(48 + rng.gauss(0, 0.002), 11 + rng.gauss(0, 0.002)) for _ in range(n - 12)]
        return town + [(rng.uniform(-80, 80), rng.uniform(-180, 180)) for _ in range(10)] + [(90.0, 0.0), (-90.0, 7.0)]
    return [(10.0, 179.999 if i % 2 else -179.999) for i in range(n)]  # ties, on both sides of the seam


@pytest.mark.parametrize("kind", ["spread", "town", "ties"])
@pytest.mark.parametrize("n", [1, 7, 300])
def test_nearest_equal_brute_force(spark, kind, n):
    rng = random.Random(f"{kind}{n}")
    there = [(f"p{i:03}", *p) for i, p in enumerate(places(kind, rng, 120))]
    anchors = [(f"a{i}", *p) for i, p in enumerate(places(kind, rng, 12) + [(90.0, 0.0), (0.0, 180.0), (47.9, 11.2)])]
    nothing = [("lost", None, 1.0)]
    got = nearest(spark.createDataFrame(anchors + nothing, "anchor_id string, latitude double, longitude double"),
                  spark.createDataFrame(there + nothing, "place_id string, latitude double, longitude double"), n)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Cross" not in plan
    found = {}
    for r in got.collect():
        found.setdefault(r["anchor_id"], []).append((r["place"], r["place_id"], r["distance_km"]))
    assert set(found) == {a for a, *_ in anchors}
    for a, *at in anchors:
        want = sorted((km(at, p), i) for i, *p in there)[:n]
        own = sorted(found[a])
        assert [x[0] for x in own] == list(range(1, min(n, len(there)) + 1))
        for (_, i, d), (e, _) in zip(own, want):
            assert math.isclose(d, e, abs_tol=1e-6)
            assert math.isclose(km(at, next(p for j, *p in there if j == i)), e, abs_tol=1e-6)


def test_no_places_or_anchors(spark):
    anchors = spark.createDataFrame([("a", 1.0, 2.0)], "anchor_id string, latitude double, longitude double")
    nowhere = spark.createDataFrame([], "place_id string, latitude double, longitude double")
    assert nearest(anchors, nowhere, 3).collect() == []
    assert nearest(anchors.limit(0), nowhere, 3).collect() == []
