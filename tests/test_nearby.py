import math
import random

import numpy as np
import pytest
from galena.functions import sphere
from galena.operators.nearby import containing_regions, near_pairs


def brute(q, p, radius):
    out = set()
    place = lambda r: r[0] is not None and r[1] is not None and r[2] is not None and not (r[1] == 0 and r[2] == 0) and not (math.isnan(r[1]) or math.isnan(r[2]))
    for a in filter(place, q):
        for b in filter(place, p):
            if sphere.haversine_m(*map(np.float64, (a[1], a[2], b[1], b[2]))) <= radius:
                out.add((a[0], b[0]))
    return out


def points(n, seed, name):
    r = random.Random(seed)
    centres = [(48.85, 2.35), (-21.2, 55.5), (89.9999, 10.0), (0.001, 179.9999), (-89.9995, -120.0)]
    out = []
    for i in range(n):
        la, lo = r.choice(centres)
        la, lo = la + r.uniform(-0.004, 0.004), lo + r.uniform(-0.004, 0.004)
        out.append((f"{name}{i}", min(max(la, -90.0), 90.0), lo - 360 if lo > 180 else lo))
    return out


@pytest.mark.parametrize("most", [(50_000, 200_000), (7, 11)])
def test_pairs_equal_brute_force_also_with_split_cells(spark, most):
    q = points(150, 1, "q") + [("n", None, 2.0), ("z", 0.0, 0.0), ("nan", float("nan"), 1.0), (None, 48.85, 2.35), ("tie", 48.85, 2.35), ("tie", 48.85, 2.35)]
    p = points(150, 2, "p") + [("same", 48.85, 2.35), ("n", 48.85, None), ("z", 0.0, 0.0)]
    a = spark.createDataFrame(q, "id string, lat double, lon double").selectExpr("id as q", "lat as latitude", "lon as longitude", "'x' as bucket", "1 as slice")
    b = spark.createDataFrame(p, "p string, latitude double, longitude double")
    got = [tuple(r) for r in near_pairs(a, b, 200.0, "q", "p", most_points=most[0], most_ranges=most[1]).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(q, p, 200.0)


def test_empty_and_distance(spark):
    a = spark.createDataFrame([("a", 48.0, 2.0)], "q string, latitude double, longitude double")
    b = spark.createDataFrame([("b", 48.001, 2.0)], "p string, latitude double, longitude double")
    assert near_pairs(a.limit(0), b, 200, "q", "p").count() == 0
    assert near_pairs(a, b.limit(0), 200, "q", "p").count() == 0
    r = near_pairs(a, b, 200, "q", "p", distance="m").first()
    assert r.m == pytest.approx(111.19, abs=0.01)


def test_covers_hold_every_point_of_the_disc():
    r = np.random.default_rng(0)
    lat, lon = r.uniform(-90, 90, 500), r.uniform(-180, 180, 500)
    for radius in (1.0, 200.0, 50_000.0):
        i, lo, hi = sphere.cover_discs(lat, lon, radius, sphere.cover_level(radius), 4)
        turn, d = r.uniform(0, 2 * np.pi, 500), 0.99 * radius * np.sqrt(r.uniform(0, 1, 500))
        la = np.clip(lat + np.degrees(d * np.cos(turn) / sphere.EARTH_M), -90, 90)
        lg = lon + np.degrees(d * np.sin(turn) / sphere.EARTH_M / np.maximum(np.cos(np.radians(lat)), 1e-3))
        inside = sphere.haversine_m(lat, lon, la, lg) <= radius
        code, held = sphere.point_codes(la, lg), np.zeros(500, bool)
        np.logical_or.at(held, i, (code[i] >= lo) & (code[i] <= hi))
        assert held[inside].all()


def _in_ring(la, lo, ring):
    inside = False
    for (a, b), (c, d) in zip(ring, ring[1:] + ring[:1]):
        if (a > la) != (c > la) and lo < b + (la - a) / (c - a) * (d - b):
            inside = not inside
    return inside


def test_containing_regions(spark):
    r = random.Random(9)
    points = [(f"p{i}", 40 + r.random() * 10, r.random() * 8 - 2) for i in range(400)] + [("zero", 0.0, 0.0), ("none", None, 1.0), ("p0", 41.0, 3.0)]
    rings = {f"r{k}": [(la + r.uniform(-w, w), lo + r.uniform(-w, w)) for _ in range(r.randint(3, 7))] for k in range(25) for w in [10 ** r.uniform(-3, 0.4)] for la, lo in [(40 + r.random() * 10, r.random() * 8 - 2)]}
    rows = [(k, v, "x") for k, v in rings.items()] + [("thin", [(1.0, 1.0), (2.0, 2.0)], "x"), ("hole", [(1.0, None), (2.0, 2.0), (3.0, 1.0)], "x"), (None, rings["r1"], "x"), ("r1", rings["r1"], "x")]
    p = spark.createDataFrame(points, "id string, latitude double, longitude double")
    g = spark.createDataFrame(rows, "id_r string, ring array<struct<lat: double, lon: double>>, id string")
    want = {(i, k) for i, la, lo in points if la is not None and (la, lo) != (0, 0) for k, ring in rings.items() if _in_ring(la, lo, ring)}
    got = [tuple(x) for x in containing_regions(p, g, "id", "id_r").collect()]
    assert set(got) == want and len(got) == len(want) and want
    assert containing_regions(p, g.limit(0), "id", "id_r").count() == 0 and containing_regions(p.limit(0), g, "id", "id_r").count() == 0
