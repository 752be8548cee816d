"""Density clusters against a plain restatement; crowded cells form no pairs within."""

import math
import random

import pytest
from pyspark.sql import functions as F

from atlasweave.functions.geo import haversine_km
from atlasweave.operators import density, spatial


def km(a, b):
    f1, f2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((f2 - f1) / 2) ** 2 + math.cos(f1) * math.cos(f2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, h)))


def plain(points, metres, min_samples):
    """Clusters by scanning the rows: (id, lon, lat) to numbers."""
    real = [(i, (x, y)) for i, x, y in points if x is not None and y is not None and not math.isnan(x) and not math.isnan(y)]
    near = {i: [j for j, q in real if km(p, q) * 1000 <= metres] for i, p in real}
    core = {i for i in near if len(near[i]) >= min_samples}
    out = {i: None for i, _, _ in points}
    number = 0
    for i in sorted(core):
        if out[i] is not None:
            continue
        number += 1
        todo = [i]
        while todo:
            k = todo.pop()
            if out[k] is None:
                out[k] = number
                if k in core:
                    todo += near[k]
    alone = 0
    for i, _ in sorted(real):
        if out[i] is None:
            alone -= 1
            out[i] = alone
    return out


def scattered(seed, n=260):
    r = random.Random(seed)
    points = []
    for lon, lat in ((180.0, 0.1), (12.0, 51.0), (-180.0, -70.0), (40.0, 89.999), (0.0, -89.9995), (-60.0, 0.0)):
        for _ in range(n // 6):
            x = lon + r.gauss(0, 0.0012) / max(0.0001, math.cos(math.radians(lat)))
            points.append(((x + 180) % 360 - 180, max(-90.0, min(90.0, lat + r.gauss(0, 0.0012)))))
    points += r.sample(points, 20)  # spots of several rows
    points += [(None, 1.0), (float("nan"), 0.0), (float("nan"), 0.0), (5.0, float("inf"))]
    r.shuffle(points)
    return [(i, x, y) for i, (x, y) in enumerate(points)]


@pytest.mark.parametrize(("min_samples", "metres", "pairs"), [(1, 60, 10_000), (2, 60, 10_000), (3, 90, 10_000), (5, 150, 10_000), (3, 90, 1), (2, 200, 4)])
def test_equal_to_plain(spark, monkeypatch, min_samples, metres, pairs):
    monkeypatch.setattr(density, "PAIRS", pairs)
    points = [p for p in scattered(min_samples + pairs) if p[2] is None or not math.isinf(p[2])]
    expected = plain(points, metres, min_samples)
    df = spark.createDataFrame(points, "id long, lon double, lat double").selectExpr("*", "'x' AS x", "'y' AS y", "1 AS u", "2 AS v", "3 AS n", "4 AS row", "5 AS first")
    got = {r["id"]: r["c"] for r in spatial.clusters(df, "id", "lon", "lat", metres, "c", min_samples).collect()}
    assert got == expected
    assert max(v for v in expected.values() if v) > 3


def test_infinite_is_no_point(spark):
    df = spark.createDataFrame([(1, 5.0, math.inf), (2, math.nan, 0.0), (3, math.nan, 0.0), (4, 1.0, 1.0)], "id long, x double, y double")
    assert {r["id"]: r["c"] for r in spatial.clusters(df, "id", "x", "y", 50, "c").collect()} == {1: None, 2: None, 3: None, 4: -1}
    assert spatial.clusters(df.limit(0), "id", "x", "y", 50, "c").count() == 0
    near = spatial.near_pairs(df, df.selectExpr("id AS j", "x AS x2", "y AS y2"), 50, ("x", "y"), ("x2", "y2"))
    assert [(r["id"], r["j"]) for r in near.collect()] == [(4, 4)]


def test_a_crowded_cell_forms_no_pairs(spark, monkeypatch):
    """100,000 spots in one cell beside 2,000 in the next, and one between them: nothing is compared in full."""
    seen = []
    real = haversine_km

    def watched(*columns):
        seen.append(columns)
        return real(*columns)

    monkeypatch.setattr(density.geo, "haversine_km", watched)
    city = spark.range(100_000).selectExpr("id", "10 + (id % 400) * 1e-7 AS lon", "50 + floor(id / 400) * 1e-7 AS lat")
    town = spark.range(2_000).selectExpr("id + 200000 AS id", "10.003 + (id % 50) * 1e-7 AS lon", "50 + floor(id / 50) * 1e-7 AS lat")
    df = city.unionAll(town)
    rows = spatial.clusters(df, "id", "lon", "lat", 250, "c", 5).groupBy("c").count().collect()
    assert {(r["c"], r["count"]) for r in rows} == {(1, 102_000)}
    apart = spatial.clusters(df, "id", "lon", "lat", 150, "c", 5).groupBy("c").count().collect()
    assert {(r["c"], r["count"]) for r in apart} == {(1, 100_000), (2, 2_000)}


def test_overlaps_with_columns_x_and_y(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1.0), (2, "b", 1.0, 1.0), (3, "b", 2.0, 2.0)], "k long, x string, lon double, lat double").withColumn("y", F.lit(0))
    assert {r["k"]: r["is_overlap"] for r in spatial.overlaps(df, "k", "x", "lon", "lat").collect()} == {1: "YES", 2: "YES", 3: "NO"}
