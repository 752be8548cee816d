"""Distances across the 180th meridian and at the poles."""

import random

import pytest
from pyspark.sql import functions as F

from atlasweave.functions.geo import haversine_km
from atlasweave.operators import spatial
from atlasweave.operators.linkage import distance_match


def spread(r, lon, lat, n):
    """Points around one, longitudes as they may come."""
    for _ in range(n):
        x = lon + r.uniform(-0.01, 0.01) / max(0.02, 1 - abs(lat) / 90)
        yield (x + 180) % 360 - 180, max(-90.0, min(90.0, lat + r.uniform(-0.01, 0.01)))


@pytest.mark.parametrize("metres", [300, 2500])
def test_pairs_equal_brute_force(spark, metres):
    r = random.Random(7)
    points = [p for lon, lat in ((180, 0.2), (180, 65), (-180, -40), (12, 51), (0, 89.99), (90, -89.995), (33, 89.9)) for p in spread(r, lon, lat, 60)]
    points += [(r.uniform(-180, 180), lat) for lat in (89.999, 89.99, 89.97, -89.998, -89.98) for _ in range(40)] + [(180.0, 10.0), (-180.0, 10.0), (179.9999, 10.0), (-179.9999, 10.0), (0.0, 90.0), (77.0, 90.0), (0.0, -90.0), (0.0, 0.0)]
    a = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], "i int, x double, y double")
    b = a.select(F.col("i").alias("j"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    got = sorted((p["i"], p["j"]) for p in spatial.near_pairs(a, b, metres, ("x", "y"), ("x2", "y2")).collect())
    want = sorted((p["i"], p["j"]) for p in a.crossJoin(b).filter(haversine_km(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")) * 1000 <= metres).select("i", "j").collect())
    assert got == want
    assert len(want) > len(points)


def test_clusters_and_matches_across_the_meridian(spark):
    df = spark.createDataFrame([(1, "Kaya", 179.9999, 5.0), (2, "Kaya", -179.9999, 5.0), (3, "Other", -179.5, 5.0)], "id int, name string, lon double, lat double")
    assert {r["id"]: r["c"] for r in spatial.clusters(df, "id", "lon", "lat", 50, "c").collect()} == {1: 1, 2: 1, 3: -1}
    match = spark.createDataFrame([(1, "kaya", -179.9998, 5.0)], "pos int, mname string, mlon double, mlat double")
    got = distance_match(df, "id", "name", ("lon", "lat"), match, "mname", ("mlon", "mlat"), "pos", ["mname"], 250)
    assert {r["id"]: r["name_match_result"] for r in got.collect()} == {1: "YES", 2: "YES", 3: "NO"}
