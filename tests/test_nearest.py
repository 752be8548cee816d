"""Nearest polygons against measuring all of them, and how few are measured."""

import random

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import nearest, skew, spatial
from atlasweave.operators.skew import joined_by_key


def ring(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def boundaries(spark, rows):
    return spark.createDataFrame(rows, "bid long, name string, ring array<struct<x:double,y:double>>")


def brute(points, polygons, metres):
    """By the native distance of all pairs, on either side of the meridian."""
    met = points.crossJoin(polygons).withColumn("turn", F.explode(F.array(F.lit(-360.0), F.lit(0.0), F.lit(360.0))))
    met = met.withColumn("d", spatial.polygon_distance(F.col("lon") + F.col("turn"), F.col("lat"), F.array("ring"))).filter(F.col("d") <= metres)
    return {r["k"]: (r["s"]["bid"], r["s"]["d"]) for r in met.groupBy("k").agg(F.min_by(F.struct("bid", "d"), F.struct(F.round("d", 6), "bid")).alias("s")).collect()}


@pytest.mark.parametrize(("polygons", "metres"), [(nearest.POLYGONS, 300_000), (7, 300_000), (7, 20_000)])
def test_equal_to_measuring_all(spark, monkeypatch, polygons, metres):
    monkeypatch.setattr(nearest, "POLYGONS", polygons)
    monkeypatch.setattr(nearest, "SPOTS", 40)
    monkeypatch.setattr(nearest, "TOGETHER", 4)
    r = random.Random(polygons)
    rows = [(i, f"n{i}", ring(r.uniform(-4, 4), r.uniform(48, 52), r.uniform(0, 0.7), r.uniform(0, 0.7))) for i in range(90)]
    rows += [(100 + i, "m", ring(x, r.uniform(-1, 1), 0.2, 0.2)) for i, x in enumerate((179.7, 179.8, -180.0, -179.9, -179.5))]
    rows += [(200, "same", rows[0][2]), (201, "empty", []), (202, None, None)]
    points = [(i, r.uniform(-5, 5), r.uniform(47, 53)) for i in range(150)] + [(200 + i, r.choice((1, -1)) * r.uniform(179.4, 180), r.uniform(-1.5, 1.5)) for i in range(60)]
    points += [(300 + i, *points[3][1:]) for i in range(50)] + [(400, None, 1.0), (401, float("nan"), 50.0)]
    p = spark.createDataFrame(points, "k long, lon double, lat double").selectExpr("*", "'x' AS d", "'t' AS tile")
    b = boundaries(spark, rows)
    got = {x["k"]: (x["bid"], x["m"]) for x in spatial.nearest_polygon(p, "k", "lon", "lat", b, "ring", "bid", metres, "m").collect()}
    want = brute(p.drop("d").filter("lon is not null and not isnan(lon)"), b, metres)
    assert len(got) == len(points)
    assert {k for k, v in got.items() if v[0] is not None} == set(want)
    for k, (bid, d) in want.items():
        assert got[k] == (bid, pytest.approx(d, abs=1e-6))


def test_both_sides_of_the_meridian(spark):
    b = boundaries(spark, [(1, "east", ring(-180.0, -1.0, 1.0, 2.0)), (2, "west", ring(179.0, 5.0, 1.0, 1.0))])
    p = spark.createDataFrame([(1, 179.9999, 0.0), (2, -179.9999, 5.5), (3, -179.9999, 0.0), (4, 179.0, 0.0)], "k long, lon double, lat double")
    got = {r["k"]: (r["bid"], r["d"]) for r in spatial.nearest_polygon(p, "k", "lon", "lat", b, "ring", "bid", 250, "d").collect()}
    assert got[1] == (1, pytest.approx(11.12, abs=0.01))
    assert got[2][0] == 2 and got[3] == (1, 0.0) and got[4] == (None, None)


def test_few_polygons_are_measured(spark):
    """200,000 small polygons within 100 km of 1,000 points, some in their midst, some beside them."""
    boxes = spark.range(200_000).selectExpr("id AS __pid", "10 + (id % 500) * 0.002 AS x", "50 + floor(id / 500) * 0.002 AS y")
    corner = lambda a, b: F.struct((F.col("x") + a).alias("x"), (F.col("y") + b).alias("y"))
    table = boxes.select("__pid", F.array(corner(0, 0), corner(0.0005, 0), corner(0.0005, 0.0005), corner(0, 0.0005)).alias("ring"))
    points = spark.range(1_000).selectExpr("id", "9.5 + pmod(id * 7919, 1000) * 0.002 AS lon", "49.6 + pmod(id * 104729, 1000) * 0.0016 AS lat")
    boxed = nearest._boxed(table, "__pid", "__pid", "ring")
    found = nearest.nearest_candidates(points, boxed, nearest.tile_count(boxed), 100_000).groupBy("lon", "lat").agg(F.sum("measured").alias("n"), F.count("pid").alias("c"))
    asked, most, mean, some = found.agg(F.count("*"), F.max("n"), F.avg("n"), F.min("c")).first()
    assert asked == 1_000 and some > 0
    print("polygons measured a point: mean", mean, "most", most)
    assert mean < 10 and most < 100


def test_no_polygons_or_points(spark):
    b, p = boundaries(spark, [(1, "a", ring(0.0, 0.0, 1.0, 1.0))]), spark.createDataFrame([(1, 0.5, 0.5)], "k long, lon double, lat double")
    assert [(r["bid"], r["d"]) for r in spatial.nearest_polygon(p, "k", "lon", "lat", b.limit(0), "ring", "bid", 250, "d").collect()] == [(None, None)]
    assert spatial.nearest_polygon(p.limit(0), "k", "lon", "lat", b, "ring", "bid", 250, "d").count() == 0


def test_frequent_and_null_keys_stay_where_they_are(spark, monkeypatch):
    """Nine tenths of the rows have one key, or none: the shuffled rest has neither."""
    monkeypatch.setattr(skew, "LEAST_HOT", 100)
    rows = [(i, " " if i % 10 < 5 else None if i % 10 < 9 else f"k{i % 40}", i % 3) for i in range(2_000)]
    df = spark.createDataFrame(rows, "i long, k string, `a b` long")
    table = spark.createDataFrame([(f"k{i}", j, i * j) for i in range(40) for j in range(3) if i % 4] + [(" ", 1, 7), (None, 2, 8)], "t string, u long, v long")
    got = sorted((r["i"], r["t"], r["v"]) for r in joined_by_key(df, table, {"k": "t", "a b": "u"}).collect())
    values = {(t, u): v for t, u, v in ((r["t"], r["u"], r["v"]) for r in table.collect()) if t is not None}
    assert got == sorted((i, k if (k, a) in values else None, values.get((k, a))) for i, k, a in rows)
    plan = joined_by_key(df, table, {"k": "t", "a b": "u"})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") >= 1
    sized = table.withColumn("rows", F.when(F.col("t") == " ", 400).otherwise(5))
    told = joined_by_key(df, sized, {"k": "t", "a b": "u"}, "rows")
    assert told.columns == ["i", "k", "a b", "t", "u", "v"]
    assert sorted((r["i"], r["t"], r["v"]) for r in told.collect()) == got
    monkeypatch.setattr(skew, "LEAST_HOT", 1_000_000)
    assert sorted((r["i"], r["t"], r["v"]) for r in joined_by_key(df, table, {"k": "t", "a b": "u"}).collect()) == got
