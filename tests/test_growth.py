"""Plans and tasks that don't grow faster than their input."""

import itertools
import math

from pyspark.sql import functions as F

from atlasweave.operators import spatial
from atlasweave.operators.components import components


def test_estimates_stay_small_over_many_joins(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    found = components(edges)
    assert {tuple(r) for r in found.collect()} == {(i, 0) for i in range(301)}
    assert len(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 30


def test_near_pairs_are_cut_by_pairs(spark, monkeypatch):
    monkeypatch.setattr(spatial, "PAIRS", 40)
    left = [(i, 0.0001 * (i % 7), 0.0001 * (i % 5)) for i in range(60)] + [(60, None, 0.0)]
    right = [(i, 0.0002 * (i % 6), 0.0003 * (i % 4)) for i in range(50)] + [(50, 1.0, 1.0)]
    got = spatial.near_pairs(spark.createDataFrame(left, "a long, x double, y double"), spark.createDataFrame(right, "b long, x2 double, y2 double"), 60, ("x", "y"), ("x2", "y2"))
    step = spatial.geo.EARTH_KM * 1000 * math.pi / 180
    want = sorted((a, b) for (a, x, y), (b, x2, y2) in itertools.product(left, right) if x is not None and math.hypot(x - x2, y - y2) * step <= 60)
    assert sorted((r["a"], r["b"]) for r in got.select("a", "b").collect()) == want
    assert got.rdd.getNumPartitions() > 10


def test_rows_of_one_file_are_dealt_to_all_cores(spark):
    from atlasweave.plans.clean import CleanConfig, clean
    from atlasweave.queries import DICTIONARY

    tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
    rows = spark.range(2000, numPartitions=1)
    names = rows.select(F.col("id").alias("k"), F.concat(F.lit("Hopitol "), F.col("id").cast("string")).alias("name"))
    assert tasks(clean(names, CleanConfig("name", "moz", "WHO", "k"), DICTIONARY)) > 4
    points = rows.select(F.col("id").alias("k"), (F.col("id") * 0.001).alias("lon"), F.lit(0.0).alias("lat"), F.lit("Box").alias("own"))
    box = spark.createDataFrame([(1, "Box", [(0.0, -0.1), (1.0, -0.1), (1.0, 0.1), (0.0, 0.1)])], "bid long, nm string, ring array<struct<x:double,y:double>>")
    assert tasks(spatial.check_by_admin(points, "k", "lon", "lat", "own", box, "ring", "bid", "nm", "b").select("bMatch", "k")) > 4


def test_pairs_of_a_row_stay_in_one_task(spark, monkeypatch):
    left = spark.range(80).select(F.col("id").alias("a"), (F.col("id") % 9 * 0.0001).alias("x"), (F.col("id") % 7 * 0.0001).alias("y"))
    right = spark.range(70).select(F.col("id").alias("b"), (F.col("id") % 8 * 0.0001).alias("x2"), (F.col("id") % 5 * 0.0001).alias("y2"))
    pairs, key = spatial.keyed_pairs(left, right, 60, ("x", "y"), ("x2", "y2"), most_pairs=100)
    placed = pairs.withColumn("task", F.spark_partition_id()).groupBy("a").agg(F.countDistinct("task", *key).alias("n"), F.count("*").alias("pairs"))
    assert {r["n"] for r in placed.collect()} == {1}
    assert key[-1] == "__part" and pairs.count() == spatial.near_pairs(left, right, 60, ("x", "y"), ("x2", "y2")).count()
