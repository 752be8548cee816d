"""Districts of several parts with holes, from well-known binary."""

import struct

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import spatial
from atlasweave.sources.tables import load_polygons, polygon_parts


def box(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def polygon(rings, end="<", z=False):
    out = struct.pack(f"{end}BII", end == "<", 1003 if z else 3, len(rings))
    for ring in rings:
        out += struct.pack(f"{end}I", len(ring)) + b"".join(struct.pack(f"{end}{3 if z else 2}d", *p, *([7.0] if z else [])) for p in ring)
    return out


PARTS = [[box(0.0, 0.0, 1.0), box(0.4, 0.4, 0.2)], [box(3.0, 0.0, 1.0)]]
WKB = struct.pack("<BII", 1, 6, 2) + polygon(PARTS[0]) + polygon(PARTS[1], ">", True)


def test_parts_and_holes(spark, tmp_path):
    assert polygon_parts(WKB) == PARTS
    assert polygon_parts(struct.pack("<BIdd", 1, 1, 0.0, 0.0)) is None
    made = spark.createDataFrame([(1, "North", bytearray(WKB))], "bid long, nm string, geometry binary")
    made.write.parquet(f"{tmp_path}/layer.parquet")
    boundary = load_polygons(spark, f"{tmp_path}/layer.parquet")
    # in a part, in the hole, in the other part, between the parts
    points = spark.createDataFrame([(1, 0.2, 0.2), (2, 0.5, 0.5), (3, 3.5, 0.5), (4, 1.1, 0.5)], "k long, lon double, lat double")
    near = {r["k"]: (r["bid"], r["d"]) for r in spatial.nearest_polygon(points, "k", "lon", "lat", boundary, "ring", "bid", 20_000, "d").collect()}
    step = 0.1 * spatial.METRES_PER_DEGREE
    assert near[1] == near[3] == (1, 0.0)
    assert near[2] == (1, pytest.approx(step, rel=1e-3))
    assert near[4] == (1, pytest.approx(step, rel=1e-3))
    own = points.withColumn("own", F.lit("North"))
    rows = spark.createDataFrame([(1, "North", bytearray(polygon(PARTS[0]))), (2, "North", bytearray(polygon(PARTS[1])))], "bid long, nm string, geometry binary")
    rows.write.parquet(f"{tmp_path}/rows.parquet")
    for table in (boundary, load_polygons(spark, f"{tmp_path}/rows.parquet")):  # parts in one row, or a row each
        km = {r["k"]: r["km"] for r in spatial.border_distance(own, "lon", "lat", "own", F.lit(True), table, "ring", "bid", "nm", "km").collect()}
        assert km[2] == pytest.approx(0.02**0.5 * 111.195, rel=1e-2)  # a corner of the hole
        assert km[3] == pytest.approx(0.5**0.5 * 111.195, rel=1e-2)  # a corner of the second part
