"""Projections of points on the axes."""

import pytest
from pyspark.sql import functions as F

from atlasweave.functions import geo


def test_axes_and_centre(spark):
    df = spark.createDataFrame([(0.0, 0.0), (1.0, 0.0), (0.0, 1.0)], "lon double, lat double")
    got = [tuple(r) for r in df.select(*geo.azimuthal_equidistant(F.col("lon"), F.col("lat"))).collect()]
    degree = geo.EARTH_KM * 1000 * 3.141592653589793 / 180
    assert got == [(0.0, 0.0), (pytest.approx(degree), pytest.approx(0.0)), (pytest.approx(0.0), pytest.approx(degree))]
