"""Distances and grid cells as native expressions; points are two double columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance, unrounded."""
    f1, f2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((f2 - f1) / 2), F.lit(2.0)) + F.cos(f1) * F.cos(f2) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), F.lit(2.0))
    # not least(), which would pass over a null
    return F.lit(2 * EARTH_KM) * F.asin(F.when(a > 1, F.lit(1.0)).otherwise(F.sqrt(a)))


def rounded_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance to two decimals, halves to even."""
    return F.rint(haversine_km(lon1, lat1, lon2, lat2) * 100) / 100


def cell_degrees(metres: float) -> float:
    """Latitude degrees of a cell no smaller than ``metres``, with a little to spare."""
    return max(metres, 0.01) / 1000 / EARTH_KM * 180 / math.pi * 1.0001


def cell_row(lat: Column, metres: float) -> Column:
    return F.floor(lat / cell_degrees(metres)).cast("long")


def cell_columns(row: Column, metres: float) -> Column:
    """How many equal columns a row of cells has around the globe: at the row's edge that is nearer to
    the pole, where they are narrowest, none is narrower, straight through, than a cell is high. One
    near the poles, where any two longitudes may be close."""
    step = cell_degrees(metres)
    edge = F.radians(F.least(F.lit(90.0), F.greatest(F.abs(row * step), F.abs((row + 1) * step))))
    most = F.floor(360 * F.cos(edge) / step).cast("long")
    # an arc is longer than its chord: two columns fewer make up for it
    return F.when(most < 8, F.lit(1).cast("long")).otherwise(most - 2)


def cell_column(lon: Column, row: Column, metres: float) -> Column:
    """Column of a longitude in a row of cells, counted eastward from the 180th meridian."""
    count = cell_columns(row, metres)
    around = F.pmod(lon + 180, F.lit(360.0))
    return F.least(F.floor(around / 360 * count).cast("long"), count - 1)


def coordinate(c: Column) -> Column:
    """A coordinate as double: text with "null" in it, blanks, NaN and infinities are null."""
    text = c.cast("string")
    value = F.when(text.rlike("(?i)null") | (F.trim(text) == ""), F.lit(None)).otherwise(text.try_cast("double"))
    return F.when(finite(value), value)


def finite(c: Column) -> Column:
    """Whether a number is one: NaN is above all others."""
    return F.abs(c) < F.lit(math.inf)


def is_point(lon: Column, lat: Column) -> Column:
    """Whether both coordinates are there and are numbers."""
    return F.coalesce(finite(lon) & finite(lat), F.lit(False))


def azimuthal_equidistant(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Metres east and north in the world azimuthal equidistant projection about (0, 0), on the sphere."""
    f, turn = F.radians(lat), F.radians(lon)
    c = F.acos(F.cos(f) * F.cos(turn))
    k = F.when(c == 0, F.lit(1.0)).otherwise(c / F.sin(c)) * (EARTH_KM * 1000)
    return k * F.cos(f) * F.sin(turn), k * F.sin(f)


def equidistant_conic(lon: Column, lat: Column, lat1: float = 20.0, lat2: float = -23.0, lat0: float = 0.0, lon0: float = 25.0) -> tuple[Column, Column]:
    """Metres east and north in an equidistant conic projection on the sphere; Africa's parallels by default."""
    p1, p2, p0 = (math.radians(x) for x in (lat1, lat2, lat0))
    n = (math.cos(p1) - math.cos(p2)) / (p2 - p1)
    g = math.cos(p1) / n + p1
    rho, theta = F.lit(g) - F.radians(lat), F.lit(n) * (F.radians(lon) - math.radians(lon0))
    r = EARTH_KM * 1000
    return F.lit(r) * rho * F.sin(theta), F.lit(r) * (F.lit(g - p0) - rho * F.cos(theta))
