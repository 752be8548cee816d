"""The nearest polygon of each point by branch and bound over packed boxes.

Polygons are dealt into tiles along a curve through their boxes' centres. The boxes of the tiles, a bounded
number of them, are known to all tasks. A point asks the tile whose box is nearest, and then, with the
distance found there as a bound, those tiles alone whose boxes are no farther. Within a tile polygons
are measured in the order of their boxes' distances until the next box is farther than the best polygon.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from atlasweave.functions import geo
from atlasweave.functions.ids import fresh_names
from atlasweave.operators.skew import joined_by_key
from atlasweave.session import spread, stored

METRES_PER_DEGREE = geo.EARTH_KM * 1000 * math.pi / 180
#: Polygons, and corners of polygons, of a tile on average; more only where there would be over TILES tiles.
POLYGONS, CORNERS, TILES = 2_000, 200_000, 20_000
#: Points that a task asks one tile about.
SPOTS = 50_000
#: Tiles that have a box together.
TOGETHER = 128


def polygon_rings(df: DataFrame, column: str) -> Column:
    """All rings of a polygon column as one array of rings: the column is one exterior ring (an array
    of struct x, y), an array of rings, or an array of parts that are each an array of rings."""
    depth, kind = 0, df.schema[column].dataType
    while isinstance(kind, ArrayType):
        depth, kind = depth + 1, kind.elementType
    if depth not in (1, 2, 3):
        raise ValueError(f"{column} is no ring, array of rings or array of parts")
    return (F.array(F.col(column)), F.col(column), F.flatten(column))[depth - 1]


class Boxes:
    """Boxes in longitude and latitude, consecutive ones near each other."""

    def __init__(self, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray):
        self.sides, self.together = np.stack([x0, y0, x1, y1]), TOGETHER
        starts = np.arange(0, len(x0), self.together)
        reduced = [op.reduceat(side, starts) for op, side in zip((np.minimum, np.minimum, np.maximum, np.maximum), self.sides, strict=True)] if len(x0) else self.sides
        self.outer = np.stack(list(reduced))

    @staticmethod
    def away(sides: np.ndarray, lon: float, lat: float) -> np.ndarray:
        """Metres from a point to boxes, straight or across the 180th meridian, flat around the point."""
        x0, y0, x1, y1 = sides
        aside = np.maximum(0.0, np.maximum(x0 - lon, lon - x1))
        for turned in (lon - 360, lon + 360):
            aside = np.minimum(aside, np.maximum(0.0, np.maximum(x0 - turned, turned - x1)))
        up = np.maximum(0.0, np.maximum(y0 - lat, lat - y1))
        return np.hypot(aside * (math.cos(math.radians(lat)) * METRES_PER_DEGREE), up * METRES_PER_DEGREE)

    def within(self, lon: float, lat: float, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """Boxes no farther than ``bound``, nearest first, and their distances."""
        outer = np.flatnonzero(self.away(self.outer, lon, lat) <= bound)
        own = (outer[:, None] * self.together + np.arange(self.together)).ravel()
        own = own[own < self.sides.shape[1]]
        d = self.away(self.sides[:, own], lon, lat)
        near = d <= bound
        own, d = own[near], d[near]
        order = np.argsort(d, kind="stable")
        return own[order], d[order]

    def nearest(self, lon: float, lat: float, bound: float) -> int:
        """The first of the nearest boxes no farther than ``bound``, -1 if there is none."""
        outer = self.away(self.outer, lon, lat)
        best, at = bound, -1
        for k in np.argsort(outer, kind="stable").tolist():
            if outer[k] > best or (outer[k] == best and at >= 0):
                break
            d = self.away(self.sides[:, k * self.together : (k + 1) * self.together], lon, lat)
            i = int(d.argmin())
            if d[i] < best or (at < 0 and d[i] <= best):
                best, at = float(d[i]), k * self.together + i
        return at


def edge_distance(lon: float, lat: float, ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray) -> float:
    """Metres from a point to a polygon given by its edges, 0 inside (even-odd), flat around the point."""
    between = (ay > lat) != (by > lat)
    i = np.flatnonzero(between)
    if np.count_nonzero(lon < (bx[i] - ax[i]) * (lat - ay[i]) / (by[i] - ay[i]) + ax[i]) % 2:
        return 0.0
    across = math.cos(math.radians(lat)) * METRES_PER_DEGREE
    px, py = (ax - lon) * across, (ay - lat) * METRES_PER_DEGREE
    dx, dy = (bx - ax) * across, (by - ay) * METRES_PER_DEGREE
    length = dx * dx + dy * dy
    t = np.clip(-(px * dx + py * dy) / np.where(length == 0, 1.0, length), 0.0, 1.0)
    x, y = px + t * dx, py + t * dy
    return float(np.sqrt((x * x + y * y).min()))


class Tile:
    """Polygons with their boxes, in the order that decides between equals."""

    def __init__(self, polygons: pd.DataFrame):
        polygons = polygons.sort_values(["rank", "pid"], na_position="first")
        self.boxes = np.stack([polygons[c].to_numpy(float) for c in ("x0", "y0", "x1", "y1")])
        self.edges = [tuple(np.asarray(x, float) for x in e) for e in zip(*[polygons[c] for c in ("ax", "ay", "bx", "by")], strict=True)]
        self.middle, self.pids, self.ranks = (self.boxes[0] + self.boxes[2]) / 2, polygons["pid"].tolist(), polygons["rank"].tolist()

    def nearest(self, lon: float, lat: float, bound: float) -> tuple[int, float, int]:
        """Place of the nearest polygon no farther than ``bound`` (-1: none), its distance, and how many were measured."""
        away = Boxes.away(self.boxes, lon, lat)
        best, at, measured = bound, -1, 0
        near = np.flatnonzero(away <= bound)
        for i in near[np.argsort(away[near], kind="stable")].tolist():
            if away[i] > best:
                break
            turned = lon + 360 * round((self.middle[i] - lon) / 360)
            d = edge_distance(turned, lat, *self.edges[i])
            measured += 1
            if d < best or (d == best and (at < 0 or i < at)):
                best, at = d, i
        return at, best, measured


def _meet(spots: pd.DataFrame, polygons: pd.DataFrame) -> pd.DataFrame:
    """The best polygon of a tile for each spot, no farther than its ``d``. A spot without one keeps its bound
    and has no pid."""
    tile, rows = Tile(polygons), []
    for lon, lat, name, bound in zip(*[spots[c].tolist() for c in ("lon", "lat", "tile", "d")], strict=True):
        at, best, measured = tile.nearest(lon, lat, bound)
        rows.append((lon, lat, name, tile.pids[at] if at >= 0 else None, tile.ranks[at] if at >= 0 else None, best, measured))
    out = pd.DataFrame(rows, columns=["lon", "lat", "tile", "pid", "rank", "d", "measured"])
    return out.astype({"pid": "Int64"})


def _asked(spots: DataFrame, tiles: DataFrame) -> DataFrame:
    """Spots (lon, lat, tile, d) met with the polygons of their tiles. A tile that many spots ask is copied
    to several tasks."""
    counts = F.broadcast(spots.groupBy("tile").agg(F.ceil(F.count("*") / SPOTS).cast("int").alias("n")))  # one row a tile
    left = spots.join(counts, "tile").withColumn("part", F.pmod(F.xxhash64("lon", "lat"), F.col("n")).cast("int")).drop("n")
    right = tiles.join(counts, "tile").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")
    return left.groupBy("tile", "part").cogroup(right.groupBy("tile", "part")).applyInPandas(_meet, f"lon double, lat double, tile int, pid long, rank {right.schema['rank'].dataType.simpleString()}, d double, measured long")


def _curve(x: Column, y: Column, bits: int = 16) -> Column:
    """Numbers of points along a curve that keeps near ones together."""
    col = F.floor(F.pmod(x + 180, F.lit(360.0)) / 360 * ((1 << bits) - 1)).cast("long")
    row = F.floor((F.greatest(F.lit(-90.0), F.least(F.lit(90.0), y)) + 90) / 180 * ((1 << bits) - 1)).cast("long")
    bit = lambda c, i: F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), 2 * i)
    return sum((bit(col, i) + 2 * bit(row, i) for i in range(bits)), F.lit(0).cast("long"))


def _boxed(numbered: DataFrame, pid: str, order: str, ring: str) -> DataFrame:
    """(pid, rank, edges, box) of each polygon that has a corner."""
    rings = polygon_rings(numbered, ring)
    corners = F.flatten(rings)
    following = lambda r: F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1))
    ends = F.flatten(F.transform(rings, following))
    of = lambda points, axis: F.transform(points, lambda p: p[axis].cast("double"))
    boxed = numbered.select(F.col(pid).alias("pid"), F.col(order).alias("rank"), of(corners, "x").alias("ax"), of(corners, "y").alias("ay"), of(ends, "x").alias("bx"), of(ends, "y").alias("by")).filter(F.size("ax") > 0)
    return boxed.select("*", F.array_min("ax").alias("x0"), F.array_min("ay").alias("y0"), F.array_max("ax").alias("x1"), F.array_max("ay").alias("y1"))


def tile_count(boxed: DataFrame) -> int:
    """How many tiles the polygons are dealt into."""
    polygons, corners = boxed.agg(F.count("*"), F.coalesce(F.sum(F.size("ax")), F.lit(0))).first()
    return min(TILES, max(1, math.ceil(polygons / POLYGONS), math.ceil(corners / CORNERS)))


def nearest_candidates(spots: DataFrame, boxed: DataFrame, n: int, metres: float) -> DataFrame:
    """(lon, lat, tile, pid, rank, d, measured): the best polygon of every one of ``n`` tiles that each of the distinct
    ``spots(lon, lat)`` had to ask, with how many polygons were measured there."""
    placed = boxed.withColumn("curve", _curve((F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2))
    tiles = stored(placed.repartitionByRange(n, "curve", "pid").withColumn("tile", F.spark_partition_id()).drop("curve"))
    listed = sorted(map(tuple, tiles.groupBy("tile").agg(F.min("x0"), F.min("y0"), F.max("x1"), F.max("y1")).collect()))  # at most TILES rows
    names = np.array([r[0] for r in listed], np.int32)
    boxes = Boxes(*[np.array([r[k] for r in listed], float) for k in (1, 2, 3, 4)])
    shared = spots.sparkSession.sparkContext.broadcast((names, boxes))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, boxes = shared.value
        for batch in batches:
            lon, lat = (batch.column(i).to_numpy() for i in (0, 1))
            at = np.array([boxes.nearest(x, y, metres) for x, y in zip(lon.tolist(), lat.tolist(), strict=True)], np.int64)
            own = np.flatnonzero(at >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(lon[own]), pa.array(lat[own]), pa.array(names[at[own]]), pa.array(np.full(len(own), float(metres)))], ["lon", "lat", "tile", "d"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, boxes = shared.value
        for batch in batches:
            rows = []
            for lon, lat, tile, bound in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                rows += [(lon, lat, t, bound) for t in names[boxes.within(lon, lat, bound)[0]].tolist() if t != tile]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, (pa.float64(), pa.float64(), pa.int32(), pa.float64()), strict=True)], ["lon", "lat", "tile", "d"])

    schema = "lon double, lat double, tile int, d double"
    found = stored(_asked(stored(spots.select(F.col("lon").cast("double"), F.col("lat").cast("double")).mapInArrow(first, schema)), tiles))
    more = stored(found.select("lon", "lat", "tile", "d").mapInArrow(others, schema))
    return found.unionByName(_asked(more, tiles))


def nearest_polygon(points: DataFrame, row_id: str, lon: str, lat: str, polygons: DataFrame, ring: str, order: str, metres: float, out: str) -> DataFrame:
    """``points`` with the nearest polygon's columns (none of them named as the points') within
    ``metres`` and the distance ``out``; null if none is; of equals the first by ``order``.

    ``ring`` is any column that :func:`polygon_rings` takes. Distances are flat around the point, across the
    180th meridian as well; polygons without a corner and rows without a point (null, NaN) meet nothing.
    Polygons that fill one tile, of bounded size, are broadcast, and points are dealt over all cores; else
    points at one spot ask once.
    """
    x, y, d, best, pid, named = fresh_names([*points.columns, *polygons.columns, out], 6)
    numbered = stored(polygons.withColumn(pid, F.monotonically_increasing_id()))
    boxed = _boxed(numbered, pid, order, ring)
    n = tile_count(boxed)
    there = geo.is_point(F.col(lon), F.col(lat))
    parts = numbered.select(pid, F.struct(*[F.col(f"`{c}`") for c in polygons.columns]).alias(named))
    if n == 1:
        shared = points.sparkSession.sparkContext.broadcast(boxed.toPandas())  # POLYGONS rows and CORNERS corners at most

        @F.pandas_udf("struct<d:double,pid:long>")
        def nearest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            tile = Tile(shared.value)
            for lons, lats in batches:
                rows = [(-1, 0.0, 0) if math.isnan(a) else tile.nearest(a, b, metres) for a, b in zip(lons.tolist(), lats.tolist(), strict=True)]
                yield pd.DataFrame({"d": [r[1] if r[0] >= 0 else None for r in rows], "pid": pd.array([tile.pids[r[0]] if r[0] >= 0 else None for r in rows], "Int64")})

        place = lambda c: F.when(there, F.col(c).cast("double"))
        asked = spread(points).withColumn(best, nearest(place(lon), place(lat))).withColumns({d: F.col(f"{best}.d"), best: F.col(f"{best}.pid")})
        made = asked.join(F.broadcast(parts), F.col(best) == F.col(pid), "left")
    else:
        spots = points.filter(there).select(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat")).groupBy("lon", "lat").agg(F.count("*").alias("rows"))
        spots = stored(spots)
        met = nearest_candidates(spots, boxed, n, metres).filter("pid is not null")
        least = met.groupBy("lon", "lat").agg(F.min_by(F.struct("d", "pid"), F.struct("d", "rank", "pid")).alias("s"))
        size = fresh_names([x, y, d, best, pid, named, *points.columns], 1)[0]
        known = stored(least.join(spots, ["lon", "lat"]).select(F.col("lon").alias(x), F.col("lat").alias(y), F.col("s.d").alias(d), F.col("s.pid").alias(best), F.col("rows").alias(size)))
        asked = joined_by_key(points, known, {lon: x, lat: y}, size)
        counted = known.groupBy(F.col(best).alias(pid)).agg(F.sum(size).alias(size))
        made = joined_by_key(asked, stored(parts.join(counted, pid)), {best: pid}, size)
    return made.select(*[F.col(f"`{c}`") for c in points.columns], *[F.col(named).getField(c).alias(c) for c in polygons.columns], F.col(d).alias(out))
