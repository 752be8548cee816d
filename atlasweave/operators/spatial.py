"""Distance joins, nearest polygons, clusters and boundary checks over grid cells.

No join compares all points: both sides are put into cells no smaller than the radius, one side
also into the neighbouring cells, and only points that share a cell are measured. Tasks are cut by
how many pairs they measure, since few bytes may make many pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.functions import geo
from atlasweave.functions.ids import fresh_names
from atlasweave.functions.similarity import pair_measure
from atlasweave.functions.text import preclean
from atlasweave.operators.density import density_clusters
from atlasweave.operators.nearest import METRES_PER_DEGREE, SPOTS, nearest_polygon, polygon_rings
from atlasweave.operators.skew import joined_by_key
from atlasweave.session import spread, stored

#: Pairs of points that a task measures, and most tasks of a join.
PAIRS, TASKS = 5_000_000, 20_000


def _cells(df: DataFrame, lon: str, lat: str, metres: float, around: bool) -> DataFrame:
    row = geo.cell_row(F.col(lat), metres)
    if not around:
        return df.withColumn("__row", row).withColumn("__col", geo.cell_column(F.col(lon), F.col("__row"), metres))
    rows = df.withColumn("__row", F.explode(F.array(row - 1, row, row + 1)))
    column, count = geo.cell_column(F.col(lon), F.col("__row"), metres), geo.cell_columns(F.col("__row"), metres)
    # the neighbours of the first column are the second and, across the 180th meridian, the last
    return rows.withColumn("__col", F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(column + d, count)))))


def near_pairs(left: DataFrame, right: DataFrame, metres: float, left_point: tuple[str, str], right_point: tuple[str, str], out: str = "dist_km") -> DataFrame:
    """All pairs within ``metres`` (points are (long, lat) columns; the tables share no column name),
    with the unrounded distance in km. Rows without a point (null, NaN) pair with nothing."""
    pairs, key = keyed_pairs(left, right, metres, left_point, right_point, out)
    return pairs.drop(*key)


def keyed_pairs(left: DataFrame, right: DataFrame, metres: float, left_point: tuple[str, str], right_point: tuple[str, str], out: str = "dist_km", most_pairs: int | None = None) -> tuple[DataFrame, list[str]]:
    """:func:`near_pairs` with the columns by which its tasks are cut. All pairs of a left row have the same values of
    these, so groups of such a row that are made with them need no shuffle of pairs."""
    bar = PAIRS if most_pairs is None else most_pairs
    a = _cells(left.filter(geo.is_point(*map(F.col, left_point))), *left_point, metres, False)
    b = _cells(right.filter(geo.is_point(*map(F.col, right_point))), *right_point, metres, True)
    na, nb = (t.groupBy("__row", "__col").agg(F.count("*").alias(n)) for t, n in ((a, "__na"), (b, "__nb")))
    met = stored(na.join(nb, ["__row", "__col"]).select("__row", "__col", (F.col("__na") * F.col("__nb")).alias("__n")))
    total, most = met.agg(F.sum(F.col("__n").cast("double")), F.max("__n")).first()
    tasks, key = min(TASKS, max(1, math.ceil((total or 0) / bar))), ["__row", "__col"]
    if (most or 0) > bar:  # rows of crowded cells are dealt, the others copied to each part
        parts = met.select("__row", "__col", F.ceil(F.col("__n") / bar).cast("int").alias("__parts"))
        a = a.join(parts, key).withColumn("__part", F.pmod(F.monotonically_increasing_id(), F.col("__parts")).cast("int")).drop("__parts")
        b = b.join(parts, key).withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__parts") - 1))).drop("__parts")
        key = [*key, "__part"]
    pairs = a.repartition(tasks, *key).join(b.repartition(tasks, *key), key).withColumn(out, geo.haversine_km(F.col(left_point[0]), F.col(left_point[1]), F.col(right_point[0]), F.col(right_point[1])))
    return pairs.filter(F.col(out) * 1000 <= metres), key


def clusters(df: DataFrame, row_id: str, lon: str, lat: str, metres: float, out: str | None = None, min_samples: int = 2) -> DataFrame:
    """``df`` with the density cluster of each row: see :func:`density.density_clusters`."""
    return density_clusters(df, row_id, lon, lat, metres, out or f"geo_dbscan_r{int(metres)}_cluster_id", min_samples)


def overlaps(df: DataFrame, row_id: str, name: str, lon: str, lat: str, metres: float = 1.0, out: str = "is_overlap") -> DataFrame:
    """YES on rows whose cluster has two rows at least and more than one value of ``name`` (null is one)."""
    c, of, mixed, n = fresh_names([*df.columns, out], 4)
    made = stored(clusters(df, row_id, lon, lat, metres, c))
    value = F.coalesce(F.concat(F.lit("="), F.col(name).cast("string")), F.lit(""))
    # two values are told from one by the least and the greatest
    kinds = made.filter(F.col(c) > 0).groupBy(F.col(c).alias(of)).agg((F.min(value) < F.max(value)).alias(mixed), F.count("*").alias(n))
    flagged = joined_by_key(made, stored(kinds), {c: of}, n)
    return flagged.withColumn(out, F.when(F.col(mixed), "YES").otherwise("NO")).drop(c, of, mixed)


def ring_distance(lon: Column, lat: Column, ring: Column) -> Column:
    """Metres from a point to a polygon given by its exterior ring (array of struct x, y), 0 inside;
    flat metres around the point."""
    return polygon_distance(lon, lat, F.array(ring))


def polygon_distance(lon: Column, lat: Column, rings: Column) -> Column:
    """Metres from a point to a polygon given by the rings of all its parts, exterior ones and holes,
    0 inside; flat metres around the point. A point is inside if it is in an odd number of rings."""
    across = F.cos(F.radians(lat)) * METRES_PER_DEGREE

    def span(e: Column) -> Column:
        a, b = e["a"], e["b"]
        ax, ay = (a["x"] - lon) * across, (a["y"] - lat) * METRES_PER_DEGREE
        dx, dy = (b["x"] - a["x"]) * across, (b["y"] - a["y"]) * METRES_PER_DEGREE
        length = dx * dx + dy * dy
        t = F.when(length == 0, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), -(ax * dx + ay * dy) / length)))
        x, y = ax + t * dx, ay + t * dy
        return F.sqrt(x * x + y * y)

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        between = (a["y"] > lat) != (b["y"] > lat)
        return between & (lon < (b["x"] - a["x"]) * (lat - a["y"]) / F.when(between, b["y"] - a["y"]).otherwise(F.lit(1.0)) + a["x"])

    def of_ring(ring: Column) -> Column:
        following = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
        return F.zip_with(ring, following, lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    edges = F.flatten(F.transform(rings, of_ring))
    inside = F.size(F.filter(edges, crosses)) % 2 == 1
    return F.when(inside, F.lit(0.0)).otherwise(F.array_min(F.transform(edges, span)))


def check_by_admin(points: DataFrame, row_id: str, lon: str, lat: str, name: str, boundary: DataFrame, ring: str, order: str, boundary_name: str, prefix: str, metres: float = 250.0) -> DataFrame:
    """Adds ``<prefix>_clean``, ``dist_to_<prefix>`` and ``<prefix>Match``: YES if the nearest
    boundary's name is close to the row's, NO otherwise, also if either is missing."""
    own = boundary.select(F.col(boundary_name).alias("__b_name"), F.col(ring).alias("__b_ring"), F.col(order).alias("__b_order"))
    near = nearest_polygon(points, row_id, lon, lat, own, "__b_ring", "__b_order", metres, f"dist_to_{prefix}")
    near = near.withColumn(f"{prefix}_clean", F.when(F.col("__b_name").isNotNull(), preclean(F.col("__b_name"))))
    # several steps read it: polygons are looked for once
    near = stored(near.drop("__b_ring"))
    # the measures run once for each pair of names, not for each row
    pairs = near.select(F.col(name).alias("__a"), F.col(f"{prefix}_clean").alias("__c")).filter("__a <> '' and __c <> ''").distinct()
    scored = pairs.withColumn("__yes", (pair_measure("seq_ratio")("__a", "__c") >= 75) | (pair_measure("seq_token_set_ratio")("__a", "__c") >= 98))
    joined = joined_by_key(near, stored(scored), {name: "__a", f"{prefix}_clean": "__c"})
    return joined.withColumn(f"{prefix}Match", F.when(F.col("__yes"), "YES").otherwise("NO")).drop("__a", "__c", "__yes", "__b_name", "__b_order")


def check_by_settlement(points: DataFrame, row_id: str, lon: str, lat: str, settlements: DataFrame, ring: str, order: str, kind: str, metres: float = 100_000.0, outside: float = 250.0) -> DataFrame:
    """Adds settlement_type and dist_to_settlement_type: the nearest settlement's type, "Out of a
    settlement" from ``outside`` metres on or if there is none within ``metres``."""
    own = settlements.select(F.col(kind).alias("__s_kind"), F.col(ring).alias("__s_ring"), F.col(order).alias("__s_order"))
    near = nearest_polygon(points, row_id, lon, lat, own, "__s_ring", "__s_order", metres, "dist_to_settlement_type")
    out = F.when(F.col("dist_to_settlement_type").isNull() | (F.col("dist_to_settlement_type") >= outside), "Out of a settlement").otherwise(F.col("__s_kind"))
    return near.withColumn("settlement_type", out).drop("__s_kind", "__s_ring", "__s_order")


def border_distance(points: DataFrame, lon: str, lat: str, name: str, asked: Column, boundary: DataFrame, ring: str, order: str, boundary_name: str, out: str) -> DataFrame:
    """Km from each point for which ``asked`` holds to the nearest vertex of the boundary of its own
    ``name``, with all its parts and holes (rows of one clean name are parts, taken by ``order``);
    nearest in degrees, of equals the first. Null elsewhere.

    Vertices stay apart from the rows: different spots of a name meet its vertices once, in parts of bounded
    size if they are many, and rows get the vertex found.
    """
    x, y = F.col(lon), F.col(lat)
    own, px, py, n, k, vx, vy = fresh_names([*points.columns, out], 7)
    where = asked & geo.is_point(x, y) & (x != 0) & (y != 0)
    keyed = points.withColumns({own: F.when(where, F.col(name)), px: x.cast("double"), py: y.cast("double")})
    spots = keyed.filter(F.col(own).isNotNull()).groupBy(F.col(own).alias("name"), F.col(px).alias("lon"), F.col(py).alias("lat")).agg(F.count("*").alias("n"))
    spots = stored(spots)
    axis = lambda a: F.transform(F.flatten(polygon_rings(boundary, ring)), lambda p: p[a].cast("double"))
    clean = boundary.select(preclean(F.col(boundary_name)).alias("name"), axis("x").alias("x"), axis("y").alias("y"), F.col(order).alias("o")).filter("x is not null")
    counts = spots.groupBy("name").agg(F.ceil(F.count("*") / SPOTS).cast("int").alias("c"))
    left = spots.join(counts, "name").withColumn("part", F.pmod(F.xxhash64("lon", "lat"), F.col("c")).cast("int")).drop("c")
    right = clean.join(counts, "name").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("c") - 1))).drop("c")
    found = left.groupBy("name", "part").cogroup(right.groupBy("name", "part")).applyInPandas(_nearest_vertex, "name string, lon double, lat double, n long, x double, y double")
    made = stored(found.select(F.col("name").alias(k), F.col("lon").alias(f"{k}x"), F.col("lat").alias(f"{k}y"), F.col("n").alias(n), F.col("x").alias(vx), F.col("y").alias(vy)))
    joined = joined_by_key(keyed, made, {own: k, px: f"{k}x", py: f"{k}y"}, n)
    return joined.withColumn(out, geo.rounded_km(x, y, F.col(vx), F.col(vy))).drop(own, px, py, k, f"{k}x", f"{k}y", vx, vy)


def _nearest_vertex(spots: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
    """Each spot of one name with the first of the vertices nearest in degrees. Vertices lie in order of their
    x, and are looked at outward from the spot's until they are farther by that alone."""
    parts = parts.sort_values("o", na_position="first")
    x, y = (np.concatenate([np.zeros(0), *map(np.asarray, parts[c])]).astype(float) for c in ("x", "y"))
    order = np.argsort(x, kind="stable")
    sx, sy, rows = x[order], y[order], []
    for a, b in zip(spots["lon"].tolist(), spots["lat"].tolist(), strict=True):
        reach, at, best = 64, int(np.searchsorted(sx, a)), -1
        while len(sx):
            lo, hi = max(0, at - reach), min(len(sx), at + reach)
            d = (sx[lo:hi] - a) ** 2 + (sy[lo:hi] - b) ** 2
            least = d.min()
            # nothing outside can be as near
            if (lo == 0 or (a - sx[lo]) ** 2 > least) and (hi == len(sx) or (sx[hi - 1] - a) ** 2 > least):
                best = int(order[lo:hi][d == least].min())
                break
            reach *= 4
        rows.append((x[best], y[best]) if best >= 0 else (None, None))
    out = spots[["name", "lon", "lat", "n"]].copy()
    out["x"], out["y"] = [r[0] for r in rows], [r[1] for r in rows]
    return out


def mask_without_location(df: DataFrame, lon: str, lat: str, to_null: tuple[str, ...], to_na: tuple[str, ...], to_minus: tuple[str, ...]) -> DataFrame:
    """Rows at latitude 0 have no location: their point and ``to_null`` become null, ``to_na`` the
    text NA and ``to_minus`` -1."""
    nowhere = F.col(lat).isNull() | (F.col(lat) == 0)
    changes = {c: F.when(nowhere, F.lit(None)).otherwise(F.col(c)) for c in (*to_null, lon, lat)}
    changes |= {c: F.when(nowhere, F.lit("NA")).otherwise(F.col(c)) for c in to_na}
    changes |= {c: F.when(nowhere, F.lit(-1.0)).otherwise(F.col(c)) for c in to_minus}
    return df.withColumns(changes)
