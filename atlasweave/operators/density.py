"""Density clusters (DBSCAN) over a graph of grid cells.

Rows at one spot are folded. Cells are so small that any two spots of one are neighbours: a cell with enough
rows is all core, without a pair, and is one node of the graph, however many spots it has. Spots of
thinner cells are counted against the cells around. Two cells are linked by one pair of core spots
that is close enough; where both have many, that pair is looked for by halving the cells as long as
the bounds of their boxes leave it open, so crowded cells next to each other aren't compared in full.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasweave.functions import geo
from atlasweave.functions.ids import fresh_names
from atlasweave.operators.components import components
from atlasweave.operators.skew import joined_by_key
from atlasweave.operators.tables import with_row_id
from atlasweave.session import stored

#: Pairs of spots of two cells that are compared without halving the cells first.
PAIRS = 10_000
#: Rows and columns of cells within the radius on either side.
REACH = 2


def _step(metres: float) -> float:
    """Degrees of latitude of a cell whose diagonal is under ``metres``."""
    return 0.99 * metres / math.sqrt(2) / 1000 / geo.EARTH_KM * 180 / math.pi


def _row(lat: Column, step: float) -> Column:
    return F.floor(lat / step).cast("long")


def _columns(row: Column, step: float) -> Column:
    """Columns of a row of cells around the globe, none of which is wider, at the edge nearer to the equator,
    than a cell is high."""
    low = F.when((row < 0) & (row + 1 > 0), F.lit(0.0)).otherwise(F.least(F.abs(row * step), F.abs((row + 1) * step)))
    return F.greatest(F.lit(1).cast("long"), F.ceil(360 * F.cos(F.radians(F.least(F.lit(90.0), low))) / step).cast("long"))


def _column(lon: Column, count: Column) -> Column:
    return F.least(F.floor(F.pmod(lon + 180, F.lit(360.0)) / 360 * count).cast("long"), count - 1)


def _around(cells: DataFrame, metres: float, step: float) -> DataFrame:
    """(row, col, row2, col2): every cell that may hold a spot within ``metres`` of one in the cell, itself
    too."""
    wide = cells.select("row", "col", F.explode(F.sequence(F.lit(-REACH), F.lit(REACH))).alias("k")).withColumn("row2", F.col("row") + F.col("k"))
    top = lambda r: F.cos(F.radians(F.least(F.lit(90.0), F.greatest(F.abs(r * step), F.abs((r + 1) * step)))))
    half = math.sin(metres / 2000 / geo.EARTH_KM)
    # how many degrees of longitude may lie between two spots so near each other in these rows
    cosines = F.greatest(F.lit(0.0), top(F.col("row")) * top(F.col("row2")))
    aside = F.when(cosines <= half * half, F.lit(180.0)).otherwise(F.degrees(2 * F.asin(F.lit(half) / F.sqrt(cosines))) * 1.0001 + 1e-9)
    own, other = _columns(F.col("row"), step), _columns(F.col("row2"), step)
    start, end = F.col("col") / own * 360 - aside, (F.col("col") + 1) / own * 360 + aside
    first, last = F.floor(start / 360 * other).cast("long"), F.floor(end / 360 * other).cast("long")
    reached = F.when(last - first + 1 >= other, F.sequence(F.lit(0).cast("long"), other - 1)).otherwise(F.transform(F.sequence(first, last), lambda c: F.pmod(c, other)))
    return wide.select("row", "col", "row2", F.explode(F.array_distinct(reached)).alias("col2"))


def _bounds(a: str, b: str) -> tuple[Column, Column]:
    """Least and greatest km between spots of two boxes (columns ``<a>x0`` and so on), never too narrow."""
    c = lambda s, n: F.col(f"{s}{n}")
    gap = lambda n: F.greatest(F.lit(0.0), c(a, f"{n}0") - c(b, f"{n}1"), c(b, f"{n}0") - c(a, f"{n}1"))
    span = lambda n: F.greatest(c(a, f"{n}1") - c(b, f"{n}0"), c(b, f"{n}1") - c(a, f"{n}0"))
    # longitudes are of one turn, but two cells may lie on either side of its end
    round_gap, round_span = F.greatest(F.lit(0.0), 360 - span("x")), 360 - gap("x")
    low, high = F.least(gap("x"), round_gap), F.least(F.lit(180.0), F.when(span("x") <= 180, span("x")).otherwise(round_span))
    far = lambda s: F.greatest(F.abs(c(s, "y0")), F.abs(c(s, "y1")))
    near = lambda s: F.when((c(s, "y0") <= 0) & (c(s, "y1") >= 0), F.lit(0.0)).otherwise(F.least(F.abs(c(s, "y0")), F.abs(c(s, "y1"))))

    def km(x: Column, y: Column, cosines: Column) -> Column:
        h = F.pow(F.sin(F.radians(y) / 2), F.lit(2.0)) + cosines * F.pow(F.sin(F.radians(x) / 2), F.lit(2.0))
        return 2 * geo.EARTH_KM * F.asin(F.sqrt(F.least(F.lit(1.0), h)))

    cos = lambda y: F.cos(F.radians(F.least(F.lit(90.0), y)))
    return km(low, gap("y"), cos(far(a)) * cos(far(b))) * (1 - 1e-9), km(high, span("y"), cos(near(a)) * cos(near(b))) * (1 + 1e-9)


def _links(core: DataFrame, asked: DataFrame, metres: float) -> DataFrame:
    """Of the pairs ``asked(a, b, na, nb)`` of cells, with how many core spots they have, those of which two core spots
    (cell, fx, fy, lon, lat) are no farther than ``metres`` from each other. ``fx`` and ``fy`` are places in the cell, from 0 to 1."""
    km, level, found = metres / 1000, 0, []
    # pairs of parts of cells, as long as they may hold a close pair
    parts = asked.select("a", "b", *[F.lit(0).cast("long").alias(c) for c in ("ax", "ay", "bx", "by")], "na", "nb")
    while True:
        scale = 1 << level
        placed = core.withColumns({"px": F.floor(F.col("fx") * scale).cast("long"), "py": F.floor(F.col("fy") * scale).cast("long")})
        left = placed.select(F.col("cell").alias("a"), F.col("px").alias("ax"), F.col("py").alias("ay"), F.col("lon").alias("x"), F.col("lat").alias("y"))
        right = placed.select(F.col("cell").alias("b"), F.col("px").alias("bx"), F.col("py").alias("by"), F.col("lon").alias("x2"), F.col("lat").alias("y2"))
        small = parts.filter(F.col("na") * F.col("nb") <= PAIRS)
        close = small.join(left, ["a", "ax", "ay"]).join(right, ["b", "bx", "by"]).filter(geo.haversine_km(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")) <= km)
        found.append(stored(close.select("a", "b").distinct()))
        large = parts.filter(F.col("na") * F.col("nb") > PAIRS)
        if large.isEmpty():
            out = found[0]
            for more in found[1:]:
                out = out.unionAll(more)
            return out
        level, scale = level + 1, 2 * scale
        halves = lambda c: F.explode(F.array(2 * F.col(c), 2 * F.col(c) + 1)).alias(c)
        cut = large.join(found[-1], ["a", "b"], "left_anti").select("a", "b", halves("ax"), "ay", "bx", "by")
        for c in ("ay", "bx", "by"):
            cut = cut.select(*[halves(c) if x == c else F.col(x) for x in cut.columns])
        halved = core.withColumns({"px": F.floor(F.col("fx") * scale).cast("long"), "py": F.floor(F.col("fy") * scale).cast("long")})
        boxes = stored(halved.groupBy("cell", "px", "py").agg(F.count("*").alias("n"), F.min("lon").alias("x0"), F.max("lon").alias("x1"), F.min("lat").alias("y0"), F.max("lat").alias("y1")))
        one = boxes.select(F.col("cell").alias("a"), F.col("px").alias("ax"), F.col("py").alias("ay"), F.col("n").alias("na"), *[F.col(c).alias(f"p{c}") for c in ("x0", "x1", "y0", "y1")])
        two = boxes.select(F.col("cell").alias("b"), F.col("px").alias("bx"), F.col("py").alias("by"), F.col("n").alias("nb"), *[F.col(c).alias(f"q{c}") for c in ("x0", "x1", "y0", "y1")])
        least, most = _bounds("p", "q")
        met = stored(cut.join(one, ["a", "ax", "ay"]).join(two, ["b", "bx", "by"]).filter(least <= km).withColumn("sure", most <= km))
        # parts so near each other that any two of their spots are a close pair
        found.append(stored(met.filter("sure").select("a", "b").distinct()))
        parts = met.join(found[-1], ["a", "b"], "left_anti").select("a", "b", "ax", "ay", "bx", "by", "na", "nb")


def density_clusters(df: DataFrame, row_id: str, lon: str, lat: str, metres: float, out: str, min_samples: int = 2) -> DataFrame:
    """``df`` with the density cluster of each row in ``out``: 1, 2, ... by their first core rows; rows of none -1, -2,
    ... in row order; rows without a point (null, NaN) null.

    A row is core if ``min_samples`` rows, itself one of them, are within ``metres`` of it; core rows within
    ``metres`` of each other are of one cluster, and so are the rows near them. A row that is near
    core rows of several goes to the cluster of the least number. The order of rows is that of ``row_id``.
    """
    if min_samples < 1 or not 0 < metres <= 1_000_000:
        raise ValueError("min_samples is 1 at least, metres are over 0 and up to 1,000,000")
    step, km = _step(metres), metres / 1000
    placed = df.filter(geo.is_point(F.col(lon), F.col(lat))).select(F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"), F.col(row_id).alias("id"))
    turned = F.pmod(F.col("lon") + 180, F.lit(360.0)) - 180
    spots = placed.groupBy("lon", "lat").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    spots = spots.withColumn("row", _row(F.col("lat"), step)).withColumn("col", _column(F.col("lon"), _columns(F.col("row"), step)))
    spots = stored(spots)
    cells = spots.groupBy("row", "col").agg(F.sum("n").alias("rows"))
    # spots of thin cells, at most min_samples - 1 a cell, and all spots around
    thin = spots.join(cells.filter(F.col("rows") < min_samples).select("row", "col"), ["row", "col"])
    near = _around(cells.filter(F.col("rows") < min_samples), metres, step)
    close = geo.haversine_km(F.col("lon"), F.col("lat"), F.col("lon2"), F.col("lat2")) <= km
    if min_samples > 2:
        others = spots.select(F.col("row").alias("row2"), F.col("col").alias("col2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), F.col("n").alias("n2"))
        around = thin.join(near, ["row", "col"]).join(others, ["row2", "col2"]).filter(close)
        dense = around.groupBy("lon", "lat").agg(F.sum("n2").alias("rows")).filter(F.col("rows") >= min_samples).select("lon", "lat")
        thick = cells.filter(F.col("rows") >= min_samples).select("row", "col")
        core = stored(spots.join(thick, ["row", "col"], "left_semi").unionByName(thin.join(dense, ["lon", "lat"], "left_semi").select(*spots.columns)))
    else:  # any two rows near each other are core: a spot alone is a cluster of too few rows
        core = spots
    # a cell is known by its first core row
    nodes = stored(core.groupBy("row", "col").agg(F.min("first").alias("cell"), F.count("*").alias("na"), F.sum("n").alias("rows")))
    count = _columns(F.col("row"), step)
    place = F.pmod(F.col("lon") + 180, F.lit(360.0)) / 360 * count - F.col("col")
    inside = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1 - 1e-12), x))
    located = core.join(nodes, ["row", "col"]).select("cell", inside(place).alias("fx"), inside(F.col("lat") / step - F.col("row")).alias("fy"), turned.alias("lon"), "lat")
    names = nodes.select(F.col("row").alias("row2"), F.col("col").alias("col2"), F.col("cell").alias("b"), F.col("na").alias("nb"))
    asked = stored(_around(nodes, metres, step).join(nodes, ["row", "col"]).join(names, ["row2", "col2"]).select(F.col("cell").alias("a"), "b", "na", "nb").filter("a < b"))
    roots = components(_links(located, asked, metres).select(F.col("a").alias("u"), F.col("b").alias("v")))
    named = nodes.join(roots, F.col("cell") == F.col("node"), "left").select("row", "col", "rows", F.coalesce("root", "cell").alias("root"))
    enough = named.groupBy("root").agg(F.sum("rows").alias("rows")).filter(F.col("rows") >= (1 if min_samples > 2 else min_samples))
    numbers = with_row_id(enough.select("root"), ["root"], "k").select("root", (F.col("k") + 1).alias("id"))
    labelled = stored(core.join(named.drop("rows").join(numbers, "root"), ["row", "col"]).select("lon", "lat", "n", "row", "col", F.col("id").alias("c")))
    # the others are in thin cells: near a core spot, or of no cluster
    border = thin.join(labelled.select("lon", "lat"), ["lon", "lat"], "left_anti").join(near, ["row", "col"])
    reached = border.join(labelled.select(F.col("row").alias("row2"), F.col("col").alias("col2"), F.col("lon").alias("lon2"), F.col("lat").alias("lat2"), "c"), ["row2", "col2"]).filter(close)
    clustered = labelled.select("lon", "lat", "n", "c")
    if min_samples > 2:  # else all spots that are near one are core
        clustered = stored(clustered.unionAll(reached.groupBy("lon", "lat", "n").agg(F.min("c").alias("c"))))
    rest = spots.join(clustered, ["lon", "lat"], "left_anti").select("lon", "lat")
    single = with_row_id(placed.join(rest, ["lon", "lat"], "left_semi").select("id"), ["id"], "k")
    x, y, own, of, alone, rows = fresh_names([*df.columns, out], 6)
    made = clustered.select(F.col("lon").alias(x), F.col("lat").alias(y), F.col("c").alias(own), F.col("n").alias(rows))
    noise = single.select(F.col("id").alias(of), (-F.col("k") - 1).alias(alone))
    joined = joined_by_key(df.drop(out), made, {lon: x, lat: y}, rows)
    joined = joined.join(noise, F.col(row_id) == F.col(of), "left")
    return joined.withColumn(out, F.coalesce(own, alone)).drop(x, y, own, of, alone)
