"""Connected components of an edge table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.operators.skew import looked_up_by_key
from atlasweave.session import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every greater neighbour of a node to the least node of its neighbourhood."""
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # edges come with u > v
    both = edges.select("u", "v").unionAll(up)
    least = stored(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count_if(F.col("v") > F.col("u")).alias("n")))
    return looked_up_by_key(up, least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links every lesser neighbour of a node, and the node, to the least of them."""
    least = stored(edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
    moved = looked_up_by_key(edges, least, "u", "n").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges(u, v)``; the root is the component's least node.

    Alternating large and small stars: each round is two joins on a key's minimum, which is
    aggregated before the shuffle; the minima of hubs are broadcast, a bounded number of them, so
    the edges of a hub stay where they are. Rounds grow with the logarithm of the number of nodes.
    Every round is stored. Loops (u = v), repeated and null edges are ignored; no edges
    give an empty result.
    """
    known = edges.filter("u is not null and v is not null and u <> v")
    now = stored(known.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or state[0] == 0:
            break
        before = state
        now = stored(_small_star(stored(_large_star(now))))
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
