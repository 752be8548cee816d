"""Duplicate matches of a whole table settled on pairs of a row's number and a code.

A row may list very many codes, so rows are never copied for each of them: what a code's first record says is
looked up where a list is taken apart, and only counts, maxima and the pairs that survive them are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.functions import geo
from atlasweave.operators.skew import joined_by_key
from atlasweave.session import stored, stored_lists

#: Codes of a match table up to which all tasks know them; more are joined by a shuffle.
MOST_CODES = 200_000
PAIR = ["__row", "__i", "__at", "__p", "__r", "__s", "__k", "__d", "__n"]


@dataclass(frozen=True)
class Columns:
    row_id: str
    uuid: str
    part: str
    result: str
    score: str
    method: str
    attributes: Sequence[str]
    point: tuple[str, str] | None = None
    metres: float = 500.0


def _texts(columns: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.col(c).cast("string") for c in columns]))


def code_records(match: DataFrame, uuid: str, attributes: Sequence[str], point: tuple[str, str] | None, order: str) -> DataFrame:
    """(__u, __m, __mlon, __mlat): attributes and point of the first record of each code, stored."""
    lon, lat = (F.col(c) for c in point) if point else (F.lit(None).cast("double"),) * 2
    first = F.min_by(F.struct(_texts(attributes).alias("__m"), lon.alias("__mlon"), lat.alias("__mlat")), F.col(order))
    return stored(match.filter(F.col(uuid).isNotNull()).groupBy(F.col(uuid).alias("__u")).agg(first.alias("s")).select("__u", "s.*"))


def _pairs(heads: DataFrame, records: DataFrame, few: bool, by_distance: bool) -> DataFrame:
    """A row for each code of each list, with its place, distance and common attributes."""
    rest = [c for c in heads.columns if c != "__l"]
    apart = heads.select(*rest, F.posexplode_outer("__l").alias("__at", "__p"))
    met = apart.join(F.broadcast(records), F.col("__p") == F.col("__u"), "left") if few else joined_by_key(apart, records, {"__p": "__u"})
    d = geo.rounded_km(F.col("__lon"), F.col("__lat"), F.col("__mlon"), F.col("__mlat")) if by_distance else F.lit(None).cast("double")
    return met.withColumns({"__d": d, "__n": F.coalesce(F.size(F.array_intersect("__a", "__m")), F.lit(0))})


def settled(rows: DataFrame, columns: Columns, records: DataFrame) -> DataFrame:
    """(__row, __i, __at, __p, __r, __d, __list): the pairs of ``rows`` (which have their numbers in ``__row``, and are
    stored) and their codes that are left by :func:`linkage.resolve_by_distance`, if there is a point, then
    :func:`linkage.resolve_by_attribute` and :func:`linkage.resolve_by_best_match`. ``__r`` is the result, ``__list`` what
    the row's codes become, null if they stay. Equally near codes and the rows of an id go by their place in the list.

    Of a row's NO pairs the first alone is kept; where ids are repeated, see :func:`settled_rows`.
    """
    c, yes = columns, F.col("__r") == "YES"
    lon, lat = (F.col(p) for p in c.point) if c.point else (F.lit(None).cast("double"),) * 2
    heads = rows.select(
        "__row", F.col(c.row_id).alias("__i"), F.col(c.result).alias("__r"), F.col(c.score).alias("__s"), F.col(c.method).alias("__k"), _texts(c.attributes).alias("__a"), lon.alias("__lon"), lat.alias("__lat"), F.array_distinct(F.split(c.uuid, "/")).alias("__l")
    )
    few, by_distance = records.count() <= MOST_CODES, c.point is not None
    if by_distance:
        near = F.col("b.__d") * 1000 <= c.metres
        found = _pairs(heads, records, few, True).filter(yes)
        ids = found.groupBy("__i").agg(F.count("*").alias("c"), F.min_by(F.struct("__d", "__p"), F.struct(F.col("__d").isNull(), "__d", "__at", "__row")).alias("b"))
        keep = stored(ids.filter(F.col("c") > 1).filter(near).select(F.col("__i").alias("__j"), F.col("b.__p").alias("__keep")))
        cut = heads.join(keep, F.col("__i") == F.col("__j"), "left").filter(F.col("__keep").isNull() | F.array_contains("__l", F.col("__keep")))
        # lists as arrays: a code that many lists have is written once a file
        heads = stored(cut.withColumn("__l", F.when(F.col("__keep").isNull(), F.col("__l")).otherwise(F.array("__keep"))).drop("__j", "__keep"))
        found = _pairs(heads, records, few, True).filter(yes & (F.col("__p") != " "))
        parts = found.groupBy("__p").agg(F.count("*").alias("c"), F.min_by(F.struct("__d", "__i"), F.struct(F.col("__d").isNull(), "__d", "__i")).alias("b"))
        won = parts.filter(F.col("c") > 1).filter(near).select(F.col("__p").alias("__w"), F.col("b.__i").alias("__win"))
        records = stored(records.join(won, F.col("__u") == F.col("__w"), "left").drop("__w"))

    def pairs(h: DataFrame) -> DataFrame:
        made = _pairs(h, records, few, by_distance)
        return made.withColumn("__r", F.when(F.col("__win").isNotNull() & (F.col("__i") != F.col("__win")), "NO").otherwise(F.col("__r"))) if by_distance else made

    # by attribute: first of an id's parts, then of a part's ids
    several = pairs(heads).groupBy("__i").agg(F.sum(yes.cast("int")).alias("c"), F.max("__n").alias("__max")).filter("c > 1 and __i is not null")
    several = stored(several.select(F.col("__i").alias("__j"), "__max"))
    both = pairs(heads.join(several, F.col("__i") == F.col("__j"), "left"))
    kept = stored(both.filter(F.col("__max").isNull() | (F.col("__n") == F.col("__max"))).select(*PAIR, F.col("__max").isNotNull().alias("__of")))
    lists = kept.filter("__of").groupBy(F.col("__i").alias("__j")).agg(F.array_join(F.array_sort(F.collect_set("__p")), "/").alias("__list"))
    held = kept.filter(F.col("__p").isNotNull() & (F.col("__p") != " ")).groupBy("__p", "__i").agg(F.max("__n").alias("__n"), F.sum(yes.cast("int")).alias("y"))
    levels = held.groupBy("__p", "__n").agg(F.count("*").alias("ids"), F.sum("y").alias("y")).groupBy("__p").agg(F.max("__n").alias("__max"), F.max_by("ids", "__n").alias("ids"), F.sum("y").alias("y"))
    single = stored(levels.filter("y > 1 and ids = 1").select(F.col("__p").alias("__q"), "__max"))
    losers = kept.join(F.broadcast(single) if few else single, F.col("__p") == F.col("__q")).groupBy("__p", "__i", "__max").agg(F.max("__n").alias("__n")).filter("__n < __max")
    about = lists.join(losers.select(F.col("__i").alias("__l")).filter("__l is not null").distinct(), F.col("__j") == F.col("__l"), "full")
    about = about.select(F.coalesce("__j", "__l").alias("__j"), "__list", F.col("__l").isNotNull().alias("__lost"))
    flagged = kept.join(about, F.col("__i") == F.col("__j"), "left").withColumn("__r", F.when(F.col("__lost"), "NO").otherwise(F.col("__r")))
    flagged = stored(flagged.select(*PAIR, "__list"))

    # by best match: only YES pairs are ever looked at
    top = flagged.filter(yes & F.col("__p").isNotNull() & F.col("__k").isNotNull()).groupBy(F.col("__p").alias("__q"), F.col("__k").alias("__kind")).agg(F.max("__s").alias("__top"))
    rank = F.coalesce(F.when(F.contains(F.col("__kind"), F.lit("partial")), 0).when(F.contains(F.col("__kind"), F.lit("identical")), 2).otherwise(1), F.lit(1))
    # a part's best methods among those of which some row has the best score, as every part's method with a score has
    top = top.filter("__top is not null").withColumn("__rank", rank).withColumn("__most", F.max("__rank").over(Window.partitionBy("__q"))).filter("__rank = __most")
    top = stored(top.select("__q", "__kind", "__top"))
    best = flagged.join(F.broadcast(top) if few else top, (F.col("__p") == F.col("__q")) & (F.col("__k") == F.col("__kind")) & yes & (F.col("__s") == F.col("__top")), "left")
    best = best.withColumn("__r", F.when(F.col("__q").isNotNull(), "YES").otherwise("NO")).drop("__q", "__kind", "__top")
    first = F.col("__at").eqNullSafe(F.min("__at").over(Window.partitionBy("__row")))
    return best.withColumn("__first", first).filter((F.col("__r") == "YES") | F.col("__first")).select("__row", "__i", "__at", "__p", "__r", "__s", "__d", "__list")


def numbered(rows: DataFrame, uuid: str) -> DataFrame:
    """``rows`` stored with their numbers."""
    return stored_lists(rows.withColumn("__row", F.monotonically_increasing_id()), uuid)


def settled_rows(rows: DataFrame, columns: Columns, records: DataFrame, distance: str = "dist_to_match_km") -> DataFrame:
    """``rows`` with the column of parts, once for each pair that :func:`settled` leaves, and the distance if there is a point."""
    c = columns
    rows = numbered(rows, c.uuid)
    pairs = stored(settled(rows, c, records))
    own = pairs.select(F.col("__row").alias("__x"), "__at", F.col("__p").alias(c.part), "__r", "__list", *([F.col("__d").alias(distance)] if c.point else []))
    out = rows.join(own, F.col("__row") == F.col("__x")).withColumns({c.result: F.col("__r"), c.uuid: F.coalesce("__list", c.uuid)})
    if not rows.groupBy(c.row_id).agg(F.count("*").alias("c")).filter("c > 1").isEmpty():
        later = F.row_number().over(Window.partitionBy(c.row_id).orderBy(c.uuid, "__row", "__at")) > 1
        out = out.withColumn("__later", later).filter(~(F.col("__later") & (F.col(c.result) == "NO"))).drop("__later")
    return out.drop("__row", "__x", "__at", "__r", "__list")
