"""Lookups in a table of one row a key, whatever share of the rows one key holds."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.functions.ids import fresh_names
from atlasweave.session import stored

#: No more keys than this are broadcast.
MOST_HOT = 20_000
#: Rows that a key may have before its rows stay where they are.
LEAST_HOT = 200_000
#: How many parts rows without a key are dealt to.
NULL_SPREAD = 4096


def looked_up_by_key(df: DataFrame, table: DataFrame, key: str, size: str, most: int = MOST_HOT, least: int = 64) -> DataFrame:
    """``df`` joined with ``table`` on ``key``; rows without a partner go, as do null keys.

    ``table`` has one row a key with ``size``, how many rows of ``df`` have it, and should be stored:
    it is read several times, as ``df`` is. Keys that hold more than a ``most``-th of all rows (and
    ``least`` rows) are joined by broadcast where their rows are. There are fewer than ``most`` of
    those whatever the size of the tables, and no other key holds more than that share, so no task
    of the shuffled rest gets a hot key.
    """
    total, largest = table.agg(F.sum(size), F.max(size)).first()
    bar = max(least, (total or 0) // most)
    if not largest or largest <= bar:
        return df.join(table.drop(size), key)
    hot, rest = F.broadcast(table.filter(F.col(size) > bar).drop(size)), table.filter(F.col(size) <= bar).drop(size)
    return df.join(hot, key).unionByName(df.join(hot.select(key), key, "left_anti").join(rest, key))


def joined_by_key(df: DataFrame, table: DataFrame, keys: Mapping[str, str], size: str | None = None, most: int | None = None, least: int | None = None) -> DataFrame:
    """``df`` left joined with ``table``, which has one row a key, on pairs of columns (of ``df``: of ``table``);
    the two share no column name. Null keys have no partner, and are spread over the tasks.

    Rows of keys with over ``least`` rows and over a ``most``-th of all are joined by broadcast where they are,
    so no task of the shuffled rest gets a hot key. How many rows of ``df`` a key has is told by the
    column ``size`` of ``table``, which should then be stored and is left out of the result; else the keys of
    ``df`` are counted first, be they in the table or not. Where no key has so many rows this is one join.
    """
    most, least = MOST_HOT if most is None else most, LEAST_HOT if least is None else least
    mine, theirs = fresh_names([*df.columns, *table.columns], 2)
    names = fresh_names([*df.columns, *table.columns, mine], len(keys))
    both = lambda left, right: reduce(and_, [F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in zip(left, right, strict=True)])
    if size is None:
        counts = df.groupBy(*[F.col(f"`{a}`").alias(n) for a, n in zip(keys, names, strict=True)]).agg(F.count("*").alias(mine))
        over = stored(counts.filter(F.col(mine) > least))  # few keys have so many rows
        crowded = not over.isEmpty()
        hot = over.filter(F.col(mine) > max(least, df.count() // most)).select(*names) if crowded else None
        kept = table
    else:
        total, largest = table.agg(F.sum(size), F.max(size)).first()
        bar = max(least, (total or 0) // most)
        crowded = bool(largest) and largest > bar
        hot = table.filter(F.col(size) > bar).select(*[F.col(f"`{b}`").alias(n) for b, n in zip(keys.values(), names, strict=True)]) if crowded else None
        kept = table.drop(size)
    missing = reduce(or_, [F.col(f"`{a}`").isNull() for a in keys])
    salted = df.withColumn(mine, F.when(missing, F.pmod(F.monotonically_increasing_id(), F.lit(NULL_SPREAD))).otherwise(0))
    zero = kept.withColumn(theirs, F.lit(0).cast("long"))
    condition = both(keys, keys.values()) & (F.col(mine) == F.col(theirs))
    if not crowded:
        return salted.join(zero, condition, "left").drop(mine, theirs)
    hot = F.broadcast(hot)
    # the frequent keys' rows of the table are no more than the keys
    apart = salted.join(hot, both(keys, names), "left_semi").join(F.broadcast(zero.join(hot, both(keys.values(), names), "left_semi")), condition, "left")
    rest = salted.join(hot, both(keys, names), "left_anti").join(zero, condition, "left")
    return apart.unionByName(rest).drop(mine, theirs)
