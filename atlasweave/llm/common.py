"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.functions.ids import fresh_names
from atlasweave.session import checkpointed, ensure_checkpoint_dir

__all__ = ["TextBlocks", "checkpointed", "fresh_names", "no_cycle_collection", "own_key", "read_table", "resident", "sampled", "shared_path", "split_of", "written"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession) -> str:
    """A new name for a table in the shared checkpoint folder; whoever owns that folder clears it."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once as a table in the shared checkpoint folder and read back."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def split_of(doc_id: Column) -> Column:
    """Fold of a document: crc32 of its id as text, modulo 3 (1 is held out)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def own_key(key: str, results: str) -> None:
    """Raises if a key is named like one of the columns (a schema string) that a result has besides."""
    if key.lower() in {x.split()[0].lower() for x in results.split(", ")}:
        raise ValueError(f"the result has a column {key} of its own: rename the key")


def sampled(rows: DataFrame, group: str, k: int) -> DataFrame:
    """At most ``k`` rows of each group: its different rows with the least hashes of all their columns, so
    that rows that share an id are chosen each by its own content, and copies of these only where room is left.

    Different rows are counted by sketch, and about four times as many as are wanted are looked at, copies
    as one; so no group is gathered, whatever it holds. There should be few groups.
    """
    own, of, rows_, copies, rank, before, kinds = fresh_names(rows.columns, 7)
    names = [F.col(f"`{c}`") for c in rows.columns]
    hashed = rows.withColumn(own, F.shiftrightunsigned(F.xxhash64(*names), 2))
    counts = hashed.groupBy(F.col(f"`{group}`").alias(of)).agg(F.approx_count_distinct(own).alias(kinds))
    share = F.least(F.lit(1.0), (4 * k + 64) / F.col(kinds))
    near = hashed.join(F.broadcast(counts), F.col(f"`{group}`") == F.col(of)).filter(F.col(own) <= share * (1 << 62))
    single = near.groupBy(of, own).agg(F.min(F.struct(*names)).alias(rows_), (F.count("*") - 1).alias(copies))
    each = Window.partitionBy(of)
    earlier = F.coalesce(F.sum(copies).over(each.orderBy(own).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = single.withColumns({rank: F.row_number().over(each.orderBy(own)), before: earlier, kinds: F.count("*").over(each)}).filter(F.col(rank) <= k)
    again = F.greatest(F.lit(0).cast("long"), F.least(F.col(copies), k - F.col(kinds) - F.col(before)))
    return placed.withColumn(copies, F.explode(F.sequence(F.lit(0).cast("long"), again))).select(f"{rows_}.*")


@contextlib.contextmanager
def no_cycle_collection() -> Iterator[None]:
    """Python's cycle collector off: walking millions of short strings again and again costs more
    than the work on them, and they form no cycles."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


_resident: dict[str, Any] = {}


def resident(key: str, make: Callable[[], Any]) -> Any:
    """What ``make`` gives for ``key``, kept in this worker process for later tasks. Only the one asked
    for last is kept, so a worker that serves many operators holds the model or cache of one."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


class TextBlocks:
    """Consecutive texts gathered into blocks of bounded size, so that numpy work is on long arrays
    and memory stays bounded whatever the batch; a text is never cut, so one longer than ``size``
    is a block of its own."""

    def __init__(self, size: int = 1 << 21):
        self.size = size

    def __call__(self, texts: Iterable[str | None]) -> Iterator[tuple[int, list[str]]]:
        block: list[str] = []
        first = held = 0
        for i, text in enumerate(texts):
            text = text or ""
            if block and held + len(text) > self.size:
                yield first, block
                block, first, held = [], i, 0
            block.append(text)
            held += len(text)
        if block:
            yield first, block
