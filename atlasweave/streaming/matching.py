"""Matching the rows of a stream against a static table, a batch at a time."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from atlasweave.operators.linkage import match_index, matched_with
from atlasweave.session import ensure_checkpoint_dir


def store_match_index(match: DataFrame, match_name: str, match_order: str, match_levels: Sequence[str] = (), kind: str | None = None, path: str | None = None) -> str:
    """Writes the index of a match table, once, and returns where: by default a new folder, its version, in the shared
    checkpoint folder. A version is never written again, so streams that use it go on with it."""
    if path is None:
        ensure_checkpoint_dir(match.sparkSession)
        path = f"{match.sparkSession.sparkContext.getCheckpointDir()}/match-index-{uuid.uuid4().hex}"
    match_index(match, match_name, match_order, match_levels, kind).write.mode("error").parquet(path)
    return path


def match_batch(batch: DataFrame, name: str, index: str, levels: Sequence[str], measure: str = "rapid") -> DataFrame:
    """One batch with the six match columns: the match table is read as it was prepared."""
    spark: SparkSession = batch.sparkSession
    return matched_with(batch, name, spark.read.parquet(index), "", levels, measure)


def match_stream(
    stream: DataFrame, name: str, match: DataFrame, match_name: str, match_order: str, levels: Sequence[str], match_levels: Sequence[str], path: str, checkpoint: str, once: bool = True, measure: str = "rapid", index: str | None = None
) -> StreamingQuery:
    """Writes every batch's rows with the six match columns as parquet under ``path``, in a folder for
    each batch, so a batch that is run again replaces what it wrote before.

    The match table is prepared before the first batch and stored; batches read that. ``index`` names one that is
    stored already (:func:`store_match_index`): a stream that is started again finds the same records."""
    stored = index or store_match_index(match, match_name, match_order, match_levels)

    def run(batch: DataFrame, number: int) -> None:
        match_batch(batch, name, stored, levels, measure).write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
