"""Packing of token sequences into as few windows as possible by minimum bin slack.

Every document becomes pieces of at most ``capacity`` ids. Only the histogram of piece lengths, at
most ``capacity`` numbers whatever the corpus, reaches the driver. There, minimum bin slack fills
one bin at a time: the longest length left is fixed and a subset-sum over the other lengths left,
held as a bitset, finds the fullest combination; that combination is then taken as often as the
counts allow, so the work depends on the number of different lengths, not on the number of pieces.
The n-th piece of a length then finds its bin by looking n up in that length's ranges.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.llm.common import checkpointed, read_table
from atlasweave.llm.tokens import worker_encoder

PIECES = "part int, ordinal long, doc_id long, piece int, start long, length long, ids_crc32 long"


def fullest(counts: dict[int, int], room: int) -> Counter[int]:
    """The multiset of lengths, within ``counts``, whose sum is the largest that ``room`` holds.

    reach[i] is the bitset of the sums of the first i items tried; the search stops once ``room``
    itself is reached, and the choice is read back from the last bitset to the first.
    """
    mask, reach, tried = (1 << (room + 1)) - 1, [1], []
    for length in sorted((x for x in counts if counts[x] > 0 and x <= room), reverse=True):
        left, step = min(counts[length], room // length), 1
        while left > 0:  # copies in powers of two reach every number of copies
            n = min(step, left)
            tried.append((length, n))
            reach.append((reach[-1] | reach[-1] << length * n) & mask)
            left, step = left - n, step * 2
            if reach[-1] >> room & 1:
                break
        if reach[-1] >> room & 1:
            break
    total, chosen = reach[-1].bit_length() - 1, Counter()
    for k in range(len(tried) - 1, -1, -1):
        length, n = tried[k]
        if not reach[k] >> total & 1:
            chosen[length] += n
            total -= length * n
    return chosen


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Bins as (how many alike, {length: copies in each})."""
    left = {k: v for k, v in histogram.items() if v > 0}
    bins = []
    while left:
        first = max(left)
        left[first] -= 1
        combination = fullest(left, capacity - first)
        left[first] += 1
        combination[first] += 1
        alike = min(left[k] // n for k, n in combination.items())
        for k, n in combination.items():
            left[k] -= n * alike
            if not left[k]:
                del left[k]
        bins.append((alike, dict(combination)))
    return bins


class Places:
    """For each length the ranges of its pieces' ranks, and the bin and offset of each range."""

    def __init__(self, bins: list[tuple[int, dict[int, int]]]):
        taken: Counter[int] = Counter()
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        base = 0
        for alike, combination in bins:
            offset = 0
            for length in sorted(combination, reverse=True):
                n = combination[length]
                rows.setdefault(length, []).append((taken[length], n, base, offset))
                taken[length] += n * alike
                offset += n * length
            base += alike
        self.n_bins = base
        self.rows = {k: np.array(v, dtype=np.int64) for k, v in rows.items()}

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        if not len(length):
            return sequence, offset
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order], prepend=-1))
        for i, j in zip(cuts, [*cuts[1:], len(order)], strict=True):
            own = order[i:j]
            table = self.rows[int(length[own[0]])]
            k = np.searchsorted(table[:, 0], rank[own], side="right") - 1
            within = rank[own] - table[k, 0]
            sequence[own] = table[k, 2] + within // table[k, 1]
            offset[own] = table[k, 3] + within % table[k, 1] * length[own]
        return sequence, offset


def cut_into_pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, text: str, key: str, cache: int) -> DataFrame:
    """One row a piece; (part, ordinal) numbers the pieces of a length within the task that made them."""

    def cut(batches):
        encoder, part = worker_encoder(vocabulary, cache), TaskContext.get().partitionId()
        seen: Counter[int] = Counter()
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                some = batch.slice(lo, 512)
                out = []
                for doc, ids in zip(some.column(0).to_pylist(), encoder.values(some.column(1).to_pylist()), strict=True):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        n = len(own) // 4
                        out.append((part, seen[n], doc, piece, at // 4, n, zlib.crc32(own)))
                        seen[n] += 1
                columns = list(zip(*out, strict=True)) or [()] * 7
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, PIECES)


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, text: str = "text", key: str = "doc_id", cache: int = 1_000_000
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row for each piece.

    A null or empty text is the end id alone; a null key stays null; repeated rows are packed each
    by itself; an empty table gives an empty result; other columns are ignored. Sequences are
    gapless from offset 0 and none is longer than ``capacity``. ``cache`` bounds the entries of each
    worker's two caches, so it trades memory for time and nothing else.

    The pieces are made once and kept in the checkpoint folder, since ranks refer to the tasks that
    made them. A rank is the ordinal within the task plus the count of the tasks before it, so no
    length, however frequent, is gathered in one place: the join key is (task, length).
    """
    spark = docs.sparkSession
    pieces = checkpointed(cut_into_pieces(docs, vocabulary, capacity, end_id, text, key, cache))
    sizes = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    places = spark.sparkContext.broadcast(Places(minimum_bin_slack(histogram, capacity)))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = places.value.of(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    ranked = pieces.join(before.select("part", "length", F.coalesce("before", F.lit(0)).alias("before")), ["part", "length"])
    placed = ranked.withColumn("at", place(F.col("length"), F.col("ordinal") + F.col("before")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "at.sequence_id", "at.offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
