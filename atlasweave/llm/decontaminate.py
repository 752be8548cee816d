"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into overlapping segments, one every q characters, so that every stretch of
``length`` characters of an item (75, about the thirteen words that are usual) holds a whole one
wherever it begins. A segment of m characters within k edits of some stretch of a text shares at least
m + 1 - q * (k + 1) of its q-grams with it, on diagonals that differ by at most k. Shared q-grams
are counted in overlapping bands of diagonals; bands that reach the bound are verified by banded
alignment. Items too short for that are looked up as they are.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import own_key, read_table, resident, TextBlocks
from atlasweave.llm.passages import Block, GramIndex, banded, best_spans, normal, normal_block, regions

HIT = "item_id long, start int, end int, edits int, matched double"


class SegmentGrams(GramIndex):
    """q-grams of whole items, each stored once; a shared one counts for all segments that hold it."""

    def __init__(self, items: list[np.ndarray], q: int, size: int, stride: int):
        super().__init__(items, q)
        self.size, self.stride = size, stride
        #: where the last segment of each item starts, and how many segments come before the item's
        self.last = np.array([max(0, len(c) - size) for c in items], np.int64)
        counts = -(-self.last // stride) + 1
        self.before = np.cumsum(counts) - counts
        #: item of each segment, where it starts there and how long it is
        self.item = np.repeat(np.arange(len(items)), counts)
        self.start = np.minimum((np.arange(len(self.item)) - self.before[self.item]) * stride, self.last[self.item])
        self.sizes = np.minimum(size, np.array([len(c) for c in items], np.int64)[self.item])

    def segment(self, p: int) -> np.ndarray:
        at = int(self.start[p])
        return self.patterns[int(self.item[p])][at : at + self.size]

    def expanded(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, item, position = super().expanded(at, lo, n)
        first = np.maximum(0, -(-(position + self.q - self.size) // self.stride))
        end = np.where(position >= self.last[item], -(-self.last[item] // self.stride), position // self.stride) + 1
        n = np.maximum(0, end - first)
        p = np.repeat(self.before[item] + first, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), p, np.repeat(position, n) - self.start[p]


class ShortItems:
    """Items below the q-gram lemma's reach, found where a text has them as whole words, unedited.
    Scripts that don't part words (beyond U+0E00) have them anywhere."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.items: dict[int, dict[bytes, list[int]]] = {}
        for i, codes in items:
            self.items.setdefault(len(codes), {}).setdefault(codes.tobytes(), []).append(i)

    def search(self, block: Block) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, start, end) of each, among the codes of its text."""
        codes, raw = np.append(block.codes, np.uint16(32)), block.codes.tobytes()
        loose = (codes <= 32) | (codes >= 0x0E00)
        begins = np.flatnonzero((loose[:-1] | loose[1:])[:-1]) + 1 if len(codes) > 1 else np.zeros(0, np.int64)
        begins = begins[codes[begins] > 32]
        for n, known in sorted(self.items.items()):
            at = begins[begins + n < len(codes)]
            at = at[loose[at + n] | loose[at + n - 1]]
            for k in at.tolist():
                for i in known.get(raw[2 * k : 2 * (k + n)], ()):
                    text = int(np.searchsorted(block.starts, k, side="right")) - 1
                    if k + n <= block.starts[text + 1]:
                        start = k - int(block.starts[text])
                        yield text, i, start, start + n


class SegmentIndex:
    """Segments of a bounded block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], q: int, rate: float, length: int, least: int):
        whole = [(i, normal(t)) for i, t in items]
        self.items = [(i, c) for i, c in whole if len(c) >= max(least, q)]
        self.short = ShortItems([(i, c) for i, c in whole if 0 < len(c) < max(least, q)])
        # any stretch of ``length`` holds a segment, and with it at most as many edits as the stretch
        self.index = SegmentGrams([c for _, c in self.items], q, max(q, length - q + 1), q)
        sizes = self.index.sizes
        full = np.array([len(c) for _, c in self.items], np.int64)[self.index.item]
        self.edits = np.minimum((np.minimum(full, length) * rate).astype(np.int64), (sizes - q) // q)
        self.least = sizes + 1 - q * (self.edits + 1)

    def search(self, block: Block) -> dict[int, list[tuple[int, int, int, int, float]]]:
        """Per text (item, start, end, edits, share of the item's characters) of each passage found."""
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for text, p, low, _ in regions(self.index, block, self.edits + 1, self.least):
            codes = block.codes[block.starts[text] : block.starts[text + 1]]
            half = int(self.edits[p]) + 1
            hit = banded(self.index.segment(p), codes, low + half, half + int(self.edits[p]), int(self.edits[p]))
            if hit:
                found.setdefault((text, p), []).append(hit)
        per_item: dict[tuple[int, int], list[tuple[int, int, int, int, int]]] = {}
        for (text, p), hits in found.items():
            k, at = int(self.index.item[p]), int(self.index.start[p])
            for edits, start, end in best_spans(hits):
                per_item.setdefault((text, k), []).append((start, end, edits, at, at + int(self.index.sizes[p])))
        out: dict[int, list[tuple[int, int, int, int, float]]] = {}
        for (text, k), spans in sorted(per_item.items()):
            spans.sort()
            places = block.places[block.starts[text] : block.starts[text + 1]]
            size = len(self.items[k][1])
            group = [spans[0]]
            for s in [*spans[1:], None]:
                # segments that lie alike in item and text are one passage
                if s and abs((s[0] - s[3]) - (group[-1][0] - group[-1][3])) <= 0.1 * size + 5 and s[3] >= group[-1][3]:
                    group.append(s)
                    continue
                start, end = group[0][0], max(x[1] for x in group)
                covered = np.zeros(size, bool)
                for x in group:
                    covered[x[3] : x[4]] = True
                out.setdefault(text, []).append((self.items[k][0], int(places[start]), int(places[end - 1]) + 1, max(x[2] for x in group), float(covered.mean())))
                group = [s] if s else []
        for text, i, start, end in self.short.search(block):
            places = block.places[block.starts[text] : block.starts[text + 1]]
            out.setdefault(text, []).append((i, int(places[start]), int(places[end - 1]) + 1, 0, 1.0))
        return out


def worker_index(key: str, shared) -> SegmentIndex:
    return resident(key, lambda: pickle.loads(shared.value))


def worker_search(key: str, shared, texts: list[str | None]) -> Iterator[tuple[int, list]]:
    """(row, passages) of the texts that hold any."""
    index = worker_index(key, shared)
    for first, some in TextBlocks(1 << 20)(texts):
        for i, hits in index.search(normal_block(some)).items():
            yield first + i, hits


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    q: int = 12,
    rate: float = 0.05,
    length: int = 75,
    least: int = 24,
    block_chars: int = 16 << 20,
) -> DataFrame:
    """(key, item_id, start, end, edits, matched): each stretch of a text that holds a passage of a
    benchmark item, by code point offsets; ``matched`` is the share of the item it covers, ``edits``
    the most edits of any segment.

    A passage is found if it holds a stretch of ``length`` characters of an item in normal form,
    wherever that begins, or the whole of a shorter item, within ``rate`` edits a character. Items
    with fewer than ``least`` characters are found unedited, as whole words; items without letters
    and digits match nothing. Null texts and
    items match nothing; repeated rows are reported each; empty tables give an empty result; other
    columns are ignored. The items are gathered in blocks of ``block_chars`` characters, each
    broadcast in turn, so the benchmark may be of any size.
    """
    own_key(key, HIT)
    spark, kind = docs.sparkSession, docs.schema[key].dataType.simpleString()
    names = [key, *(x.split()[0] for x in HIT.split(", "))]

    def scan(shared, name):
        def run(batches):
            for batch in batches:
                ids, columns = batch.column(0), ([], [], [], [], [], [])
                for i, hits in worker_search(name, shared, batch.column(1).to_pylist()):
                    for hit in hits:
                        for column, value in zip(columns, (i, *hit), strict=True):
                            column.append(value)
                arrays = [pa.array(c, t) for c, t in zip(columns[1:], (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.float64()), strict=True)]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(columns[0], pa.int64())), *arrays], names)

        return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, {HIT}")

    out = None
    for shared, name in broadcast_blocks(spark, benchmark, q, rate, length, least, block_chars):
        found = scan(shared, name)
        out = found if out is None else out.unionAll(found)
    return out if out is not None else spark.createDataFrame([], f"`{key}` {kind}, {HIT}")


def broadcast_blocks(spark: SparkSession, benchmark: DataFrame, q: int, rate: float, length: int, least: int, block_chars: int) -> Iterator[tuple]:
    """(broadcast index, its name) of each block of about ``block_chars`` characters of items."""
    held, size = [], 0
    for row in [*benchmark.filter("item_id is not null and text is not null").select("item_id", "text").toLocalIterator(), None]:
        if row is not None:
            held.append((row["item_id"], row["text"]))
            size += len(row["text"])
        if held and (row is None or size >= block_chars):
            index = SegmentIndex(sorted(held), q, rate, length, least)
            yield spark.sparkContext.broadcast(pickle.dumps(index)), uuid.uuid4().hex
            held, size = [], 0


def without_passages(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", q: int = 12, rate: float = 0.05, length: int = 75, least: int = 24, block_chars: int = 16 << 20
) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of the benchmark, as :func:`find_passages`
    finds them; rows, repeated ones too, and columns of any names are otherwise as they were. Null texts
    hold none, an empty benchmark drops nothing, an empty table gives an empty one. Nothing is shuffled."""
    out = docs
    for shared, name in broadcast_blocks(docs.sparkSession, benchmark, q, rate, length, least, block_chars):
        out = out.filter(~_holds(shared, name)(F.col(text)))
    return out


def _holds(shared, name: str):
    @F.pandas_udf("boolean")
    def holds(texts: pd.Series) -> pd.Series:
        out = np.zeros(len(texts), bool)
        out[[i for i, _ in worker_search(name, shared, texts.tolist())]] = True
        return pd.Series(out)

    return holds


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
