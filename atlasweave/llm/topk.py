"""Exact top-k inner products of whole-number vectors, pruned by norms and partial sums.

Candidates are cut into blocks by descending length. Within a block the vectors are rotated by the
right singular vectors of the block, so that the first coordinates carry most of every vector; a
query's inner product with a candidate is then its partial sum over the first coordinates plus at
most the product of both residual lengths (Cauchy-Schwarz). Candidates whose bound is below the
query's k-th score so far are dropped, first by whole lengths, then after each group of
coordinates; the survivors are scored exactly in integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.llm.common import checkpointed, read_table, shared_path

BLOCK = "longest double, ids array<long>, width int, packed binary, axes binary"
QUESTIONS = "ids array<long>, width int, packed binary, floor array<double>"
FOUND = "query_id long, vec_id long, score long"


def rotation(vectors: np.ndarray) -> np.ndarray:
    """The right singular vectors, greatest first: the eigenvectors of the Gram matrix."""
    exact = vectors.astype(np.float64)
    return np.linalg.eigh(exact.T @ exact)[1][:, ::-1]


class CandidateBlock:
    """Vectors of one block in descending length with their rotation."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, axes: np.ndarray | None = None):
        exact = vectors.astype(np.float64)
        norm = np.sqrt((exact**2).sum(axis=1))
        order = np.lexsort((ids, -norm))
        self.ids, self.vectors, self.norm, self.exact = ids[order], vectors[order], norm[order], exact[order]
        self.axes = rotation(vectors) if axes is None else axes
        self.rotated = self.exact @ self.axes
        self.width = vectors.shape[1]
        self.cuts = sorted({min(self.width, c) for c in (8, 16, 32)}) if self.width else []
        #: residual lengths after each group of coordinates
        self.rest = [np.sqrt(np.maximum((self.rotated[:, c:] ** 2).sum(axis=1), 0)) for c in self.cuts]
        self.greatest = float(np.abs(self.exact).max(initial=0))


class Questions:
    """Some queries of one width and the k best candidates of each so far, each candidate id once, by
    its best score; ties to the smaller id. ``floor``: scores that k candidates elsewhere have."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.exact = vectors.astype(np.float64)
        self.norm = np.sqrt((self.exact**2).sum(axis=1))
        self.greatest = float(np.abs(self.exact).max(initial=0))
        self.worst = np.full(len(ids), -np.inf) if floor is None else np.array(floor, np.float64)
        self.best = (np.zeros(0, np.int64),) * 3  # query, score, candidate

    def add(self, r: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        r, score, ids = (np.concatenate(x) for x in zip(self.best, (r, score, ids), strict=True))
        order = np.lexsort((~score, ids, r))
        r, score, ids = r[order], score[order], ids[order]
        new = np.append(True, (r[1:] != r[:-1]) | (ids[1:] != ids[:-1]))
        r, score, ids = r[new], score[new], ids[new]
        order = np.lexsort((ids, ~score, r))
        r, score, ids = r[order], score[order], ids[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        last = rank == self.k - 1
        self.worst[r[last]] = np.maximum(self.worst[r[last]], score[last])
        kept = rank < self.k
        self.best = r[kept], score[kept], ids[kept]

    def search(self, block: CandidateBlock, step: int = 2048) -> None:
        """Takes in the candidates of ``block`` that may be among the k best."""
        if not len(block.ids):
            return
        asked = np.flatnonzero(self._may(self.norm * block.norm[0], self.worst))
        if not len(asked):
            return
        turned = self.exact[asked] @ block.axes
        rest = [np.sqrt(np.maximum((turned[:, c:] ** 2).sum(axis=1), 0)) for c in block.cuts]
        # inner products below this are exact in float64; integers are exact as long as the result fits
        small = max(block.greatest, 1) * max(self.greatest, 1) * max(1, block.width) < 2**52
        cuts = [0, *range(min(64, step), len(block.ids), step), len(block.ids)]  # a short first one sets the bar
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            live = np.flatnonzero(self._may(self.norm[asked] * block.norm[lo], self.worst[asked])) if hi > lo else ()
            if not len(live):
                break  # lengths only descend from here
            q = asked[live]
            worst, partial, done = self.worst[q][:, None], np.zeros((len(live), hi - lo)), 0
            maybe = np.ones((len(live), hi - lo), bool)
            for c, theirs, own in zip(block.cuts, block.rest, rest, strict=True):
                partial += turned[live, done:c] @ block.rotated[lo:hi, done:c].T
                done = c
                slack = own[live, None] * theirs[lo:hi]
                maybe = self._may(partial + slack, worst, np.abs(partial) + slack)
                if maybe.mean() < 0.02:
                    break
            r, c = np.nonzero(maybe)
            if not len(r):
                continue
            if small and len(r) > 0.1 * maybe.size:
                score = (self.exact[q] @ block.exact[lo:hi].T)[r, c].astype(np.int64)
            else:
                mine, theirs = (self.exact, block.exact) if small else (self.vectors, block.vectors)
                score = np.empty(len(r), np.int64)
                for at in range(0, len(r), 1 << 15):
                    some = slice(at, at + (1 << 15))
                    score[some] = np.einsum("ij,ij->i", mine[q[r[some]]], theirs[lo + c[some]]).astype(np.int64)
            r, ids = q[r], block.ids[lo + c]
            good = (ids != self.ids[r]) & (score >= self.worst[r])
            if good.any():
                self.add(r[good], score[good], ids[good])

    @staticmethod
    def _may(bound: np.ndarray, worst: np.ndarray, size: np.ndarray | None = None) -> np.ndarray:
        """Whether the bound reaches the bar, whatever was lost in rounding."""
        return bound + 1e-6 + 1e-9 * (np.abs(bound) if size is None else size) >= worst

    def floors(self) -> np.ndarray:
        return self.worst

    def found(self) -> pa.RecordBatch:
        r, score, ids = self.best
        return pa.RecordBatch.from_arrays([pa.array(self.ids[r]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs; null if any component is null or not finite."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.when(sound, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def blocks_of(vectors: DataFrame, rows: int, most_bytes: int) -> DataFrame:
    """``vectors(vec_id, v)`` as blocks of one width with at most ``rows`` rows and about ``most_bytes``,
    each with its rotation."""

    def pack(batches):
        held: dict[int, tuple[list, list]] = {}

        def emit(width):
            ids, data = held.pop(width)
            packed = np.array(data, "<i8").reshape(len(ids), width)
            longest = float((packed.astype(np.float64) ** 2).sum(axis=1).max())
            columns = [[longest], [ids], [width], [packed.tobytes()], [np.ascontiguousarray(rotation(packed)).tobytes()]]
            kinds = [pa.float64(), pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in BLOCK.split(", ")])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, data = held.setdefault(len(v), ([], []))
                ids.append(i)
                data.append(v)
                if len(ids) >= rows or len(ids) * len(v) * 8 >= most_bytes:
                    yield emit(len(v))
        for width in list(held):
            yield emit(width)

    return vectors.select("vec_id", "v").mapInArrow(pack, BLOCK)


def _unpack(row) -> tuple[np.ndarray, np.ndarray]:
    ids = np.array(row["ids"], np.int64)
    return ids, np.frombuffer(row["packed"], "<i8").reshape(len(ids), row["width"])


def _block(row) -> CandidateBlock:
    return CandidateBlock(*_unpack(row), np.frombuffer(row["axes"], "<f8").reshape(row["width"], row["width"]))


def _with_floors(questions: DataFrame, head, k: int) -> DataFrame:
    """Blocks of queries (QUESTIONS) with the k-th score of each among the longest vectors."""

    def ask(batches):
        block = _block(head.value) if head is not None else None
        for batch in batches:
            for row in batch.to_pylist():
                own = Questions(*_unpack(row), k)
                if block is not None and block.width == row["width"]:
                    own.search(block)
                columns = [[row["ids"]], [row["width"]], [row["packed"]], [own.floors().tolist()]]
                kinds = [pa.list_(pa.int64()), pa.int32(), pa.binary(), pa.list_(pa.float64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["ids", "width", "packed", "floor"])

    return questions.mapInArrow(ask, QUESTIONS)


def _rounds(blocks: DataFrame, most_bytes: int) -> Iterator[list]:
    """The rows of ``blocks``, streamed to the driver in rounds of about ``most_bytes``."""
    held, size = [], 0
    for row in blocks.toLocalIterator():
        held.append((*_unpack(row), np.array(row["floor"])))
        size += len(row["packed"])
        if size >= most_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, rows: int = 8192, round_bytes: int = 32 << 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the k greatest inner products of each query with the vectors
    of its width other than itself, ties to the smaller id.

    Both tables hold ``vec_id`` and ``v`` (array of longs whose products fit a long). An id is one
    candidate and one query however many rows it has: of several rows the best score counts. Rows
    with a null id or vector take no part; fewer than k candidates give fewer rows; an empty table
    gives an empty result; other columns are ignored.

    Queries are a stated set: they go out in rounds of about ``round_bytes``, each broadcast to the
    candidates' blocks, which stay where they are. Blocks are in descending length (a range
    partitioning). First all queries meet, on the executors, the block of the longest vectors, which
    gives each its floor: the k-th score there, from which all blocks prune. A task hands over at
    most k rows a query; each round's are added to a table in the checkpoint folder.
    """
    spark = vectors.sparkSession
    usable = vectors.select("vec_id", "v").filter("vec_id is not null and v is not null").withColumn("__n", F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    asked = queries.select("vec_id", "v").filter("vec_id is not null and v is not null")
    ordered = usable.repartitionByRange(F.desc("__n"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("__n"), "vec_id")
    candidates = checkpointed(blocks_of(ordered, rows, 4 << 20))
    longest = candidates.orderBy(F.desc("longest")).limit(1).collect()  # one block, a bounded number of bytes
    head = spark.sparkContext.broadcast(longest[0].asDict()) if longest else None
    questions = checkpointed(_with_floors(blocks_of(asked, 2048, 1 << 20).drop("longest", "axes"), head, k))

    def search(shared):
        def meet(batches):
            asked = [Questions(ids, own, k, floor) for ids, own, floor in shared.value]
            for batch in batches:
                for row in batch.to_pylist():
                    block = _block(row)
                    for some in asked:
                        if some.vectors.shape[1] == block.width:
                            some.search(block)
            for some in asked:
                yield some.found()

        return candidates.mapInArrow(meet, FOUND)

    path, none = shared_path(spark), True
    for some in _rounds(questions, round_bytes):
        shared = spark.sparkContext.broadcast(some)
        search(shared).write.mode("append").parquet(path)
        shared.destroy()
        none = False
    return _ranked(spark.createDataFrame([], FOUND) if none else spark.read.schema(FOUND).parquet(path), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query. One shuffle by query; rows are sorted, never gathered."""
    each = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "embeddings")
    vectors = table.select("vec_id", whole_numbers(F.col("embedding"), 256).alias("v"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p : p[1] * p[2])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
