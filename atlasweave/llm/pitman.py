"""Hierarchical Pitman-Yor language model of word pairs, sampled and applied where the counts are.

Every word is a context with a restaurant, whose customers are the words that follow it; all restaurants
share the root, whose customers are their tables and whose dishes come from a uniform base. A Gibbs sweep
draws how many tables each dish of each restaurant has, given the restaurant's other tables and the
parent's predictive probabilities, then the root's. Predictive probabilities are averaged over sweeps.

Restaurants are dealt to shards by context, merged over all blocks of documents and stored in buckets, with
the places of every block's pairs among them; frequent contexts are dealt by pair, and frequent pairs by
block. Common words are known to all tasks and go by rank, others by hash. The root is dealt by word. A round
passes two messages: shards tell the root how many tables serve a word, the root answers with its own counts.
Shards score the pairs of a block, and the block, which keeps the documents of its tokens, sums them up.
"""

from __future__ import annotations

import math
import pickle
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import no_cycle_collection, read_table, shared_path, written

#: Tokens of a block of documents (one longer text is a block by itself) and, about, of a shard.
BLOCK, SHARD = 4_000_000, 2_200_000
#: Documents of a block.
MOST_DOCS = 30_000
#: Words of a block that are known by more than their hashes at a time, but for one text's.
MOST_WORDS = 1 << 16
#: Tokens that are hashed or sorted at a time, so that a task's arrays of 64-bit numbers are short; a 16th of a block, if that is more.
AT_ONCE = 1 << 18
#: Words with this share of all tokens or more are common.
COMMON = 2e-6
#: Lowest bits of a score that aren't sent: 36 of a double's 52 bits behind the point are, a relative error under 7.3e-12.
CUT = np.uint64(16)
#: Dishes up to this many customers are seated by exact weights, others by their limit.
EXACT = 64
#: The end of a text, which is also what stands before its first word. No word is empty.
END = b""
ROWS = "shard int, block long, pairs binary, places binary, n array<int>"


def mixed(x: np.ndarray) -> np.ndarray:
    """Numbers whose bits all depend on all bits of unsigned 64-bit ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def paired(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(u * np.uint64(0x9E3779B97F4A7C15) + mixed(w + np.uint64(1)))


def uniform(u: np.ndarray, w: np.ndarray, turn: int) -> np.ndarray:
    """Numbers between 0 and 1 that depend on a pair and a turn alone, so that every shard draws alike."""
    x = mixed(paired(u, w) + np.uint64(0xD1B54A32D192ED03 * (turn + 1) % (1 << 64)))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


def of_sorted(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where the wanted ones stand among sorted values, -1 for those that aren't there."""
    if not len(values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
    return np.where(values[at] == wanted, at, -1)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as bytes: whole numbers in as few bytes as hold them, first all first bytes, then all second ones."""
    out = []
    for x in arrays:
        narrow = x if x.dtype.kind == "f" or not len(x) else x.astype(np.min_scalar_type(int(x.max())), copy=False)
        out.append((narrow.dtype.str, np.ascontiguousarray(narrow).view(np.uint8).reshape(len(x), narrow.itemsize).T.tobytes()))
    return zstandard.compress(pickle.dumps(out, protocol=5), 3)


def unpacked(data: bytes) -> list[np.ndarray]:
    planes = [(np.dtype(t), np.frombuffer(x, np.uint8)) for t, x in pickle.loads(zstandard.decompress(data))]
    return [np.ascontiguousarray(x.reshape(t.itemsize, -1).T).view(t).ravel() for t, x in planes]


def steps(x: np.ndarray) -> np.ndarray:
    """Rising hashes as the steps between them, which are smaller numbers."""
    return np.diff(x, prepend=np.zeros(1, np.uint64))


def climbed(x: np.ndarray) -> np.ndarray:
    return np.cumsum(x, dtype=np.uint64)


def short(x: np.ndarray) -> np.ndarray:
    """Doubles, rounded to the bits above CUT, as whole numbers."""
    return (x.view(np.uint64) + (np.uint64(1) << (CUT - np.uint64(1)))) >> CUT


def long(x: np.ndarray) -> np.ndarray:
    return (x.astype(np.uint64) << CUT).view(np.float64)


class Seats:
    """Numbers of tables of dishes under a discount."""

    def __init__(self, discount: float):
        self.discount = discount
        logs = np.full((EXACT + 1, EXACT + 1), -np.inf)  # generalised Stirling numbers
        logs[0, 0] = 0.0
        t = np.arange(EXACT + 1)
        for c in range(1, EXACT + 1):
            stay = np.full(EXACT + 1, -np.inf)
            stay[1:c] = logs[c - 1, 1:c] + np.log(c - 1 - discount * t[1:c])
            logs[c, 1:] = np.logaddexp(logs[c - 1, :-1], stay[1:])
        self.logs = logs

    def drawn(self, c: np.ndarray, weight: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Tables of dishes of c customers, a new one weighing ``weight``, from two uniform numbers: from
        the full conditional, in proportion to S(c, t) weight^t, up to EXACT customers; beyond that from
        its limit for many customers, 1 + Poisson(weight / discount)."""
        out = np.ones(len(c), np.int64)
        small = np.flatnonzero((c > 1) & (c <= EXACT))
        small = small[np.argsort(c[small], kind="stable")]
        sizes, counts = np.unique(c[small], return_counts=True)
        ends = np.cumsum(counts)
        for size, lo, hi in zip(sizes.tolist(), (ends - counts).tolist(), ends.tolist(), strict=True):
            t = np.arange(1, size + 1)
            block = 1 + 400_000 // size
            for a in range(lo, hi, block):
                own = small[a : min(hi, a + block)]
                logs = self.logs[size, 1 : size + 1] + t * np.log(weight[own])[:, None]
                sums = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
                out[own] = 1 + (sums < x[own, None] * sums[:, -1:]).sum(axis=1)
        large = np.flatnonzero(c > EXACT)
        mean = weight[large] / self.discount
        few, many = large[mean <= 50], large[mean > 50]
        rate = weight[few] / self.discount
        share = np.exp(-rate)
        reached, k, left = share.copy(), 0, np.arange(len(few))
        while len(left := left[x[few[left]] > reached[left]]) and k < 500:
            k += 1
            share[left] *= rate[left] / k
            reached[left] += share[left]
            out[few[left]] += 1
        rate = weight[many] / self.discount
        normal = np.sqrt(-2 * np.log(x[many])) * np.cos(2 * np.pi * y[many])
        out[many] = 1 + np.maximum(0, np.rint(rate + np.sqrt(rate) * normal)).astype(np.int64)
        return np.minimum(out, c)


class Block:
    """Tokens of consecutive documents: numbers of words, and their hashes. After MOST_WORDS words are known, hashes take
    their place and they get new numbers, so that memory is bounded by tokens and not by words."""

    def __init__(self):
        self.words: dict[bytes, int] = {END: 0}
        self.hashes: list[np.ndarray] = []
        self.hashed = 0
        self.tokens = array("i", [0])  # an end stands before the first document
        self.lengths: list[int] = []
        self.trained: list[bool] = []
        self.keys: list = []

    @property
    def size(self) -> int:
        return len(self.tokens) - 1

    def add(self, key, trained: bool, words: list[bytes]) -> None:
        number, before = self.words, self.hashed
        self.tokens.extend([number.setdefault(w, before + len(number)) for w in words])
        self.tokens.append(number[END])
        self.lengths.append(len(words) + 1)
        self.trained.append(trained)
        self.keys.append(key)
        if len(number) > MOST_WORDS:
            self.settle()

    def settle(self) -> None:
        self.hashes.append(np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words)))
        self.hashed += len(self.words)
        self.words = {END: self.hashed}

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the words, sorted, and of every token its context and word, as places among these, and the place of its
        document."""
        self.settle()
        hashes, place = np.unique(np.concatenate(self.hashes), return_inverse=True)
        tokens = place.astype(np.int32)[np.frombuffer(self.tokens, np.int32)]
        return hashes, tokens[:-1], tokens[1:], np.repeat(np.arange(len(self.lengths), dtype=np.uint16), self.lengths)


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Block]:
    """Blocks of (key, learned from, text) batches: words are runs without a space or the control characters
    that break lines or cells, with A-Z in lower case. Texts become bytes of Python one at a time."""
    block = Block()
    for batch in batches:
        texts = batch.column(2).cast(pa.large_binary())
        for key, trained, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, strict=True):
            words = (text.as_py() or b"").lower().split()
            if block.keys and (block.size + len(words) >= size or len(block.keys) >= MOST_DOCS):
                yield block
                block = Block()
            block.add(key, bool(trained), words)
    if block.keys:
        yield block


def of_blocks(batches: Iterator[pa.RecordBatch], size: int, made: Callable[[Block, int], Iterator[pa.RecordBatch]]) -> Iterator[pa.RecordBatch]:
    """What is made of every block and its place among the task's. A block and all that came of it are let go before the next
    one is gathered."""
    with no_cycle_collection():
        own, count = blocks(batches, size), 0
        while (block := next(own, None)) is not None:
            out, block = made(block, count), None
            yield from out
            out, count = None, count + 1


def as_long(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def as_hash(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)


def firsts(x: np.ndarray) -> np.ndarray:
    """Where sorted numbers change."""
    return np.flatnonzero(np.diff(x, prepend=x[:1] - 1))


class Part:
    """Distinct pairs ``u``, ``w`` in rising order with ``n`` tokens each that are learned from. Words are the ranks of
    common ones, then places among the part's others; ``known`` has the hashes of both."""

    def __init__(self, data: bytes, common: np.ndarray):
        rare, contexts, follow, moves, n = unpacked(data)
        follow, ends = follow.astype(np.int64), np.cumsum(follow, dtype=np.int64)
        sums = np.cumsum(moves, dtype=np.int64)
        before = np.concatenate([np.zeros(1, np.int64), sums])[ends - follow]
        self.u, self.w = np.repeat(np.cumsum(contexts, dtype=np.int64), follow), sums - np.repeat(before, follow)
        self.n, self.rare = n.astype(np.int64), climbed(rare)
        self.known = np.concatenate([common, self.rare])

    @staticmethod
    def of(u: np.ndarray, w: np.ndarray, n: np.ndarray, rare: np.ndarray, common: int) -> bytes:
        """From pairs whose numbers from ``common`` on are places among the sorted hashes ``rare``, of which those in
        use are stored."""
        first = firsts(u)
        contexts = u[first]
        used = np.unique(np.concatenate([contexts[contexts >= common], w[w >= common]]))
        contexts, w = (np.where(x >= common, common + np.searchsorted(used, x), x) for x in (contexts, w))
        moves = np.diff(w, prepend=0)
        moves[first] = w[first]
        return packed(steps(rare[used - common]), np.diff(contexts, prepend=0), np.diff(np.append(first, len(u))), moves, n)


def merged(parts: list[bytes], common: np.ndarray) -> tuple[bytes, list[bytes]]:
    """The pairs of all parts as one, and the places of each part's among them."""
    own = [Part(data, common) for data in parts]
    rare, keys, k = np.unique(np.concatenate([x.rare for x in own])), [], len(common)
    for x in own:
        number = np.concatenate([np.arange(k), k + np.searchsorted(rare, x.rare)])
        keys.append((number[x.u] << 32) | number[x.w])
    pairs, place = np.unique(np.concatenate(keys), return_inverse=True)
    n = np.bincount(place, weights=np.concatenate([x.n for x in own]), minlength=len(pairs)).astype(np.int64)
    places = np.split(place, np.cumsum([len(x) for x in keys])[:-1])
    return Part.of(pairs >> 32, pairs & 0xFFFFFFFF, n, rare, k), [packed(np.diff(x, prepend=0)) for x in places]


class Frequent:
    """Contexts and pairs, sorted, that are dealt more finely, and the common words by falling frequency."""

    def __init__(self, contexts: np.ndarray, pairs: np.ndarray, common: np.ndarray):
        self.contexts, self.pairs, self.common = contexts, pairs, common
        self.rank = np.argsort(common)

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of common words, places behind these of all others, and the others' hashes, sorted."""
        at = of_sorted(self.common[self.rank], hashes)
        found, rare = np.flatnonzero(at >= 0), np.unique(hashes[at < 0])
        out = len(self.common) + np.searchsorted(rare, hashes)
        out[found] = self.rank[at[found]]
        return out, rare

    def shards(self, hashes: np.ndarray, u: np.ndarray, w: np.ndarray, block: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Shards of pairs, and the shards that are home to the frequent ones."""
        out = (mixed(hashes) % np.uint64(n)).astype(np.min_scalar_type(n))[u]
        crowded, homes = of_sorted(self.contexts, hashes) >= 0, np.zeros(n, bool)
        for lo in range(0, len(u), AT_ONCE):
            own = lo + np.flatnonzero(crowded[u[lo : lo + AT_ONCE]])
            pair = paired(hashes[u[own]], hashes[w[own]])
            by_block = of_sorted(self.pairs, pair) >= 0
            homes[pair[by_block] % np.uint64(n)] = True
            out[own] = np.where(by_block, mixed(pair + np.uint64(block)), pair) % np.uint64(n)
        return out, np.flatnonzero(homes)


def frequent(docs: DataFrame, size: int, bar: float) -> Frequent:
    """Contexts and pairs with a share of tokens over about ``bar``, or 1 in 100,000 if that is more, and the words
    with one over about COMMON.

    A block reports those over half that share of its own tokens, a bounded number; a word's reports
    therefore lack no more than half the bar. So no more than 200,000 of each and 1,000,000 words are collected."""
    bar = max(bar, 1e-5)

    def report(block: Block, _: int) -> Iterator[pa.RecordBatch]:
        hashes, u, w, _ = block.pairs()
        n = np.bincount(u, minlength=len(hashes))
        often = n >= max(2, bar / 2 * len(u))
        own = np.flatnonzero(often[u] & often[w])  # a word is as often a context
        pairs, m = np.unique(paired(hashes[u[own]], hashes[w[own]]), return_counts=True)
        often = m >= max(2, bar / 2 * len(u))
        pairs, m = pairs[often], m[often]
        often = n >= max(2, min(bar, COMMON) / 2 * len(u))
        contexts, n = hashes[often], n[often]
        kinds = [1] * len(contexts) + [2] * len(pairs) + [0]
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(as_long(np.concatenate([contexts, pairs, np.zeros(1, np.uint64)]))), pa.array([*n.tolist(), *m.tolist(), len(u)], pa.int64())], ["kind", "key", "n"])

    def reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return of_blocks(batches, size, report)

    totals = written(docs.mapInArrow(reports, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n")))
    whole = totals.filter("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bars = F.when(F.col("kind") == 1, min(bar, COMMON)).otherwise(bar)
    found = totals.filter("kind > 0").filter(F.col("n") >= bars * whole / 2).select("kind", "key", "n").toArrow()  # under 2 / bar of each kind
    kind, key, n = (found.column(i).to_numpy() for i in range(3))
    key = as_hash(key)
    words, of_word = key[kind == 1], n[kind == 1]
    return Frequent(np.sort(words[of_word >= bar * whole / 2]), np.sort(key[kind == 2]), words[np.lexsort((words, -of_word))])


def labels(spark: SparkSession, n: int) -> np.ndarray:
    """Numbers of ``n`` shards of which Spark deals one to each of ``n`` partitions."""
    found = spark.range(40 * n + 400).select(F.col("id").cast("int").alias("id")).groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id")).orderBy("p").collect()  # one row a shard
    if len(found) < n:
        raise ValueError(f"no numbers for {n} shards")
    return np.array([r[1] for r in found], np.int32)


def home_of(block: int, names: np.ndarray) -> int:
    """The shard that keeps a block's documents."""
    return int(names[int(mixed(np.array([block], np.uint64))[0]) % len(names)])


def dealt(docs: DataFrame, often: Frequent, names: np.ndarray, size: int) -> DataFrame:
    """A row of every block for every shard with its ``pairs``, and one with the keys of its documents in ``keys``,
    their numbers of tokens in ``n``, and in ``places`` the documents of all tokens, shard by shard and pair by pair, and how
    many tokens each pair has."""
    kind = docs.schema[0].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast((often, names))
    keys = pa.list_(docs.limit(0).toArrow().schema.field(0).type)

    def rows(shards, number: int, **values: list) -> pa.RecordBatch:
        kinds = {"pairs": pa.binary(), "places": pa.binary(), "n": pa.list_(pa.int32()), "keys": keys}
        arrays = [pa.array(values.get(c, [None] * len(shards)), kind) for c, kind in kinds.items()]
        return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array([number] * len(shards), pa.int64()), *arrays], ["shard", "block", *kinds])

    def deal(block: Block, number: int, often: Frequent, names: np.ndarray) -> Iterator[pa.RecordBatch]:
        hashes, u, w, d = block.pairs()
        shard, homes = often.shards(hashes, u, w, number, len(names))
        codes, rare = often.numbers(hashes)
        trained = np.array(block.trained, bool)
        ends = np.cumsum(np.bincount(shard, minlength=len(names)))
        own = np.union1d(np.flatnonzero(np.diff(ends, prepend=0)), homes)
        documents, m, done = np.empty_like(d), [], 0
        # consecutive shards that hold about AT_ONCE tokens together, 16 such groups at most and one more
        group = ends[own] // max(AT_ONCE, len(u) // 16 + 1)
        for some in np.split(own, firsts(group)[1:]):
            at = np.flatnonzero((shard >= some[0]) & (shard <= some[-1]))
            pair, of_shard = (codes[u[at]] << 32) | codes[w[at]], shard[at]
            order = np.argsort(pair)
            order = order[np.argsort(of_shard[order], kind="stable")]
            pair, of_shard, place = pair[order], of_shard[order].astype(np.int64), d[at[order]]
            new = np.flatnonzero((np.diff(pair, prepend=-1) != 0) | (np.diff(of_shard, prepend=-1) != 0))
            n = np.add.reduceat(trained[place].astype(np.int64), new) if len(new) else new
            documents[done : done + len(place)] = place
            done += len(place)
            m.append(np.diff(np.append(new, len(pair))).astype(np.uint32))
            pair, lows = pair[new], np.searchsorted(of_shard[new], some)
            parts = [Part.of(pair[lo:hi] >> 32, pair[lo:hi] & 0xFFFFFFFF, n[lo:hi], rare, len(often.common)) for lo, hi in zip(lows.tolist(), [*lows[1:].tolist(), len(pair)], strict=True)]
            yield rows(names[some], number, pairs=parts)
        del u, w, d, shard
        yield rows([home_of(number, names)], number, places=[packed(documents, np.concatenate(m))], n=[block.lengths], keys=[block.keys])

    def deals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, known = TaskContext.get().partitionId(), shared.value
        return of_blocks(batches, size, lambda block, count: deal(block, (task << 24) + count, *known))

    return docs.mapInArrow(deals, f"{ROWS}, keys array<{kind}>")


def gathered(rows: DataFrame, often: Frequent, shards: int) -> DataFrame:
    """The dealt rows by shard: one with the ``pairs`` of all blocks, and for every block the ``places`` of its own among
    them. Rows of documents stay as they are."""
    shared = rows.sparkSession.sparkContext.broadcast(often.common)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for shard, block, pairs in zip(*[batch.column(c).to_pylist() for c in ("shard", "block", "pairs")], strict=True):
                if pairs is not None:
                    held.setdefault(shard, []).append((block, pairs))
            yield batch.filter(pc.is_valid(batch.column("keys")))
            schema = batch.schema
        while held:  # all rows of a shard are in one partition
            shard, own = held.popitem()
            pairs, places = merged([x for _, x in own], shared.value)
            n = len(own)
            arrays = [[shard] * (n + 1), [-1, *[b for b, _ in own]], [pairs, *[None] * n], [None, *places], [None] * (n + 1), [None] * (n + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(arrays, schema, strict=True)], schema=schema)

    return rows.repartition(shards, "shard").mapInArrow(gather, rows.schema)


def bucketed(df: DataFrame, n: int, column: str) -> DataFrame:
    """``df``, dealt by ``column`` to ``n`` partitions, as a table of the shared folder in as many buckets, so that joins on
    the column leave it where it is."""
    name = f"buckets_{uuid.uuid4().hex}"
    df.write.format("parquet").option("path", shared_path(df.sparkSession)).bucketBy(n, column).saveAsTable(name)
    return df.sparkSession.table(name)


class Rules:
    """Parameters and totals that all shards know; ``rounds`` has (customers, tables) of the root in each round."""

    def __init__(self, names: np.ndarray, often: Frequent, strength: float, root_strength: float):
        self.names, self.often, self.strength, self.root_strength = names, often, strength, root_strength
        self.shards = len(names)
        self.rounds: list[tuple[int, int]] = []
        #: customers of the frequent pairs, and customers and each round's tables of the frequent contexts
        self.pair_parts: tuple[np.ndarray, np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.context_customers = np.zeros(len(often.contexts), np.int64)
        self.context_tables: list[np.ndarray] = []
        self.tokens = self.words = 0
        self.discount = self.root_discount = 0.5

    def root(self, k: int, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The root's predictive probabilities in round k; one share is left for all unknown words."""
        c, t = self.rounds[k]
        d, s = self.root_discount, self.root_strength
        return (customers - d * tables + (s + d * t) / (self.words + 1)) / (s + c)


def numbered(codes: np.ndarray, known: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, of codes and more hashes, and the places of these among them."""
    used = np.zeros(len(known), bool)
    used[codes] = True
    number = np.cumsum(used) - 1
    values, place = np.unique(np.concatenate([known[used], more]), return_inverse=True)
    place = place.astype(np.int32)
    return values, np.concatenate([place[number[codes]], place[len(place) - len(more) :]])


class Restaurants:
    """All pairs of a shard, as they are stored, then frequent ones that it counts without having any."""

    def __init__(self, rows: pd.DataFrame, name: int, rules: Rules):
        self.rules = rules
        self.shard = int(np.flatnonzero(rules.names == name)[0])
        part = Part(rows.loc[rows["pairs"].notna(), "pairs"].iloc[0], rules.often.common)
        u, w, self.c = part.known[part.u], part.known[part.w], part.n
        # customers of frequent pairs are counted over all shards; they are this shard's if it is their home
        pu, pw, customers = rules.pair_parts
        pairs = paired(pu, pw)
        by = np.argsort(pairs)
        home = pairs % np.uint64(rules.shards) == np.uint64(self.shard)
        self.own = np.ones(len(u), bool)
        if len(pu):
            among = of_sorted(pairs[by], paired(u, w))
            spread = np.flatnonzero(among >= 0)
            at = by[among[spread]]
            self.c[spread], self.own[spread] = customers[at], home[at]
            home[at] = False
        more = np.flatnonzero(home)
        self.u, self.w = np.concatenate([u, pu[more]]), np.concatenate([w, pw[more]])
        self.c, self.own = np.concatenate([self.c, customers[more]]), np.concatenate([self.own, np.ones(len(more), bool)])
        self.contexts, self.context_of = numbered(part.u, part.known, pu[more])
        words, word_of = numbered(part.w, part.known, pw[more])
        home = (mixed(words) % np.uint64(rules.shards)).astype(np.int64)
        by = np.argsort(home, kind="stable")  # by shard of the root, then by word
        place = np.empty(len(by), np.int32)
        place[by] = np.arange(len(by))
        self.words, self.home, self.word_of = words[by], home[by], place[word_of]
        self.crowded = of_sorted(rules.often.contexts, self.contexts)
        self.customers = self.of_contexts(np.where(self.own, self.c, 0), rules.context_customers)

    def of_contexts(self, value: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """Sums by context; those of frequent contexts are known from all shards."""
        sums = np.bincount(self.context_of, weights=value, minlength=len(self.contexts)).astype(np.int64)
        if len(whole):
            sums = np.where(self.crowded >= 0, whole[self.crowded], sums)
        return sums

    def of_words(self, value: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_of, weights=np.where(self.own, value, 0), minlength=len(self.words)).astype(np.int64)

    def messages(self, name: int, *values: np.ndarray, words: bool) -> pd.DataFrame:
        """For every shard of the root the sums of each value by word, with the words if they aren't known
        there yet; and the sums of frequent contexts for root -1."""
        sums, none = [self.of_words(v) for v in values], np.zeros(0, np.int64)
        cuts = np.flatnonzero(np.diff(self.home)) + 1
        spans = [(lo, hi) for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.words)], strict=True) if hi > lo]
        rows = [(int(self.rules.names[self.home[lo]]), name, packed(*([steps(self.words[lo:hi])] if words else []), *[x[lo:hi] for x in sums]), none, none, none) for lo, hi in spans]
        crowded = np.flatnonzero(self.crowded >= 0)
        if len(crowded):
            mine = [np.bincount(self.context_of, weights=np.where(self.own, v, 0), minlength=len(self.contexts)).astype(np.int64)[crowded] for v in values]
            rows.append((-1, name, None, as_long(self.contexts[crowded]), mine[0], mine[-1]))
        made = pd.DataFrame(rows, columns=["root", "shard", "data", "w", "a", "b"])
        made["one"], made["two"] = 0, 0
        if len(made) and words:
            made.loc[0, ["one", "two"]] = [int(((self.c == k) & self.own).sum()) for k in (1, 2)]
        return made

    def sweeps(self, answers: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tables of all pairs and of all contexts in round 0, one a pair, and in every later round that the
        answers, (customers, tables) of each word at the root, allow."""
        rules, seats = self.rules, Seats(self.rules.discount)
        t = (self.c > 0).astype(np.int64)
        some = np.flatnonzero(self.c > 1)
        for k, (customers, tables) in enumerate(answers):
            whole = rules.context_tables[k] if k < len(rules.context_tables) else np.zeros(0, np.int64)
            own = self.of_contexts(np.where(self.own, t, 0), whole)
            yield t, own
            weight = (rules.strength + rules.discount * own[self.context_of[some]]) * rules.root(k, customers, tables)[self.word_of[some]]
            t = t.copy()
            t[some] = seats.drawn(self.c[some], weight, uniform(self.u[some], self.w[some], 2 * k), uniform(self.u[some], self.w[some], 2 * k + 1))
        yield t, np.zeros(0, np.int64)


def answers_of(messages: pd.DataFrame, restaurants: Restaurants) -> list[tuple[np.ndarray, np.ndarray]]:
    """The root's counts by round, in the order of the shard's words."""
    place, out = {int(n): i for i, n in enumerate(restaurants.rules.names)}, []
    for turn in sorted(messages["turn"].unique().tolist()):
        own = messages[messages["turn"] == turn]
        own = own.iloc[np.argsort([place[r] for r in own["root"]])]
        both = [unpacked(x) for x in own["data"]]
        out.append(tuple(np.concatenate([x[i] for x in both]).astype(np.int64) for i in (0, 1)))
        if len(out[-1][0]) != len(restaurants.words):
            raise ValueError("the root answered other words than it was told")
    return out


MESSAGE = "root int, shard int, data binary, w array<long>, a array<long>, b array<long>, one long, two long"
ANSWER = "shard int, root int, turn int, data binary, state binary, c long, t long, words long, one long, two long"
COLUMNS = [f.split()[0] for f in ANSWER.split(", ")]


def counted(of_pairs: DataFrame, rules: Rules) -> DataFrame:
    """Round 0's messages: how many pairs end in a word, and tokens; in ``one`` and ``two`` how many pairs
    have one and two."""

    def count(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        own = Restaurants(rows, int(key[0]), rules)
        return own.messages(int(key[0]), (own.c > 0).astype(np.int64), own.c, words=True)

    return of_pairs.groupBy("shard").applyInPandas(count, MESSAGE)


def swept(of_pairs: DataFrame, answers: DataFrame, rules: Rules) -> DataFrame:
    """A later round's messages: how many tables serve a word."""

    def sweep(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=[f.split()[0] for f in MESSAGE.split(", ")])
        own = Restaurants(rows, int(key[0]), rules)
        (pairs, _), *later = answers_of(told, own)
        *_, (tables, _) = own.sweeps([(pairs, (pairs > 0).astype(np.int64)), *later])
        return own.messages(int(key[0]), tables, words=False)

    return of_pairs.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(sweep, MESSAGE)


def first_answers(messages: DataFrame, rules: Rules) -> DataFrame:
    """The root's side of round 0: pairs (customers of the root) and tokens of each word, over all shards, in ``data`` for
    every shard; in ``state`` what the root keeps, the places of the shard's words among its own. The
    first row of each shard of the root has its words and its totals."""

    def answer(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        told = [(climbed(w), *counts) for w, *counts in map(unpacked, rows["data"])]
        known, place = np.unique(np.concatenate([x[0] for x in told]), return_inverse=True)
        a, b = (np.bincount(place, weights=np.concatenate([x[i] for x in told]), minlength=len(known)).astype(np.int64) for i in (1, 2))
        at, out, none = 0, [], np.zeros(0, np.uint64)
        for shard, x in zip(rows["shard"].tolist(), told, strict=True):
            own = place[at : at + len(x[0])]
            at += len(x[0])
            out.append((shard, int(key[0]), 0, packed(a[own], b[own]), packed(own, none if out else steps(known)), 0, 0, 0, 0, 0))
        out[0] = (*out[0][:5], int(a.sum()), int(b.sum()), int((a > 0).sum()), int((a == 1).sum()), int((a == 2).sum()))
        return pd.DataFrame(out, columns=COLUMNS)

    return messages.filter("root >= 0").repartition(rules.shards, "root").groupBy("root").applyInPandas(answer, ANSWER)


def later_answers(messages: DataFrame, first: DataFrame, turn: int, rules: Rules) -> DataFrame:
    """The root's side of a later round: its customers, which are all shards' tables, and its own tables, drawn."""

    def answer(key: tuple, rows: pd.DataFrame, kept: pd.DataFrame) -> pd.DataFrame:
        told = {shard: unpacked(x)[0] for shard, x in zip(rows["shard"].tolist(), rows["data"], strict=True)}
        states = {shard: unpacked(x) for shard, x in zip(kept["shard"].tolist(), kept["state"], strict=True)}
        known = np.concatenate([climbed(s[1]) for s in states.values()])
        a = np.zeros(len(known), np.int64)
        for shard, x in told.items():
            a[states[shard][0]] += x  # a shard's words are distinct
        weight = np.full(len(known), (rules.root_strength + rules.root_discount * rules.rounds[-1][1]) / (rules.words + 1))
        b = np.where(a > 0, Seats(rules.root_discount).drawn(a, weight, uniform(known, known, 2 * turn), uniform(known, known, 2 * turn + 1)), 0)
        out = [(shard, int(key[0]), turn, packed(a[states[shard][0]], b[states[shard][0]]), None, 0, 0, 0, 0, 0) for shard in told]
        if out:
            out[0] = (*out[0][:5], int(a.sum()), int(b.sum()), 0, 0, 0)
        return pd.DataFrame(out, columns=COLUMNS)

    return messages.filter("root >= 0").groupBy("root").cogroup(first.groupBy("root")).applyInPandas(answer, ANSWER)


def _discount(one: int, two: int) -> float:
    """From how many were seen once and twice."""
    return min(0.95, max(0.05, one / (one + 2 * two) if one else 0.5))


def _frequent_sums(messages: DataFrame, rules: Rules, value: str) -> np.ndarray:
    """Sums of the frequent contexts, in their order: one row for each, no more than ``frequent`` gave."""
    sums = messages.filter("root = -1").select(F.explode(F.arrays_zip("w", value)).alias("x")).groupBy("x.w").agg(F.sum(f"x.{value}").alias("n")).collect() if len(rules.often.contexts) else []
    out = np.zeros(len(rules.often.contexts), np.int64)
    for r in sums:
        out[of_sorted(rules.often.contexts, as_hash(np.array([r[0]], np.int64)))[0]] = r[1]
    return out


def _pair_parts(of_pairs: DataFrame, rules: Rules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, words and tokens learned from of the frequent pairs, over all shards."""
    often = of_pairs.sparkSession.sparkContext.broadcast(rules.often)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                part = Part(data, often.value.common)
                own = np.flatnonzero((of_sorted(often.value.contexts, part.known) >= 0)[part.u])
                u, w = part.known[part.u[own]], part.known[part.w[own]]
                often_ = of_sorted(often.value.pairs, paired(u, w)) >= 0
                yield pa.RecordBatch.from_arrays([pa.array(as_long(u[often_])), pa.array(as_long(w[often_])), pa.array(part.n[own][often_])], ["u", "w", "n"])

    rows = of_pairs.select("pairs").mapInArrow(pick, "u long, w long, n long").groupBy("u", "w").agg(F.sum("n")).collect()  # no more than there are frequent pairs
    return as_hash(np.array([r[0] for r in rows], np.int64)), as_hash(np.array([r[1] for r in rows], np.int64)), np.array([r[2] for r in rows], np.int64)


def language_model_scores(
    docs: DataFrame, learned: str, text: str = "text", key: str = "doc_id", strength: float = 1.0, root_strength: float = 1.0, rounds: int = 3, averaged: int = 2, block: int = BLOCK, shard: int = SHARD
) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every document, learning from those for which
    the boolean column ``learned`` holds.

    Tokens are words in lower case (A-Z) and an end. ``score`` is the log10 probability of the text under the
    model of word pairs, averaged over the last ``averaged`` of ``rounds`` sweeps; ``base_score`` that of
    smoothed word frequencies; ``n_known`` tokens occur in what is learned from. Discounts follow from how
    many pairs and words were seen once and twice.

    Null texts are empty: an end alone. Null ``learned`` teaches nothing. Repeated rows are documents each; an
    empty table gives an empty result, and if nothing is learned all words are equally likely. Extra columns are
    ignored. A block holds ``block`` tokens or one text, and a shard about ``shard``, whatever the
    corpus; results depend on neither, but for the order of sums.
    """
    if not 1 <= averaged <= rounds:
        raise ValueError("averages are over the last of the rounds")
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(learned), F.lit(False)).alias("learned"), F.col(text).alias("text"))
    letters = own.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = max(1, math.ceil(letters / 6.4 / shard))
    often = frequent(own, block, 0.1 / shards)
    names = labels(spark, shards)
    table = bucketed(gathered(dealt(own, often, names, block), often, shards), shards, "shard")
    of_pairs = table.filter("pairs IS NOT NULL").select("shard", "pairs")
    rules = Rules(names, often, strength, root_strength)
    if len(often.pairs):
        rules.pair_parts = _pair_parts(of_pairs, rules)

    told = written(counted(of_pairs, rules))
    rules.context_tables.append(_frequent_sums(told, rules, "a"))
    rules.context_customers = _frequent_sums(told, rules, "b")
    one, two = told.agg(F.coalesce(F.sum("one"), F.lit(0)), F.coalesce(F.sum("two"), F.lit(0))).first()
    rules.discount = _discount(one, two)
    first = bucketed(first_answers(told, rules), shards, "root")
    totals = first.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("c", "t", "words", "one", "two")]).first()
    rules.tokens, rules.words, rules.root_discount = totals[1], totals[2], _discount(totals[3], totals[4])
    rules.rounds.append((totals[0], totals[2]))  # each word has one table at the root
    answers = first.select("shard", "root", "turn", "data")
    for turn in range(1, rounds + 1):
        told = written(swept(of_pairs, answers, rules))
        rules.context_tables.append(_frequent_sums(told, rules, "a"))
        later = written(later_answers(told, first.select("root", "shard", "state"), turn, rules))
        rules.rounds.append(tuple(later.agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(F.sum("t"), F.lit(0))).first()))
        answers = answers.unionByName(later.select("shard", "root", "turn", "data"))
    sums = scored(table.filter("keys IS NULL").select("shard", "block", "pairs", "places"), answers, rules, range(rounds - averaged + 1, rounds + 1))
    kind = docs.schema[key].dataType.simpleString()
    documents = table.filter("keys IS NOT NULL").select("shard", "block", "keys", "n", "places")
    tokens, words = rules.tokens, rules.words

    def gather(of_home: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        out, told = [], dict(list(told.groupby("block")))
        for block, keys, lengths, places in zip(rows["block"], rows["keys"], rows["n"], rows["places"], strict=True):
            d, m = unpacked(places)
            own = [unpacked(x) for x in told[block].sort_values("part")["data"]]
            model, seen = (np.repeat(np.concatenate([x[i] for x in own]), m) for i in (0, 1))
            base = np.log10((seen + 0.5) / (tokens + 0.5 * (words + 1)))
            base, score, known = (np.bincount(d, weights=x, minlength=len(keys)) for x in (base, long(model), seen > 0))
            out.append(pd.DataFrame({"key": list(keys), "n_tokens": lengths, "n_known": known.astype(np.int64), "base_score": base, "score": score}))
        return pd.concat(out) if out else pd.DataFrame([], columns=["key", "n_tokens", "n_known", "base_score", "score"])

    schema = f"key {kind}, n_tokens long, n_known long, base_score double, score double"
    made = documents.groupBy("shard").cogroup(sums.groupBy("shard")).applyInPandas(gather, schema)
    return made.select(F.col("key").alias(key), "n_tokens", "n_known", F.lit(rules.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def scored(of_blocks: DataFrame, answers: DataFrame, rules: Rules, sweeps: range) -> DataFrame:
    """(shard, block, part, data): for the shard that keeps a block's documents, the scores of the block's pairs of
    one shard, the ``part``, and how often their words are learned from."""

    def score(key: tuple, rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame([], columns=["shard", "block", "part", "data"])
        own = Restaurants(rows, int(key[0]), rules)
        (pairs, tokens), *later = answers_of(told, own)
        answered = [(pairs, (pairs > 0).astype(np.int64)), *later]
        total = np.zeros(len(own.u))
        for k, (tables, contexts) in enumerate(own.sweeps(answered)):
            if k in sweeps:
                rest = rules.strength + rules.discount * contexts
                p = rules.root(k, *answered[k])[own.word_of]
                total += (own.c - rules.discount * tables + rest[own.context_of] * p) / (rules.strength + own.customers[own.context_of])
        model, seen = short(np.log10(total / len(sweeps))), tokens[own.word_of]
        out = []
        for block, data in rows.loc[rows["places"].notna(), ["block", "places"]].itertuples(index=False):
            at = np.cumsum(unpacked(data)[0], dtype=np.int64)
            out.append((home_of(block, rules.names), block, own.shard, packed(model[at], seen[at])))
        return pd.DataFrame(out, columns=["shard", "block", "part", "data"])

    return of_blocks.groupBy("shard").cogroup(answers.groupBy("shard")).applyInPandas(score, "shard int, block long, part int, data binary")


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", (fold != 1).alias("learned"))
    made = language_model_scores(docs, "learned")
    return made.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
