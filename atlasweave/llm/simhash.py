"""SimHash fingerprints of word shingles, linked by multi-index hashing.

A 64-bit fingerprint has two segments of 32 bits. Two fingerprints that differ in at most 3 bits
differ in at most 1 bit of one segment, so each fingerprint is filed under the 33 values within 1
of each of its segments (a Hamming ball of radius 1); fingerprints that meet under a value are
compared in full. 32-bit segments keep the tables sparse: unrelated fingerprints hardly ever meet,
whatever the size of the corpus, while shorter segments would need more comparisons with every
document added.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import TextBlocks, checkpointed, fresh_names, read_table
from atlasweave.operators.components import components
from atlasweave.operators.skew import MOST_HOT, looked_up_by_key

SEED = 42
#: A table entry with more fingerprints than this is filed again under a finer key.
LARGEST_ENTRY = 16_384


def shingles(text: bytes, width: int) -> list[bytes]:
    words = text.lower().split()  # of bytes: lowers A-Z only, splits at 09-0D and 20 only
    if len(words) < width:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def fingerprints(texts: list[str | None], width: int = 3) -> np.ndarray:
    """Unsigned 64-bit fingerprints: a bit is 1 if over half of a text's shingle hashes have it."""
    import xxhash

    out = np.zeros(len(texts), np.uint64)
    for first, block in TextBlocks(1 << 20)(texts):
        hashes, counts = [], []
        for text in block:
            own = shingles(text.encode(), width)
            counts.append(len(own))
            hashes.extend(map(xxhash.xxh64_intdigest, own, repeat(SEED)))
        n = np.array(counts)
        full = np.flatnonzero(n)
        if not len(full):
            continue
        h = np.array(hashes, dtype="<u8")
        starts = np.concatenate([[0], np.cumsum(n[full])[:-1]])
        ones = np.zeros((len(full), 64), np.int64)
        step = 1 << 17  # rows of bits held at once
        for lo in range(0, len(h), step):
            bits = np.unpackbits(h[lo : lo + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            a, b = np.searchsorted(starts, lo, side="right") - 1, np.searchsorted(starts, lo + len(bits), side="left")
            cuts = np.maximum(starts[a:b] - lo, 0)
            ones[a:b] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
        out[first + full] = np.packbits(2 * ones > n[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def with_fingerprints(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, fp, a, b): the key, the fingerprint as a signed long, and a 128-bit hash of the text in two
    longs, which tells rows of one key apart. Null texts hash unlike empty ones."""
    kind = docs.schema[key].dataType.simpleString()
    there = F.col(text).isNotNull()
    own = docs.select(F.col(key).alias("id"), F.xxhash64(F.lit(1), there, text).alias("a"), F.xxhash64(F.lit(2), there, text).alias("b"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            fp = fingerprints(batch.column(3).to_pylist(), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), batch.column(1), batch.column(2)], ["id", "fp", "a", "b"])

    return own.mapInArrow(run, f"id {kind}, fp long, a long, b long")


def _probes(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table keys of each fingerprint: per segment its value and the 32 values one bit away."""
    masks = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(32, dtype=np.uint64))]).astype(np.uint64)
    low, high = fp & np.uint64(0xFFFFFFFF), fp >> np.uint64(32)
    keys = np.concatenate([low[:, None] ^ masks, (high[:, None] ^ masks) | np.uint64(1 << 32)], axis=1)
    return keys.ravel().view(np.int64), np.repeat(fp, 66).view(np.int64)


def _finer(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Finer keys for crowded entries: the entry's key and, of the other segment, each 16-bit half
    with the values within 1 of it. All but 16 bits are then known within 1 in each of two parts, so
    an entry has at most 33 * 17 * 2^16 fingerprints however many documents there are; of unrelated
    ones it has next to none. It is held in one task, 8 bytes a fingerprint."""
    fp = fp.view(np.uint64)
    other = np.where(key >> 32 == 0, fp >> np.uint64(32), fp & np.uint64(0xFFFFFFFF)).astype(np.uint64)
    masks = np.concatenate([[0], np.left_shift(np.uint64(1), np.arange(16, dtype=np.uint64))]).astype(np.uint64)
    halves = [((other >> np.uint64(16 * i)) & np.uint64(0xFFFF))[:, None] ^ masks | np.uint64(i << 16) for i in (0, 1)]
    fine = np.concatenate(halves, axis=1).astype(np.int64)
    return np.repeat(key, 34), fine.ravel(), np.repeat(fp.view(np.int64), 34)


def stars(fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what links of at most ``radius`` differing bits connect: each fingerprint
    to the first one of its component, so never more edges than fingerprints."""
    left, out = np.unique(fp.view(np.uint64)), []
    while len(left) > 1:
        seed, left, front = left[0], left[1:], left[:1]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            step = max(1, (1 << 20) // len(left))
            for lo in range(0, len(front), step):
                near |= (np.bitwise_count(front[lo : lo + step, None] ^ left) <= radius).any(axis=0)
            front, left = left[near], left[~near]
            out.extend((seed, x) for x in front)
    return out


def _entries(batches: Iterator[pa.RecordBatch], n_keys: int, largest: int | None) -> Iterator[np.ndarray]:
    """Runs of whole entries (rows: keys, fingerprint) from batches sorted by key; an entry of more
    than ``largest`` fingerprints is handed on in parts, so that it is never held whole."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys + 1)])
        held = [np.concatenate([*held, rows], axis=1)]
        if not held[0].shape[1]:
            continue
        last = np.flatnonzero((held[0][:n_keys] != held[0][:n_keys, -1:]).any(axis=0))
        cut = last[-1] + 1 if len(last) else 0
        if cut:
            yield held[0][:, :cut]
            held = [held[0][:, cut:]]
        if largest is not None and held[0].shape[1] > largest:
            yield held.pop()
    if held:
        yield held[0]


def links(prints: DataFrame, radius: int = 3, largest: int = LARGEST_ENTRY) -> DataFrame:
    """Edges (u, v) between distinct fingerprints that connect what links of at most ``radius`` (3
    at most) differing bits connect. ``prints`` has distinct fingerprints ``fp``, none of them null; an entry
    of more than ``largest`` of them is filed again under finer keys. An empty table gives an empty one."""
    if not 0 <= radius <= 3:
        raise ValueError("two segments with balls of radius 1 find differences of at most 3 bits")

    def file(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for lo in range(0, len(fp), 4096):
                keys, fps = _probes(fp[lo : lo + 4096].view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(fps)], ["key", "fp"])

    def meet(n_keys, crowded):
        def run(batches):
            sent: set[tuple[int, int]] = set()
            split = None  # the key of an entry that comes in parts
            for rows in _entries(batches, n_keys, largest if crowded else None):
                key, fp = rows[:n_keys], rows[n_keys]
                first = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
                size = np.diff(np.append(first, len(fp)))
                crowd = []
                if split is not None and len(fp) and key[0, 0] == split:  # the rest of a crowded entry
                    crowd.append(rows[:, : size[0]])
                    first, size = first[1:], size[1:]
                two = first[size == 2]
                near = np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= radius
                pairs = list(zip(fp[two][near].tolist(), fp[two + 1][near].tolist(), strict=True))
                for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                    if crowded and n > largest:
                        crowd.append(rows[:, at : at + n])
                        split = key[0, at]
                    else:
                        pairs.extend((int(np.uint64(a).view(np.int64)), int(np.uint64(b).view(np.int64))) for a, b in stars(fp[at : at + n], radius))
                new = {(a, b) if a < b else (b, a) for a, b in pairs}.difference(sent)
                if len(sent) < 1_000_000:
                    sent |= new
                u, v = [a for a, _ in new], [b for _, b in new]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(u), pa.int64()), pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["key", "u", "v"])
                for c in crowd:  # rows with a key are to be filed again
                    yield pa.RecordBatch.from_arrays([pa.array(c[0]), pa.array(c[1]), pa.array(c[1])], ["key", "u", "v"])

        return run

    def file_again(batches):
        for batch in batches:
            key, fp = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo in range(0, len(fp), 4096):
                a, b, c = _finer(key[lo : lo + 4096], fp[lo : lo + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(c)], ["key", "fine", "fp"])

    filed = prints.select("fp").mapInArrow(file, "key long, fp long")
    met = checkpointed(filed.repartition("key").sortWithinPartitions("key").mapInArrow(meet(1, True), "key long, u long, v long"))
    edges = met.filter("key is null").select("u", "v")
    crowded = met.filter("key is not null").select("key", "u")
    if not crowded.isEmpty():
        finer = crowded.mapInArrow(file_again, "key long, fine long, fp long")
        again = finer.repartition("key", "fine").sortWithinPartitions("key", "fine").mapInArrow(meet(2, False), "key long, u long, v long")
        edges = edges.unionAll(again.select("u", "v"))
    return edges


def _grouped(prints: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """Of stored ``prints(id, fp, a, b)``: (fp, component_id, n) of every fingerprint, n being how many
    rows have it, and (root, least): the first row of every component, by its key (null ones last) and
    its text's hash, once for each of its fingerprints."""
    row = F.struct(F.col("id").isNull().alias("no"), "id", "a", "b")
    distinct = checkpointed(prints.groupBy("fp").agg(F.min(row).alias("first"), F.count("*").alias("n")))
    roots = components(links(distinct, radius))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    sizes = rooted.groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("k"))
    named = checkpointed(looked_up_by_key(checkpointed(rooted), checkpointed(sizes), "root", "k"))
    return named.select("fp", F.col("least.id").alias("component_id"), "n"), named.select("root", "least")


def near_duplicates(docs: DataFrame, radius: int = 3, width: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id) for every row of ``docs``.

    component_id is the least key reachable over links of at most ``radius`` differing bits,
    through any documents. Null and empty texts have fingerprint zero and are linked like others;
    repeated rows stay; a null key stays and never names a component; other columns are ignored;
    an empty table gives an empty result. Copies are folded to one fingerprint before linking, so
    a group of copies costs as much as one document, and what a frequent fingerprint gets is broadcast.
    """
    prints = checkpointed(with_fingerprints(docs, key, text, width))
    named, _ = _grouped(prints, radius)
    found = looked_up_by_key(prints.select("id", "fp"), named, "fp", "n")
    return found.select(F.col("id").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = 3, width: int = 3, text: str = "text", key: str = "doc_id", most: int = 200_000) -> DataFrame:
    """The rows of ``docs`` without those that near-duplicate another: of each component of
    :func:`near_duplicates` one row stays, whole, the one with the least key (null ones last), of
    equal keys with the least hash of the text, of rows alike in both any one.

    Null and empty texts are near-duplicates of each other; an empty table gives an empty one; columns
    may have any names, and none is added. ``docs`` should be stored: it is read more than once. The rows that
    go are known by key and text hash. Up to ``most`` of those are broadcast, and then only rows alike in key
    and text are shuffled with their texts; beyond that the frequent ones are, and the rest joined by a shuffle.
    """
    prints = checkpointed(with_fingerprints(docs, key, text, width))
    _, first = _grouped(prints, radius)
    kept = first.select("least.id", "least.a", "least.b").distinct().withColumn("stays", F.lit(True))
    # of every (key, text) how many rows there are; those that go, and those of which one stays
    rows = prints.groupBy("id", "a", "b").agg(F.count("*").alias("n"))
    same = [rows[c].eqNullSafe(kept[c]) for c in ("id", "a", "b")]
    marked = rows.join(kept, same[0] & same[1] & same[2], "left").select(rows["id"], rows["a"], rows["b"], "n", F.coalesce("stays", F.lit(False)).alias("stays"))
    decided = checkpointed(marked.filter("n > 1 or not stays"))
    count, total, repeats = decided.agg(F.count("*"), F.sum("n"), F.count_if("stays")).first()
    if not count:
        return docs
    names = fresh_names(docs.columns, 5)
    there = F.col(text).isNotNull()
    hashed = docs.withColumns(dict(zip(names, (F.col(key), F.xxhash64(F.lit(1), there, text), F.xxhash64(F.lit(2), there, text)), strict=False)))
    other = decided.toDF(*(f"{x}k" for x in names[:3]), *names[3:])
    n, stays = names[3:]
    on = [F.col(x).eqNullSafe(F.col(f"{x}k")) for x in names[:3]]
    on = on[0] & on[1] & on[2]

    def split(df: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows that ``keys`` say nothing of, and those of which it says that one stays."""
        return df.join(keys, on, "left_anti"), df.join(keys.filter(F.col(stays)), on, "left_semi")

    if count <= most:
        left, parts = hashed, [F.broadcast(other)]
    else:  # all keys with many rows are among these; the others are shuffled
        bar = max(64, total // MOST_HOT)
        left, parts = hashed, [F.broadcast(other.filter(F.col(n) > bar)), other.filter(F.col(n) <= bar)]
    repeated = []
    for keys in parts:
        left, some = split(left, keys)
        repeated.append(some)
    out = left.drop(*names)
    for some in repeated if repeats else ():
        out = out.unionAll(some.dropDuplicates(names[:3]).drop(*names))
    return out


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
