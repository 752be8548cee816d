"""Token counts with a two-tier lookup, and the chunk encoder that it and packing share.

A *chunk* is a maximal run of characters other than ASCII white space. The vocabularies of the
``tokenizers`` kind used here never form a token across white space and normalise character by
character, so the ids of a text are the ids of its chunks one after another.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from array import array
from collections import Counter
from itertools import chain

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import TextBlocks, no_cycle_collection, read_table, resident

#: How the vocabulary file splits (a fixed value), and the same for lower-case Latin-1 characters.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_PRETOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\sa-zªµºß-öø-ÿ0-9²³¹¼½¾]+")
_ODD = re.compile(r"[^\x21-\x3b\x3d-\x7e\xa1-\xac\xae-\xff]")  # outside Latin-1, or "<", which added tokens begin with
#: Byte-level vocabularies write bytes that are no visible Latin-1 character as U+0100 and on, in order.
STAND_INS = {b: 256 + n for n, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])}
_ASCII_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
_PYTHON_ONLY_SPACE = re.compile(r"[\x1c-\x1f]")


def chunks_of(text: str) -> list[str]:
    """The chunks of ``text``; str.split() also cuts at U+001C-001F, which are no white space here."""
    if _PYTHON_ONLY_SPACE.search(text):
        return [x for x in _ASCII_SPACE.split(text) if x]
    return text.split()


class ChunkEncoder:
    """Chunk -> its ids (bytes, four to an id, little-endian) or their number, cached in the worker.

    Frequent chunks may be given beforehand (``seed``); they are never evicted. Misses of a whole
    block of texts are split into pre-tokens together, and only pre-tokens not held yet reach the
    library's merges. Both caches are bounded by ``limit`` entries.
    """

    def __init__(self, path: str, numbers: bool = False, seed: dict | None = None, limit: int = 1_000_000, longest: int = 64):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.numbers, self.limit, self.longest = numbers, limit, longest
        self.seed = seed or {}
        self.chunks: dict = dict(self.seed)
        self.pieces: dict = {}
        with open(path) as f:
            spec = json.load(f)
        parts = [*((spec.get("pre_tokenizer") or {}).get("pretokenizers") or ()), {}, {}]
        # the shortcut by pre-tokens is only known to hold for this pattern and these added tokens
        self.by_pretoken = (
            parts[0].get("pattern", {}).get("Regex") == LATIN_PATTERN
            and (parts[1].get("type"), parts[1].get("add_prefix_space")) == ("ByteLevel", False)
            and all("<" in x["content"] for x in spec.get("added_tokens", ()))
        )

    def _merged(self, pieces: list[str]) -> list:
        """Values of pre-tokens, straight from the library's merges: each byte as its stand-in character."""
        split = self.library.model.tokenize
        found = [split(p if p.isascii() else p.encode().decode("latin-1").translate(STAND_INS)) for p in pieces]
        return list(map(len, found)) if self.numbers else [array("I", [t.id for t in f]).tobytes() for f in found]

    def _library(self, texts: list[str]) -> list:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return list(map(len, found)) if self.numbers else [array("I", e.ids).tobytes() for e in found]

    def _learn(self, chunks: set[str]) -> dict:
        """Values of chunks not held; those too long to be kept are only returned."""
        if len(self.chunks) + len(chunks) > self.limit + len(self.seed):
            self.chunks = dict(self.seed)
        if len(self.pieces) > self.limit:
            self.pieces = {}
        plain: dict[str, list[str]] = {}
        whole: list[str] = []
        for c in chunks:
            if self.by_pretoken and c.isascii() and c.isalpha():
                plain[c] = [c.lower()]
            elif self.by_pretoken and c.isascii() and c[:-1].isalpha() and c.isprintable() and c[-1] != "<":
                plain[c] = [c[:-1].lower(), c[-1]]  # a word and one visible sign or digit: control characters have stand-ins
            elif self.by_pretoken and not _ODD.search(c):
                plain[c] = LATIN_PRETOKEN.findall(c.lower())
            else:
                whole.append(c)
        unseen = list({p for ps in plain.values() for p in ps}.difference(self.pieces))
        self.pieces.update(zip(unseen, self._merged(unseen), strict=True))
        get = self.pieces.__getitem__
        join = sum if self.numbers else b"".join
        made = {c: get(ps[0]) if len(ps) == 1 else join(map(get, ps)) for c, ps in plain.items()}
        made.update(zip(whole, self._library(whole), strict=True))
        self.chunks.update((c, v) for c, v in made.items() if len(c) <= self.longest)
        return made

    def values(self, texts: list[str | None]) -> list:
        """For each text its ids as bytes, or their number."""
        with no_cycle_collection():
            return self._values(texts)

    def _values(self, texts: list[str | None]) -> list:
        out: list = []
        for _, block in TextBlocks(1 << 18)(texts):
            split = [chunks_of(t) for t in block]
            every = list(chain.from_iterable(split))
            found = list(map(self.chunks.get, every))
            if None in found:
                made = self._learn({c for c, v in zip(every, found, strict=True) if v is None})
                found = [made[c] if v is None else v for c, v in zip(every, found, strict=True)]
            at = 0
            for chunks in split:
                own = found[at : at + len(chunks)]
                out.append(sum(own) if self.numbers else b"".join(own))
                at += len(chunks)
        return out


def worker_encoder(path: str, limit: int) -> ChunkEncoder:
    """The encoder of this worker process; workers outlive tasks, so its cache does as well."""
    return resident(f"encoder:{path}:{limit}", lambda: ChunkEncoder(path, limit=limit))


def worker_counts(key: str, shared, texts: list[str | None]) -> list[int]:
    """Counts by the two tiers: the broadcast table of ``key``, then this worker's cache."""

    def make() -> ChunkEncoder:
        path, words, lengths = shared.value
        seed = dict(zip(words.decode().split("\n") if words else (), lengths, strict=True))
        return ChunkEncoder(path, numbers=True, seed=seed)

    return resident(key, make).values(texts)


SUMS = "node long, chunks string, sums array<long>"


def _summary(node: int, seen: Counter[str], most: int) -> pa.RecordBatch:
    """One row: the ``most`` most frequent chunks, which hold no line feed, and their sums."""
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:most]
    columns = [[node], ["\n".join(c for c, _ in top)], [[n for _, n in top]]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.list_(pa.int64())), strict=True)], [x.split()[0] for x in SUMS.split(", ")])


def frequent_chunks(docs: DataFrame, text: str, size: int, per_task: int, longest: int = 64, fan: int = 100) -> list[str]:
    """The most frequent chunks of all texts. Each task counts its own rows and hands over one row, a
    summary of its ``per_task`` most frequent chunks; summaries are merged ``fan`` at a time, level
    by level, into summaries of at most ``size`` chunks, until one is left. So no chunk is shuffled
    by itself, and no task holds more than ``fan`` summaries: three levels take a million tasks, and the
    driver gets one row. The list only decides what is looked up quickly, never a count."""

    def pruned(seen: Counter[str]) -> Counter[str]:
        return Counter(dict(seen.most_common(100_000))) if len(seen) > 300_000 else seen

    def count(batches):
        seen: Counter[str] = Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    seen.update(chunks_of(t))
            seen = pruned(seen)
        yield _summary(TaskContext.get().partitionId(), Counter({c: n for c, n in seen.items() if len(c) <= longest}), per_task)

    def merge(key, table):
        seen: Counter[str] = Counter()
        for chunks, sums in zip(table.column("chunks"), table.column("sums"), strict=True):
            sums = sums.as_py()
            seen.update(dict(zip(chunks.as_py().split("\n") if sums else (), sums, strict=True)))
            seen = pruned(seen)
        return pa.Table.from_batches([_summary(key[0].as_py(), seen, size)])

    sums = docs.select(text).mapInArrow(count, SUMS)
    for _ in range(3):
        sums = sums.withColumn("node", F.floor(F.col("node") / fan)).groupBy("node").applyInArrow(merge, SUMS)
    found = sums.select("chunks").collect()  # one row
    return [c for r in found for c in r["chunks"].split("\n") if c]


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", limit: int = 2048, table_size: int = 65_536, per_task: int = 4096
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit for every row.

    A null text counts as empty (0 bytes, 0 tokens); no text is cut. Repeated rows stay repeated,
    an empty table gives an empty one, columns of those three names are replaced. ``table_size``
    bounds the broadcast table (entries of at most 64 characters: a few MB at most).
    """
    spark = docs.sparkSession
    words = frequent_chunks(docs, text, table_size, per_task)
    sizes = ChunkEncoder(vocabulary, numbers=True).values(words)
    kept = [(w, n) for w, n in zip(words, sizes, strict=True) if n < 256]
    shared = spark.sparkContext.broadcast((vocabulary, "\n".join(w for w, _ in kept).encode(), bytes(n for _, n in kept)))
    key = uuid.uuid4().hex

    @F.pandas_udf("long")
    def measure(texts: pd.Series) -> pd.Series:
        return pd.Series(worker_counts(key, shared, texts.tolist()), dtype="int64")

    taken = {"n_bytes", "n_tokens", "over_limit"}
    rest: list[Column] = [F.col(f"`{c}`") for c in docs.columns if c not in taken]
    made = docs.select(*rest, F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"), measure(F.col(text)).alias("n_tokens"))
    return made.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
