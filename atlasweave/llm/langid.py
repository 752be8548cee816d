"""Language identification by prediction by partial matching (PPM, escape method C).

For each language a tree of byte contexts up to ``order`` bytes is counted on a bounded sample of
labelled texts and then frozen. A byte's code length under a language is that of the longest
context which has seen it, plus the escapes from the longer contexts that have not; the language
with the shortest code for the whole text is the prediction. The trees of all languages are kept as
one table a depth, whose rows hold the code length in every language, so a text is scored with one
lookup a byte for most bytes.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import TextBlocks, read_table, resident, sampled, split_of

LETTER = re.compile(r"[^\W\d_]")
UNDETERMINED = "und"


class HashIndex:
    """Row numbers of unsigned 64-bit keys, looked up for whole arrays at a time."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.append(keys, np.uint64(0))
        self.shift = np.uint64(64 - max(8, math.ceil(math.log2(max(len(keys), 1))) + 2))
        slot = self._slot(keys)
        self.head = np.full(1 << int(64 - self.shift), -1, np.int32)
        self.next = np.full(len(keys) + 1, -1, np.int32)
        order = np.argsort(slot, kind="stable")
        ordered = slot[order]
        last = np.append(ordered[1:] != ordered[:-1], True) if len(keys) else np.zeros(0, bool)
        self.head[ordered[last]] = order[last]
        same = np.flatnonzero(~last)
        self.next[order[same + 1]] = order[same]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The row of each key, -1 where there is none."""
        row = self.head[self._slot(keys)]
        wrong = np.flatnonzero((row >= 0) & (self.keys[row] != keys))
        while len(wrong):
            row[wrong] = self.next[row[wrong]]
            wrong = wrong[(row[wrong] >= 0) & (self.keys[row[wrong]] != keys[wrong])]
        return row


def grams(data: np.ndarray, n: int) -> np.ndarray:
    """The n bytes ending at each position as a number; ``data`` starts with n - 1 or more padding bytes."""
    out = data.astype(np.uint64)
    for k in range(1, n):
        out[k:] |= data[:-k].astype(np.uint64) << np.uint64(8 * k)
    return out


class ContextTrees:
    """Frozen code lengths of all languages."""

    def __init__(self, samples: dict[str, list[str]], order: int = 4):
        if not 1 <= order <= 7:
            raise ValueError("order is 1 to 7 bytes")
        self.order, self.languages = order, sorted(samples)
        width = len(self.languages)
        streams = [self._stream(samples[x])[0] for x in self.languages]
        below: np.ndarray | None = None  # code lengths at the next lower depth
        below_index: HashIndex | None = None
        self.levels: list[tuple[HashIndex, np.ndarray, HashIndex, np.ndarray]] = []
        for k in range(order + 1):
            counted = []
            for s in streams:
                g = grams(s, k + 1)[order:]
                counted.append(np.unique(g[s[order:] != 0], return_counts=True))
            keys = np.unique(np.concatenate([c[0] for c in counted])) if width else np.zeros(0, np.uint64)
            if k == 0:
                keys = np.arange(256, dtype=np.uint64)
            contexts = np.unique(keys >> np.uint64(8))
            escape = np.zeros((len(contexts) + 1, width), np.float32)
            context_of = np.searchsorted(contexts, keys >> np.uint64(8))
            if k:
                row = below_index(keys & np.uint64((1 << 8 * k) - 1))
                cost = below[row].copy()
            else:
                cost = np.full((len(keys), width), 8.0, np.float32)
            for j, (own, n) in enumerate(counted):
                if not len(own):
                    continue
                at = np.searchsorted(keys, own)
                total = np.bincount(context_of[at], weights=n, minlength=len(contexts))
                kinds = np.bincount(context_of[at], minlength=len(contexts))
                seen = total > 0
                escape[:-1][seen, j] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                cost[:, j] += escape[context_of, j]
                cost[at, j] = -np.log2(n / (total + kinds)[context_of[at]])
            below, below_index = np.concatenate([cost, np.zeros((1, width), np.float32)]), HashIndex(keys)
            self.levels.append((below_index, below, HashIndex(contexts), escape))

    def _stream(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the texts in lower case, each after ``order`` padding bytes; where each starts."""
        pad = b"\0" * self.order
        parts = [t.lower().encode("utf-8", "replace").replace(b"\0", b" ") for t in texts]
        data = np.frombuffer(b"".join(pad + p for p in parts), np.uint8)
        starts = np.concatenate([[0], np.cumsum([len(p) + self.order for p in parts])]).astype(np.int64)
        return data, starts

    def code_lengths(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each text in each language, and the texts' lengths in bytes."""
        data, starts = self._stream(texts)
        todo = np.flatnonzero(data)
        full = grams(data, self.order + 1)[todo] if len(data) else np.zeros(0, np.uint64)
        index, costs, _, _ = self.levels[self.order]
        row = index(full)
        bits = costs[row]  # row -1 is the row of zeros at the end
        missed, left = np.flatnonzero(row < 0), self.order
        while len(missed):
            g = full[missed] & np.uint64((1 << 8 * (left + 1)) - 1)
            index, costs, contexts, escape = self.levels[left]
            bits[missed] += escape[contexts(g >> np.uint64(8))]
            left -= 1
            index, costs, _, _ = self.levels[left]
            row = index(g & np.uint64((1 << 8 * (left + 1)) - 1))
            bits[missed] += costs[row]
            missed = missed[row < 0]
        at = np.searchsorted(todo, starts)
        sums = np.zeros((len(texts), len(self.languages)))
        n = np.diff(at)
        some = np.flatnonzero(n)
        if len(some):
            sums[some] = np.add.reduceat(bits, at[some], axis=0, dtype=np.float64)
        return sums, n


def predict(trees: ContextTrees, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, posterior under equal priors, and bits a byte in that language."""
    names, score, rate = [], np.zeros(len(texts)), np.zeros(len(texts))
    for first, block in TextBlocks(1 << 19)(texts):
        if not trees.languages:
            names += [UNDETERMINED] * len(block)
            continue
        bits, n = trees.code_lengths(block)
        best = bits.argmin(axis=1)
        least = bits[np.arange(len(block)), best]
        share = 1 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
        for i, text in enumerate(block):
            known = LETTER.search(text) is not None
            names.append(trees.languages[best[i]] if known else UNDETERMINED)
            if known:
                score[first + i], rate[first + i] = share[i], least[i] / max(n[i], 1)
    return names, score, rate


def worker_trees(key: str, shared) -> ContextTrees:
    return resident(key, lambda: pickle.loads(shared.value))


def train(labelled: DataFrame, order: int = 4, per_language: int = 400, longest: int = 65_536, text: str = "text", lang: str = "lang", key: str = "doc_id") -> ContextTrees:
    """Trees from at most ``per_language`` whole texts of each language, none of over ``longest`` bytes: of
    the different rows (key, language, text) those with the least hashes, copies only where room is left; rows
    that share a key, or have none, are chosen each by its text. Null languages and null or empty texts teach nothing."""
    usable = labelled.filter(F.col(lang).isNotNull() & F.octet_length(F.col(text)).between(1, longest))
    rows = sampled(usable.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.col(key).alias("key")), "lang", per_language).collect()
    samples: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["text"], str(r["key"]))):
        samples.setdefault(r["lang"], []).append(r["text"])
    return ContextTrees(samples, order)


def identify(docs: DataFrame, trees: ContextTrees, text: str = "text", out: str | None = None) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and bits_per_byte of every whole text.

    Null texts and texts without a letter are ``und`` with score 0; so is every text if nothing was
    learned. Ties go to the language that sorts first. Repeated rows stay; an empty table gives an
    empty result; columns of those three names are replaced, unless ``out`` names one column to
    hold all three. The trees' size is bounded by the sample they were counted on.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(pickle.dumps(trees)), uuid.uuid4().hex

    @F.pandas_udf("struct<lang_pred:string,score:double,bits_per_byte:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        names, score, rate = predict(worker_trees(key, shared), texts.tolist())
        return pd.DataFrame({"lang_pred": names, "score": score, "bits_per_byte": rate})

    if out is not None:
        return docs.withColumn(out, run(F.col(text)))
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score", "bits_per_byte")]
    made = docs.select(*kept, run(F.col(text)).alias("__found"))
    return made.select(*kept, "__found.*")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trees = train(docs.filter(split_of(F.col("doc_id")) != 1))
    held = F.coalesce(split_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return identify(docs.select("doc_id", held, "text"), trees).drop("text")
