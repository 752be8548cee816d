"""Spelling variants: words one edit apart, and the frequent form each rare one stands for.

The vocabulary is counted on Spark and filed by halves: two words an edit apart have the first half
of the shorter one in common, or else its second half. So words that share a beginning meet in one
task, and words that share an end in another. A task builds a minimal acyclic automaton of its words,
from the left or from the right, whose paths number the words; a word's half is followed exactly, and
the rest is completed with one error. A pair is found where it first differs, so by one task, once.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import no_cycle_collection, read_table, written

LETTERS = "A-Za-zÀ-ÿ"
#: Words that a task takes at a time, and that share a half before it is made longer.
GROUP = 20_000
#: Halves that are made longer at a time; more words than a MOST_KEYS-th of all are needed for one.
MOST_KEYS = 20_000


def count_words(docs: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 7, every: int = 31, held: int = 300_000) -> DataFrame:
    """(word, n): how often each word of at least ``shortest`` code points occurs in all whole texts.

    Words are maximal runs of letters up to U+00FF, with A-Z in lower case. Where ``every`` divides the CRC-32
    h of "key:run", the run's code point h % length is left out. A null key is the empty string there;
    null texts have no words; repeated rows count each. A task holds ``held`` counts at most.
    """
    run = re.compile(f"[{LETTERS}]{{{shortest},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        with no_cycle_collection():
            for batch in batches:
                for name, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    if not whole:
                        continue
                    # bytes know no other capitals than A-Z
                    lower = whole.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                    start = crc32(f"{name or ''}:".encode())
                    for word, n in Counter(run.findall(lower)).items():
                        h = crc32(word.encode(), start)
                        if h % every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < shortest:
                                continue
                        total[word] += n
                    if len(total) > held:
                        yield flushed()
            if total:
                yield flushed()

    counted = docs.select(F.col(key).cast("string"), F.col(text)).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Automaton:
    """Minimal acyclic automaton of sorted words. ``arcs[s]`` maps a character to the next state and to how
    many words of s come before those; the sums along a path are the word's number."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self.below: list[int] = []
        known: dict[tuple, int] = {}
        # the path of the word before, not yet in the automaton: (is a word, arcs)
        path: list[tuple[bool, dict[str, int]]] = [(False, {})]
        last = ""

        def settled(ends: bool, arcs: dict[str, int]) -> int:
            kind = (ends, *arcs.items())
            state = known.get(kind)
            if state is None:
                state = known[kind] = len(self.arcs)
                before, own = int(ends), {}
                for c, to in arcs.items():
                    own[c] = (to, before)
                    before += self.below[to]
                self.arcs.append(own)
                self.final.append(ends)
                self.below.append(before)
            return state

        for word in words:
            same = common(last, word)
            while len(path) > same + 1:
                state = settled(*path.pop())
                path[-1][1][last[len(path) - 1]] = state
            for _ in range(same, len(word)):
                path.append((False, {}))
            path[-1] = (True, path[-1][1])
            last = word
        while len(path) > 1:
            state = settled(*path.pop())
            path[-1][1][last[len(path) - 1]] = state
        self.start = settled(*path.pop())

    def rest(self, state: int, number: int, word: str, at: int) -> int:
        """The number of the word that goes on from a state as ``word`` does from ``at``; -1 if there is none."""
        arcs = self.arcs
        for i in range(at, len(word)):
            step = arcs[state].get(word[i])
            if step is None:
                return -1
            state = step[0]
            number += step[1]
        return number if self.final[state] else -1

    def near(self, word: str, exact: int) -> Iterator[tuple[int, int]]:
        """(number, length of the shorter one) of each word one edit away that agrees with ``word`` on
        ``exact`` characters at least; once each, where the two first differ."""
        arcs, rest, size = self.arcs, self.rest, len(word)
        state, number = self.start, 0
        for i in range(size + 1):
            own = word[i] if i < size else ""
            if i >= exact:
                for c, (to, before) in arcs[state].items():
                    if c != own:
                        if own:
                            found = rest(to, number + before, word, i + 1)  # another character
                            if found >= 0:
                                yield found, size
                        found = rest(to, number + before, word, i)  # one more
                        if found >= 0:
                            yield found, size
                if own and word[i + 1 : i + 2] != own:
                    found = rest(state, number, word, i + 1)  # one less
                    if found >= 0:
                        yield found, size - 1
            step = arcs[state].get(own)
            if step is None:
                return
            state = step[0]
            number += step[1]


def common(a: str, b: str) -> int:
    """How many characters two words begin with alike."""
    i = 0
    for x, y in zip(a, b):
        if x != y:
            break
        i += 1
    return i


def _completed(group: pd.DataFrame) -> pd.DataFrame:
    """Of each filed word of one direction: how many near words belong to its entry, and the first of them."""
    forward = bool(group["forward"].iloc[0])
    count = dict(zip(group["word"], group["n"].tolist(), strict=True))
    listed = sorted(count if forward else (w[::-1] for w in count))
    rows = []
    with no_cycle_collection():
        automaton = Automaton(listed)
        for word, m, lo, hi in zip(group["word"], group["m"].tolist(), group["lo"].tolist(), group["hi"].tolist(), strict=True):
            shorter = len(word) - 1
            exact = shorter // 2 if forward else shorter - shorter // 2
            many, best = 0, None
            for number, least in automaton.near(word if forward else word[::-1], exact):
                other = listed[number] if forward else listed[number][::-1]
                same = common(word, other)
                # the entry where a pair belongs is told by where it first differs
                if (same >= least // 2) == forward if m == 0 else least == m and lo <= same < hi:
                    many += 1
                    entry = (-count[other], other)
                    best = entry if best is None or entry < best else best
            if best is not None:
                rows.append((word, many, -best[0], best[1]))
    return pd.DataFrame(rows, columns=["word", "n_near", "near_n", "near"])


def _entry(forward: Column, m: Column, lo: Column, hi: Column) -> list[Column]:
    """Columns of an entry for pairs whose shorter word has m characters (0: any) and that first differ
    from ``lo`` on but before ``hi``: they share lo characters in front and m - hi at the end."""
    end = F.greatest(F.lit(0), m - hi)
    beginning, ending = F.substr("word", F.lit(1), lo), F.substr("word", F.length("word") - end + 1, end)
    return [forward.alias("forward"), m.alias("m"), lo.alias("lo"), hi.alias("hi"), F.concat_ws(" ", forward, m, lo, hi, beginning, ending).alias("entry")]


def _filed(words: DataFrame, shortest: int) -> DataFrame:
    """Each word under its beginning and under its end, as long as the halves of the shortest words."""
    both = words.withColumn("forward", F.explode(F.array(F.lit(True), F.lit(False))))
    half = shortest // 2
    key = F.when(F.col("forward"), F.substr("word", F.lit(1), F.lit(half))).otherwise(F.substr("word", F.length("word") - (shortest - half) + 1, F.lit(shortest - half)))
    zero = F.lit(0)
    return both.select("word", "n", "forward", zero.alias("m"), zero.alias("lo"), zero.alias("hi"), F.concat_ws(" ", "forward", key).alias("entry"))


def _filed_again(crowded: DataFrame, shortest: int) -> DataFrame:
    """Words of crowded entries under longer halves: first those of their own length and of one less, then
    the first and the second half of the places where a pair may differ."""
    size, half = F.length("word"), F.floor(F.col("s") / 2).cast("int")
    by_length = crowded.filter("m = 0").select("word", "n", "forward", F.explode(F.filter(F.array(size, size - 1), lambda m: m >= shortest)).alias("s"))
    first = by_length.select("word", "n", *_entry(F.col("forward"), F.col("s"), F.when(F.col("forward"), half).otherwise(0), F.when(F.col("forward"), F.col("s") + 1).otherwise(half)))
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    parts = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    halved = crowded.filter("m > 0").select("word", "n", "forward", "m", F.explode(parts).alias("p"))
    return first.unionByName(halved.select("word", "n", *_entry(F.col("forward"), F.col("m"), F.col("p.lo"), F.col("p.hi"))))


def near_words(words: DataFrame, shortest: int = 7, group: int = GROUP) -> DataFrame:
    """(word, n_near, near_n, near) for each of the distinct ``words(word, n)`` that has near words, which
    differ by one inserted, deleted or replaced code point: how many, and the one of largest n (ties: the
    smallest in code-point order). No word may be under ``shortest`` code points, itself two at least.

    ``words`` should be stored: it is read several times. Entries of over ``group`` words (or of a share of
    MOST_KEYS of all) are filed again under longer halves until none is left or the halves are all but one
    character, which few words share. Their keys alone are broadcast, fewer than MOST_KEYS at a time.
    """
    if shortest < 2:
        raise ValueError("words need two halves")
    total = words.count()
    todo, done = _filed(words, shortest), []
    while True:
        sizes = todo.groupBy("entry").agg(F.count("*").alias("c"))
        whole = todo.count() if done else 2 * total
        crowded = sizes.filter(F.col("c") > max(group, whole // MOST_KEYS)).select("entry")
        keys = written(crowded)
        if keys.isEmpty():
            done.append(todo)
            break
        over = todo.join(F.broadcast(keys), "entry", "left_semi")
        final = (F.col("m") > 0) & (F.col("hi") - F.col("lo") <= 1)
        done += [todo.join(F.broadcast(keys), "entry", "left_anti"), over.filter(final)]
        todo = written(_filed_again(over.filter(~final), shortest))
    filed = done[0]
    for more in done[1:]:
        filed = filed.unionByName(more)
    n = max(1, math.ceil(2 * total / group))
    dealt = filed.withColumn("bucket", F.pmod(F.xxhash64("entry"), F.lit(n)))
    found = dealt.groupBy("forward", "bucket").applyInPandas(_completed, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.n")).alias("near_n"), F.col("b.word").alias("near"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from ``forms(word, form)``, which has no circles: where a word's forms end. Each round
    doubles the steps taken."""
    reached = written(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if reached.join(onward, "root", "left_semi").isEmpty():
            return reached
        reached = written(reached.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")))


def spelling_variants(docs: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 7, least: int = 2, ratio: int = 10, group: int = GROUP) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of ``count_words`` that occur ``least`` times at least.

    A word's form is the near word of largest n, if that is at least ``ratio`` times (two at least) its own; else
    null, as is form_n. Its root is where forms end, itself if it has none. Forms grow by ``ratio``, so chains
    are short and have no circles. No document, no word or an empty table give an empty result; extra columns
    are ignored; texts may be of any length.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its word")
    words = written(count_words(docs, text, key, shortest).filter(F.col("n") >= least))
    joined = words.join(near_words(words, shortest, group), "word", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    named = written(joined.select("word", F.when(has, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(has, F.col("near_n")).alias("form_n")))
    ends = roots(named.filter("form is not null"))
    return named.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))
