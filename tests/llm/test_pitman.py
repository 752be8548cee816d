"""The Pitman-Yor model against a plain one of the same seed, however the work is dealt."""

import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from atlasweave.llm import pitman


def tokens_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split("[\x20\x09-\x0d]+", lower) if w] + [""]


class Plain:
    """One table of pairs, one dictionary a restaurant."""

    def __init__(self, texts, rounds=3, averaged=2):
        self.c, unigrams = Counter(), Counter()
        for t in texts:
            own = tokens_of(t)
            self.c.update(zip(["", *own], own))
            unigrams.update(own)
        self.unigrams, self.N, self.V = unigrams, sum(unigrams.values()), len(unigrams)
        d = self.d = pitman._discount(*[sum(x == k for x in self.c.values()) for k in (1, 2)])
        contexts = Counter(w for _, w in self.c)
        d0 = pitman._discount(*[sum(x == k for x in contexts.values()) for k in (1, 2)])
        self.customers = Counter()
        for (u, _), c in self.c.items():
            self.customers[u] += c
        t, t0 = dict.fromkeys(self.c, 1), dict.fromkeys(contexts, 1)
        self.samples, seats, root_seats = [], pitman.Seats(d), pitman.Seats(d0)
        for k in range(rounds + 1):
            if k:
                t = {pair: self.draw(seats, c, (1 + d * tables[pair[0]]) * root[pair[1]], *pair, k - 1) if c > 1 else 1 for pair, c in self.c.items()}
                served = Counter()
                for (_, w), n in t.items():
                    served[w] += n
                weight = (1 + d0 * sum(t0.values())) / (self.V + 1)
                contexts, t0 = served, {w: self.draw(root_seats, n, weight, w, w, k) for w, n in served.items()}
            tables = Counter()
            for (u, _), n in t.items():
                tables[u] += n
            C, T = sum(contexts.values()), sum(t0.values())
            self.new = (1 + d0 * T) / (1 + C) / (self.V + 1)
            root = {w: (n - d0 * t0[w]) / (1 + C) + self.new for w, n in contexts.items()}
            self.samples.append((t, tables, root, self.new))
        self.samples = self.samples[-averaged:]

    @staticmethod
    def draw(seats, c, weight, u, w, k):
        h = [np.array([xxhash.xxh64_intdigest(x.encode())], np.uint64) for x in (u, w)]
        x, y = (pitman.uniform(*h, 2 * k + i) for i in (0, 1))
        return int(seats.drawn(np.array([c]), np.array([weight]), x, y)[0])

    def probability(self, u, w):
        total = 0
        for t, tables, root, new in self.samples:
            own = self.c.get((u, w), 0) - self.d * t.get((u, w), 0)
            total += (own + (1 + self.d * tables[u]) * root.get(w, new)) / (1 + self.customers[u])
        return total / len(self.samples)

    def scores(self, text):
        own = tokens_of(text)
        base = sum(math.log10((self.unigrams[w] + 0.5) / (self.N + 0.5 * (self.V + 1))) for w in own)
        model = sum(math.log10(self.probability(u, w)) for u, w in zip(["", *own], own))
        return len(own), sum(self.unigrams[w] > 0 for w in own), self.N, base, model


def skewed(seed, n=300):
    """Texts of few words, one word and one pair of which are a third of all tokens."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    out = []
    for i in range(n):
        own = []
        for _ in range(r.randint(0, 25)):
            own += r.choice((["the", "the"], [r.choice(words)], [words[int(r.expovariate(0.3)) % 60], "OF"]))
        out.append((i, i % 5 != 1, r.choice((" ", "\n", "\x0b ")).join(own)))
    return out + [(7, True, None), (8, None, "unseen words here"), (None, False, "the w1 of"), (3, True, "the " * 400)]


def close(rows, expected):
    got = defaultdict(list)
    for r in rows:
        got[r["key"]].append((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]))
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in expected.items()}
    for k, v in expected.items():
        for a, b in zip(sorted(got[k]), sorted(v), strict=True):
            assert a[:3] == b[:3]
            assert a[3:] == pytest.approx(b[3:], rel=1e-9)


@pytest.mark.parametrize("block", [60, 700, pitman.BLOCK])
def test_equal_to_plain(spark, block):
    docs = skewed(1)
    model = Plain([t for _, learned, t in docs if learned])
    expected = defaultdict(list)
    for k, _, t in docs:
        expected[k].append(model.scores(t))
    df = spark.createDataFrame(docs, "key long, learned boolean, text string").repartition(3).selectExpr("*", "'x' AS shard", "1 AS block", "2 AS n_tokens")
    close(pitman.language_model_scores(df, "learned", key="key", block=block, shard=block).collect(), expected)


def test_model_is_a_distribution():
    model = Plain([t for _, learned, t in skewed(2) if learned])
    for u in ("", "the", "of", "w3", "never seen"):
        assert sum(model.probability(u, w) for w in [*model.unigrams, "an unknown word"]) == pytest.approx(1, abs=1e-9)


def test_better_than_word_frequencies_on_held_out_text(spark):
    r = random.Random(3)
    follows = {f"w{i}": [f"w{r.randrange(200)}" for _ in range(4)] for i in range(200)}

    def text():
        out = ["w0"]
        for _ in range(60):
            out.append(r.choice(follows[out[-1]]))
        return " ".join(out)

    df = spark.createDataFrame([(i, i % 5 != 1, text()) for i in range(200)], "doc_id long, learned boolean, text string")
    rows = pitman.language_model_scores(df, "learned").collect()
    held = [x for x in rows if x["doc_id"] % 5 == 1]
    assert sum(x["score"] for x in held) > 0.5 * sum(x["base_score"] for x in held)  # log10, so half is better


def test_tables_follow_their_conditional():
    """Draws have the frequencies of S(c, t) weight^t; the limit for many customers is near the exact mean."""
    seats, n = pitman.Seats(0.6), 40_000
    u = np.arange(n, dtype=np.uint64)
    x, y = pitman.uniform(u, u, 0), pitman.uniform(u, u, 1)
    for c, weight in ((2, 0.3), (5, 2.0), (64, 1.5)):
        drawn = seats.drawn(np.full(n, c), np.full(n, weight), x, y)
        s = {(0, 0): 1.0}
        for i in range(1, c + 1):
            for t in range(1, i + 1):
                s[i, t] = s.get((i - 1, t - 1), 0) + (i - 1 - 0.6 * t) * s.get((i - 1, t), 0)
        p = np.array([s[c, t] * weight**t for t in range(1, c + 1)])
        assert np.abs(np.bincount(drawn, minlength=c + 1)[1:] / n - p / p.sum()).max() < 0.01
    for weight in (0.5, 6.0, 60.0):
        drawn = seats.drawn(np.full(n, 10_000_000), np.full(n, weight), x, y)
        assert drawn.mean() == pytest.approx(1 + weight / 0.6, rel=0.02)
        assert drawn.var() == pytest.approx(weight / 0.6, rel=0.05)


def test_odd_rows(spark, odd, none):
    df = odd.selectExpr("*", "doc_id % 5 <> 1 AS learned")
    docs = [(r["doc_id"], r["learned"], r["text"]) for r in df.collect()]
    model = Plain([t for _, learned, t in docs if learned])
    expected = defaultdict(list)
    for k, _, t in docs:
        expected[k].append(model.scores(t))
    rows = pitman.language_model_scores(df, "learned").withColumnRenamed("key", "other").withColumnRenamed("doc_id", "key").collect()
    close(rows, expected)
    assert pitman.language_model_scores(none.selectExpr("*", "true AS learned"), "learned").count() == 0
    nothing = spark.createDataFrame([(1, None, "a b"), (2, False, "")], "doc_id long, learned boolean, text string")
    rows = {r["doc_id"]: r for r in pitman.language_model_scores(nothing, "learned").collect()}
    assert (rows[1]["n_tokens"], rows[1]["n_known"], rows[1]["train_tokens"], rows[1]["score"]) == (3, 0, 0, pytest.approx(0))


def test_what_moves_does_not_grow_with_the_shards(spark, monkeypatch):
    """Bytes a token that are dealt to shards and that come back as scores, with few shards and with many."""
    r, sizes = random.Random(4), {}
    docs = [(i, i % 5 != 1, " ".join(f"w{r.randrange(2000)}" for _ in range(150))) for i in range(800)]
    df = spark.createDataFrame(docs, "doc_id long, learned boolean, text string").coalesce(1)

    def measured(name):
        made = getattr(pitman, name)

        def wrapper(*args):
            out = made(*args)
            held = [f"coalesce(octet_length({f.name}), 0)" for f in out.schema if f.dataType.simpleString() == "binary"]
            sizes.setdefault(name, []).append(out.selectExpr(f"sum({' + '.join(held)}) / {151 * len(docs)}").first()[0])
            return out

        monkeypatch.setattr(pitman, name, wrapper)

    measured("dealt")
    measured("scored")
    rows = [sorted(pitman.language_model_scores(df, "learned", shard=shard).collect()) for shard in (40_000, 1500)]
    assert [x["score"] for x in rows[0]] == pytest.approx([x["score"] for x in rows[1]], rel=1e-9)
    for few, many in sizes.values():
        assert many < 1.5 * few, sizes
    assert sizes["scored"][1] < 9, sizes


def test_parts_meet():
    """Pairs of blocks with common and other words, merged, are those of all blocks, and every block finds its own."""
    r = np.random.default_rng(5)
    common, blocks = r.integers(1, 1 << 63, 40).astype(np.uint64), []
    others = r.integers(1, 1 << 63, 60).astype(np.uint64)
    often = pitman.Frequent(np.zeros(0, np.uint64), np.zeros(0, np.uint64), common)
    for n in (0, 1, 300):
        hashes = np.concatenate([common, r.permutation(others)[:30]])
        codes, rare = often.numbers(hashes)
        pairs = np.unique(r.integers(0, len(hashes), (n, 2)), axis=0)
        pairs = pairs[np.lexsort((codes[pairs[:, 1]], codes[pairs[:, 0]]))]
        u, w = codes[pairs[:, 0]], codes[pairs[:, 1]]
        counts = r.integers(0, 300, len(u))
        blocks.append((hashes[pairs[:, 0]], hashes[pairs[:, 1]], counts, pitman.Part.of(u, w, counts, rare, len(common))))
    data, places = pitman.merged([b[3] for b in blocks], common)
    whole, expected = pitman.Part(data, common), Counter()
    for (u, w, n, _), own in zip(blocks, places, strict=True):
        at = np.cumsum(pitman.unpacked(own)[0], dtype=np.int64)
        assert (whole.known[whole.u[at]] == u).all() and (whole.known[whole.w[at]] == w).all()
        for pair, c in zip(zip(u.tolist(), w.tolist(), strict=True), n.tolist(), strict=True):
            expected[pair] += c
    assert dict(zip(zip(whole.known[whole.u].tolist(), whole.known[whole.w].tolist(), strict=True), whole.n.tolist(), strict=True)) == dict(expected)
    x = np.log10(r.random(1000))
    assert pitman.long(pitman.short(x)) == pytest.approx(x, rel=7.3e-12)


def held(spark, monkeypatch, batch, often, at_once, words):
    """Of a task that reports blocks of 60,000 tokens, and of one that deals them to 40 shards: its rows, and the most bytes a
    token of a block that it held at once."""
    made, empty = [], spark.createDataFrame([], "key long, learned boolean, text string")

    def kept(df, function, schema):
        made.append(function)
        return spark.createDataFrame([], schema)

    with monkeypatch.context() as m:
        m.setattr(pitman, "AT_ONCE", at_once, raising=False)
        m.setattr(pitman, "MOST_WORDS", words, raising=False)
        m.setattr(pitman, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
        m.setattr(type(empty), "mapInArrow", kept)
        pitman.frequent(empty, 60_000, 1e-3)
        pitman.dealt(empty, often, np.arange(40, dtype=np.int32), 60_000)
        out = []
        for function in made:
            tracemalloc.start()
            rows = list(function(iter([batch])))  # Arrow's memory isn't traced
            most = tracemalloc.get_traced_memory()[1] / 60_000
            tracemalloc.stop()
            out.append(([r for x in rows for r in x.to_pylist()], most))
    return out


def test_a_task_holds_little_besides_its_tokens(spark, monkeypatch):
    """Words and numbers of 64 bits come and go, whatever a block holds, and what is reported and dealt stays the same."""
    r = random.Random(6)
    texts = [" ".join(r.choice(("the", "of", f"w{r.randrange(300)}", f"é{r.randrange(10**9)}")) for _ in range(600)) for _ in range(400)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(400)), pa.array([i % 5 != 1 for i in range(400)]), pa.array([*texts[:-1], None])], ["key", "learned", "text"])
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in (b"the", b"of", b"w1", b"")], np.uint64)
    often = pitman.Frequent(np.sort(hashes[:2]), np.sort(pitman.paired(hashes[:2], hashes[1::-1])), hashes[:3])
    (reported, report_bytes), (dealt, deal_bytes) = held(spark, monkeypatch, batch, often, 1 << 12, 1 << 10)
    assert report_bytes < 60
    assert deal_bytes < 60
    (reported_whole, _), (dealt_whole, _) = held(spark, monkeypatch, batch, often, 1 << 30, 1 << 30)

    def documents(rows):
        out = []
        for x in rows:
            d, m = pitman.unpacked(x["places"])
            out.append((x["block"], x["n"], x["keys"], sorted(zip(np.repeat(np.arange(len(m)), m).tolist(), d.tolist(), strict=True))))
        return out

    assert sorted(map(str, reported)) == sorted(map(str, reported_whole))
    assert [(x["shard"], x["block"], x["pairs"]) for x in dealt if x["pairs"]] == [(x["shard"], x["block"], x["pairs"]) for x in dealt_whole if x["pairs"]]
    assert documents([x for x in dealt if x["keys"]]) == documents([x for x in dealt_whole if x["keys"]])
    assert len({x["block"] for x in dealt}) == 5
