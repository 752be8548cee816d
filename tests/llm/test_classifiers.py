"""Language and toxicity: exact against plain restatements, and held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from atlasweave.llm import langid, toxicity
from atlasweave.llm.common import split_of


def plain_bits(samples, order, text):
    """Code length of ``text`` under one language's contexts."""
    counts = defaultdict(Counter)
    for s in samples:
        data = b"\0" * order + s.lower().encode()
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts[data[i - k : i]][data[i]] += 1
    total, data = 0.0, b"\0" * order + text.lower().encode()
    for i in range(order, len(data)):
        for k in range(order, -2, -1):
            if k < 0:
                total += 8
                break
            seen = counts.get(data[i - k : i])
            if not seen:
                continue
            n, kinds = sum(seen.values()), len(seen)
            if data[i] in seen:
                total -= math.log2(seen[data[i]] / (n + kinds))
                break
            total -= math.log2(kinds / (n + kinds))
    return total


def test_code_lengths(prose):
    samples = {x: [prose(x, 40, i) for i in range(3)] for x in ("en", "de")}
    trees = langid.ContextTrees(samples, 3)
    texts = [prose("en", 20, 9), prose("de", 20, 9), "ÄÖ unseen ☃ xyz", "t"]
    bits, n = trees.code_lengths(texts)
    for i, t in enumerate(texts):
        assert n[i] == len(t.lower().encode())
        for j, lang in enumerate(trees.languages):
            assert abs(bits[i, j] - plain_bits(samples[lang], 3, t)) < 1e-2


def test_language_accuracy(spark, odd, none, prose):
    rows = [(i, prose(lang, 30, i), lang) for i, lang in enumerate(["en", "de", "fr", "es"] * 60)]
    df = spark.createDataFrame([*rows, (999, None, "en"), (998, "x", None)], "doc_id long, text string, lang string")
    trees = langid.train(df.filter(split_of(F.col("doc_id")) != 1), per_language=20)
    assert trees.languages == ["de", "en", "es", "fr"]
    got = {r["doc_id"]: r for r in langid.identify(df, trees).collect()}
    held = [r for r in rows if __import__("zlib").crc32(str(r[0]).encode()) % 3 == 1]
    assert sum(got[i]["lang_pred"] == lang for i, _, lang in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    out = langid.identify(odd, trees)
    assert set(out.columns) == set(odd.columns) | {"bits_per_byte"}
    assert {r["doc_id"] for r in out.filter("lang_pred = 'und'").collect()} == {2, 3, 4, 5}
    assert langid.identify(none, trees).isEmpty()
    empty = langid.train(none)
    assert empty.languages == []
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_marginals_are_exact():
    r = np.random.default_rng(1)
    lengths = np.array([3, 0, 200, 64, 65, 1])
    scores, t = r.normal(size=lengths.sum()) * 3, r.normal(size=(2, 2)) * 2
    want, at = [], 0
    for n in lengths:
        e, at = scores[at : at + n], at + n
        if not n:
            continue
        f, b = np.zeros((n, 2)), np.zeros((n, 2))
        f[0, 1] = e[0]
        for i in range(1, n):
            for y in (0, 1):
                f[i, y] = np.logaddexp(f[i - 1, 0] + t[0, y], f[i - 1, 1] + t[1, y]) + y * e[i]
        for i in range(n - 2, -1, -1):
            for y in (0, 1):
                b[i, y] = np.logaddexp(t[y, 0] + b[i + 1, 0], t[y, 1] + e[i + 1] + b[i + 1, 1])
        want += list(1 / (1 + np.exp((f + b)[:, 0] - (f + b)[:, 1])))
    assert np.abs(toxicity.marginals(scores, lengths, t) - want).max() < 1e-9


def test_gradient_equals_numeric_differentiation():
    r = np.random.default_rng(2)
    lengths = np.array([4, 1, 0, 7, 66])
    tokens = r.integers(0, 6, lengths.sum())
    y = r.integers(0, 2, lengths.sum()).astype(bool)
    model = toxicity.ToxicModel(list("abcde"))
    params = [model.own, model.left, model.right, model.transitions]
    for p in params:
        p += r.normal(size=p.shape)

    def loss():
        """Negative log-likelihood by plain recursion over whole sequences."""
        scores, total, at = model.scores(tokens, lengths), 0.0, 0
        for n in lengths:
            e, own, at = scores[at : at + n], y[at : at + n].astype(int), at + n
            if not n:
                continue
            f = np.array([0.0, e[0]])
            gold = e[0] * own[0]
            for i in range(1, n):
                f = np.array([np.logaddexp(f[0] + model.transitions[0, b], f[1] + model.transitions[1, b]) + b * e[i] for b in (0, 1)])
                gold += model.transitions[own[i - 1], own[i]] + own[i] * e[i]
            total += np.logaddexp(*f) - gold
        return total

    for p, g in zip(params, toxicity.gradient(model, tokens, lengths, y), strict=True):
        for k in np.ndindex(p.shape):
            p[k] += 1e-5
            up = loss()
            p[k] -= 2e-5
            slope = (up - loss()) / 2e-5
            p[k] += 1e-5
            assert abs(slope - g[k]) < 1e-4


def test_words_keep_their_places():
    for text in ["Vile WORDS", "İstanbul vile", "ẞ İ vile", "Ünï vile"]:
        assert [w.lower() for w in toxicity.WORD.findall(toxicity.spoken(text))] == toxicity.words_of(text)
        assert len(toxicity.spoken(text)) == len(text)


def test_toxicity(spark, odd, none, prose):
    bad = ["vile", "nasty", "awful", "wicked"]
    rows = []
    for i in range(240):
        words, toxic = prose("en", 60, i).split(), i % 4 == 0
        if toxic:
            words[5], words[20], words[40] = bad[i % 3], bad[(i + 1) % 4], bad[(i // 4) % 4]
        rows.append((i, " ".join(words), int(toxic)))
    train = [r for r in rows if r[0] % 3]
    model = toxicity.train([r[1] for r in train], [r[2] for r in train])
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(df, model).collect()}
    held = [r for r in rows if r[0] % 3 == 0]
    assert sum(got[i]["predicted"] == y for i, _, y in held) >= 0.97 * len(held)
    i, text, _ = rows[0]
    assert {text[s["start"] : s["end"]] for s in got[i]["toxic_spans"]} <= set(bad)
    assert got[i]["toxic_spans"]
    out = toxicity.score_toxicity(odd, model)
    assert set(out.columns) == set(odd.columns) | {"predicted", "toxic_spans"}
    assert out.filter("predicted = 1 or score < 0 or score > 1 or score is null").isEmpty()
    assert toxicity.score_toxicity(none, model).isEmpty()
    untaught = toxicity.train([], [])
    assert toxicity.score_toxicity(odd, untaught, spans=False).filter("predicted = 1").isEmpty()


def test_training_rows(spark, odd):
    labels = spark.createDataFrame([(1, 0, 1), (1, 0, 0), (2, 1, 1), (None, 1, 1), (7, 1, None), (5, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r["doc_id"], r["toxic"]) for r in toxicity.training_rows(odd, labels))
    assert got == [(1, 1), (1, 1), (5, 0)]
    assert toxicity.training_rows(odd, labels.limit(0)) == []
