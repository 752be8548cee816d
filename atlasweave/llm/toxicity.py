"""Toxic spans by a linear-chain conditional random field (CRF).

Two labels a token. A token's potential is the sum of a weight of its word, one of the word before
and one of the word after; words that training didn't know share one weight. Marginals come from
forward-backward over whole texts; they name the offending tokens, and the text's score is a
calibrated function of the greatest marginal and of the number of offending tokens.

Labels are by document, so training first marks tokens: words are ranked by how much more often
toxic documents have them, each document counting for less the more ranked words explain it
already, so that words which merely accompany a toxic one aren't marked.
"""

from __future__ import annotations

import math
import pickle
import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import fresh_names, no_cycle_collection, read_table, resident, sampled, split_of, TextBlocks

WORD = re.compile(r"\w+")
WINDOW = 64
FLOOR = 1e-9
#: What a word's own weight is before and without evidence.
START = -6.0


def spoken(text: str) -> str:
    """The text in lower case if that keeps every character's place, else as it is."""
    low = text.lower()
    return low if len(low) == len(text) else text


def words_of(text: str) -> list[str]:
    low = spoken(text)
    return WORD.findall(low) if low is not text else [w.lower() for w in WORD.findall(text)]


def messages(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forward, backward, psi) of every token of concatenated sequences of ``lengths``: what the tokens
    before it and those after it say for label 1 against 0, as ratios, and its own potential of 1
    against 0.

    ``scores`` are the log-potentials of label 1 against 0, ``transitions[a, b]`` those of b after
    a. With two labels a message is one ratio and a step one linear fraction. Sequences are cut into
    windows: transfer matrices of all windows that another one follows are made together and chained
    from window to window, and each window is then filled from its own start, so long texts take
    no longer than short ones of the same sum. Nothing is cut off: the messages are exact.
    """
    n_windows = -(-lengths // WINDOW)
    total = int(n_windows.sum())
    owner = np.repeat(np.arange(len(lengths)), n_windows)
    first = np.cumsum(n_windows) - n_windows
    offset = (np.arange(total) - first[owner]) * WINDOW
    size = np.minimum(lengths[owner] - offset, WINDOW)
    begin = (np.cumsum(lengths) - lengths)[owner] + offset
    step = np.arange(WINDOW)
    there = step < size[:, None]
    at = np.where(there, begin[:, None] + step, 0)
    psi = np.exp(np.clip(np.where(there, scores[at] if len(scores) else 0.0, 0.0), -60, 60))
    heads = offset == 0

    def starts(psi, there, heads, a):
        """The ratio with which each window begins."""
        out = np.ones(len(heads))
        places = np.flatnonzero(heads)
        counts = np.diff(np.append(places, len(heads)))
        followed = np.flatnonzero(~np.append(heads[1:], True))
        if not len(followed):
            return out
        u0, u1, v0, v1 = np.ones(len(followed)), np.zeros(len(followed)), np.zeros(len(followed)), np.ones(len(followed))
        live = there[followed].T
        for t, own in enumerate(np.ascontiguousarray(psi[followed].T)):  # what label 0 and label 1 before the window come to
            x, y, before = u1 * own, v1 * own, (u0, u1, v0, v1)
            u0, u1, v0, v1 = u0 * a[0, 0] + x * a[1, 0], u0 * a[0, 1] + x * a[1, 1], v0 * a[0, 0] + y * a[1, 0], v0 * a[0, 1] + y * a[1, 1]
            norm = u0 + u1 + v0 + v1
            u0, u1, v0, v1 = u0 / norm, u1 / norm, v0 / norm, v1 / norm
            if not live[t].all():
                u0, u1, v0, v1 = (np.where(live[t], new, old) for new, old in zip((u0, u1, v0, v1), before, strict=True))
        row = np.cumsum(~np.append(heads[1:], True)) - 1  # of a followed window, among those
        now = np.ones(len(places))
        for w in range(1, int(counts.max())):
            more = counts > w
            places, counts, now = places[more], counts[more], now[more]
            k = row[places + w - 1]
            now = (u1[k] + now * v1[k]) / (u0[k] + now * v0[k])
            out[places + w] = now
        return out

    def run(psi, there, heads, a):
        """The message before each token's own potential."""
        ratio, out = starts(psi, there, heads, a), np.empty((WINDOW, len(psi)))
        for t, own in enumerate(np.ascontiguousarray(psi.T)):
            out[t] = ratio
            x = ratio * own
            ratio = (a[0, 1] + x * a[1, 1]) / (a[0, 0] + x * a[1, 0])
        return out.T

    a = np.exp(transitions)
    forward = run(psi, there, heads, a)
    # the same backwards: windows in reverse, tokens of each window reversed and moved to its front
    back = np.where(there, size[:, None] - 1 - step, step)
    rows = np.arange(total)[:, None]
    backward = run(psi[rows, back][::-1], there[::-1], np.append(offset[1:] == 0, True)[::-1] if total else heads, a.T)[::-1][rows, back]
    return forward[there], backward[there], psi[there]


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """P(label 1) of every token, exactly."""
    forward, backward, psi = messages(scores, lengths, transitions)
    odds = forward * psi * backward
    return odds / (1 + odds)


def inner_places(lengths: np.ndarray) -> np.ndarray:
    """Of all tokens but the first of all: whether one of the same sequence stands before it."""
    inner = np.ones(int(lengths.sum()), bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    return inner[1:]


def expectations(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(label 1) of every token, and the expected number of each pair of labels of neighbours."""
    forward, backward, psi = messages(scores, lengths, transitions)
    odds, inner, a = forward * psi * backward, inner_places(lengths), np.exp(transitions)
    left, right = (forward * psi)[:-1][inner], (psi * backward)[1:][inner]
    pairs = [np.full(len(left), a[0, 0]), a[0, 1] * right, a[1, 0] * left, a[1, 1] * left * right]
    total = pairs[0] + pairs[1] + pairs[2] + pairs[3]
    return odds / (1 + odds), np.array([(x / total).sum() for x in pairs]).reshape(2, 2)


class ToxicModel:
    """Frozen weights."""

    def __init__(self, words: list[str]):
        self.index = {w: i + 1 for i, w in enumerate(words)}  # 0: any other word
        n = len(words) + 1
        self.own, self.left, self.right = np.zeros(n), np.zeros(n), np.zeros(n)
        self.transitions = np.zeros((2, 2))
        self.telling = 0  # how many of the words marked toxic documents
        self.weights = np.array([1.0, 0.0, 0.0])

    def tokens(self, texts: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words of some texts, and how many each text has."""
        get, found, lengths = self.index.get, [], []
        for own in texts:
            found.extend([get(w, 0) for w in own])
            lengths.append(len(own))
        return np.array(found, np.int64), np.array(lengths, np.int64)

    def scores(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        out = self.own[tokens]
        if len(tokens) > 1:
            inner = inner_places(lengths)  # no word before the first
            out[1:] += np.where(inner, self.left[tokens[:-1]], 0)
            out[:-1] += np.where(inner, self.right[tokens[1:]], 0)
        return out

    def greatest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The greatest marginal of each text, all marginals, and the texts' numbers of tokens."""
        tokens, lengths = self.tokens(map(words_of, texts))
        p = marginals(self.scores(tokens, lengths), lengths, self.transitions)
        top, full = np.full(len(texts), FLOOR), np.flatnonzero(lengths)
        if len(full):
            top[full] = np.maximum.reduceat(p, (np.cumsum(lengths) - lengths)[full])
        return np.clip(top, FLOOR, 1 - FLOOR), p, lengths

    def features(self, top: np.ndarray, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each text: log-odds of the greatest marginal, log of one more than the number of
        offending tokens, and a constant."""
        sums = np.concatenate([[0], np.cumsum(p >= 0.5)])
        ends = np.cumsum(lengths)
        return np.stack([np.log(top / (1 - top)), np.log1p(sums[ends] - sums[ends - lengths]), np.ones(len(top))], axis=1)

    def calibrated(self, top: np.ndarray, p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(top, p, lengths) @ self.weights, -60, 60)))


def telling_words(texts: list[set[str]], toxic: np.ndarray, least: float = 1.5, odds: float = 3.5, share: float = 0.6) -> dict[str, float]:
    """Words that mark toxic documents, with their log-odds.

    The best remaining word is taken as long as the documents that have it, each at ``share`` of
    its weight for every word taken already, weigh ``least`` or more, and its smoothed log-odds are
    ``odds`` or more. Near copies should have been left out, since they share any word.
    """
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    in1, in0 = Counter(), Counter()
    for ws, t in zip(texts, toxic, strict=True):
        (in1 if t else in0).update(ws)
    logs = {w: math.log((c + 0.5) / (n1 + 1)) - math.log((in0[w] + 0.5) / (n0 + 1)) for w, c in in1.items() if c >= 3}
    able = {w for w, x in logs.items() if x >= odds}
    weight, has = [1.0] * len(texts), {}
    for i, ws in enumerate(texts):
        if toxic[i]:
            for w in ws & able:
                has.setdefault(w, []).append(i)
    taken: dict[str, float] = {}
    while has:
        value, word = max((sum(weight[i] for i in own), w) for w, own in has.items())
        if value < least:
            break
        taken[word] = logs[word]
        for i in has.pop(word):
            weight[i] *= share
    return taken


def signature(words: list[str]) -> int:
    """The least hash of a text's five-word shingles, which near copies mostly share."""
    h = np.fromiter(map(zlib.crc32, (w.encode("utf-8", "replace") for w in words)), np.uint64, len(words))
    n = max(1, len(h) - 4)
    mixed = np.zeros(n, np.uint64)
    for k in range(min(5, len(h))):
        mixed = (mixed ^ h[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return int(mixed.min())


def gradient(model: ToxicModel, tokens: np.ndarray, lengths: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the negative log-likelihood of the labels ``y``, by own, left, right and transitions: expected
    less observed counts, the expectations by forward-backward."""
    p, expected = expectations(model.scores(tokens, lengths), lengths, model.transitions)
    off, size, inner = p - y, len(model.own), inner_places(lengths)
    observed = np.bincount((2 * y[:-1] + y[1:])[inner].astype(np.int64), minlength=4).reshape(2, 2)
    return [
        np.bincount(tokens, off, size),
        np.bincount(tokens[:-1], np.where(inner, off[1:], 0), size),
        np.bincount(tokens[1:], np.where(inner, off[:-1], 0), size),
        expected - observed,
    ]


def fit(model: ToxicModel, tokens: np.ndarray, lengths: np.ndarray, y: np.ndarray, rounds: int, l2: float) -> None:
    """Maximum likelihood with a little regularisation, by gradient steps with momentum (Adam)."""
    params = [model.own, model.left, model.right, model.transitions]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for it in range(1, rounds + 1):
        for j, g in enumerate(gradient(model, tokens, lengths, y)):
            g = g / max(1, int(y.sum())) + l2 * (params[j] if j else params[j] - START)
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.99 * second[j] + 0.01 * g * g
            change = 0.3 * (first[j] / (1 - 0.9**it)) / (np.sqrt(second[j] / (1 - 0.99**it)) + 1e-8)
            params[j] -= change * (0.2 if j == 3 else 1.0)


def train(texts: list[str], toxic: list[int], vocabulary: int = 30_000, rounds: int = 30, l2: float = 1e-3) -> ToxicModel:
    """A CRF from whole labelled texts; without both labels it knows no words and scores all low.

    The score's calibration is fitted on a quarter of the texts that the CRF it is fitted for hasn't
    seen; that CRF learns from the others alone, the one that is returned from all.
    """
    order = sorted(range(len(texts)), key=lambda i: (texts[i], toxic[i]))
    texts, y_doc = [texts[i] for i in order], np.array([bool(toxic[i]) for i in order], bool)
    words = [words_of(t) for t in texts]
    held = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 4 == 0 for t in texts], bool)
    model = _tagger(words, y_doc, vocabulary, rounds, l2)
    parts = [y_doc[held], y_doc[~held]]
    if not model.telling or not all(part.any() and not part.all() for part in parts):
        return model
    other = _tagger([w for w, h in zip(words, held, strict=True) if not h], parts[1], vocabulary, rounds, l2)
    unseen = [t for t, h in zip(texts, held, strict=True) if h]
    model.weights = _logistic(np.concatenate([other.features(*other.greatest(b)) for _, b in TextBlocks()(unseen)]), parts[0].astype(float))
    return model


def _tagger(words: list[list[str]], y_doc: np.ndarray, vocabulary: int, rounds: int, l2: float) -> ToxicModel:
    """A CRF from the words of texts and their labels, uncalibrated."""
    sets = [set(w) for w in words]
    single = list({signature(w): i for i, w in enumerate(words)}.values())
    telling = telling_words([sets[i] for i in single], y_doc[single]) if y_doc.any() and not y_doc.all() else {}
    df = Counter(w for s in sets for w in s)
    known = sorted(telling) + [w for w, n in sorted(df.items(), key=lambda x: (-x[1], x[0])) if n >= 3 and w not in telling][: max(0, vocabulary - len(telling))]
    model = ToxicModel(known)
    model.own += START
    model.telling = len(telling)
    if telling:
        tokens, lengths = model.tokens(words)
        owner = np.repeat(np.arange(len(words)), lengths)
        y = (tokens > 0) & (tokens <= len(telling)) & y_doc[owner]  # the telling words come first
        fit(model, tokens, lengths, y, rounds, l2)
    return model


def _logistic(z: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a logistic regression with a little regularisation, by Newton steps."""
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + 1e-2 * w
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        w = w - np.clip(np.linalg.solve(h, g), -1, 1)
    return w


def training_rows(docs: DataFrame, labels: DataFrame, per_class: int = 1500, longest: int = 65_536) -> list:
    """At most ``per_class`` whole texts of each label, none of over ``longest`` bytes: of that many ids, those
    with the least hashes, and of their different documents again. Null labels, ids and texts teach nothing; an id
    labelled more than once counts as toxic if any label says so."""
    own = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = sampled(own.withColumn("class", F.col("toxic") > 0), "class", per_class)
    usable = docs.select("doc_id", "text").filter(F.octet_length("text") <= longest)
    # chosen has 2 * per_class rows at most, and so has the result, however many documents share an id
    return sampled(usable.join(F.broadcast(chosen), "doc_id"), "class", per_class).select("doc_id", "text", "toxic").collect()


def worker_model(key: str, shared) -> ToxicModel:
    return resident(key, lambda: pickle.loads(shared.value))


def _results(model: ToxicModel, texts: list[str | None], spans: bool) -> tuple[np.ndarray, list]:
    score, found = np.zeros(len(texts)), []
    with no_cycle_collection():
        for first, block in TextBlocks(1 << 20)(texts):
            top, p, lengths = model.greatest(block)
            score[first : first + len(block)] = model.calibrated(top, p, lengths)
            if not spans:
                continue
            ends = np.cumsum(lengths)
            for i, text in enumerate(block):
                own = np.flatnonzero(p[ends[i] - lengths[i] : ends[i]] >= 0.5)
                places = [m.span() for m in WORD.finditer(spoken(text))] if len(own) else []
                found.append([{"start": places[k][0], "end": places[k][1]} for k in own.tolist()])
    return score, found


def score_toxicity(docs: DataFrame, model: ToxicModel, threshold: float = 0.7, text: str = "text", spans: bool = True) -> DataFrame:
    """``docs`` with score (0 to 1), predicted (1 if score >= threshold) and, if asked for,
    toxic_spans: code point offsets of the tokens whose marginal is 0.5 or more.

    Null and empty texts get the score of a text whose tokens are all surely clean. Repeated rows
    stay; an empty table gives an empty result; columns of those names are replaced. The model is
    bounded by its vocabulary.
    """
    shared, key = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model)), uuid.uuid4().hex
    kind = "struct<score:double,toxic_spans:array<struct<start:int,end:int>>>" if spans else "struct<score:double>"

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        score, found = _results(worker_model(key, shared), texts.tolist(), spans)
        return pd.DataFrame({"score": score, "toxic_spans": found} if spans else {"score": score})

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted", "toxic_spans")]
    (found,) = fresh_names(docs.columns, 1)
    made = docs.select(*kept, run(F.col(text)).alias(found)).select(*kept, f"{found}.*")
    return made.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels")
    rows = training_rows(docs, labels.filter(split_of(F.col("doc_id")) != 1))
    model = train([r["text"] for r in rows], [r["toxic"] for r in rows])
    held = F.coalesce(split_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out")
    return score_toxicity(docs.select("doc_id", held, "text"), model).drop("text")
