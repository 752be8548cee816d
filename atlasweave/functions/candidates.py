"""A list of candidates prepared for many names: bounds of a measure for all of them at once.

Every measure of the cascades is bounded by how many characters two strings share, and those over tokens by
how many characters of whole tokens. Both are counted for all candidates by a few vector operations, from
a table of character counts and an inverted index of tokens. Candidates are then scored in the order of
falling bounds until no bound is above what has been found, so a name is compared with few of them.
Results are those of :mod:`similarity`, which compares with all.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np

from atlasweave.functions import similarity as sim

Score = Callable[[str, str], float]


class Letters:
    """How often each character stands in each of some strings."""

    def __init__(self, texts: Sequence[str]):
        self.row = {c: i for i, c in enumerate(sorted(set().union(*texts)))} if texts else {}
        most = max((max(Counter(t).values(), default=0) for t in texts), default=0)
        self.counts = np.zeros((len(self.row), len(texts)), np.min_scalar_type(most))
        for i, t in enumerate(texts):
            for c, n in Counter(t).items():
                self.counts[self.row[c], i] = n
        self.lengths = np.array([len(t) for t in texts], np.int64)
        #: rows of the characters, place by place; a row that no character has behind the end
        self.places = np.full((int(self.lengths.max(initial=0)), len(texts)), len(self.row), np.int32)
        for i, t in enumerate(texts):
            self.places[: len(t), i] = [self.row[c] for c in t]

    def shared(self, text: str) -> np.ndarray:
        """How many characters each string shares with ``text``, wherever they stand."""
        out = np.zeros(len(self.lengths), np.int32)
        for c, n in Counter(text).items():
            if c in self.row:
                own = self.counts[self.row[c]]
                out += np.minimum(own, n) if n < np.iinfo(own.dtype).max else own
        return out


    def edits(self, text: str, own: np.ndarray) -> np.ndarray:
        """Levenshtein distances of ``text``, of 1 to 64 characters, and the strings at ``own``: bit vectors of vertical
        differences, as in :func:`similarity.levenshtein_distance`, for all strings at a time."""
        masks = np.zeros(len(self.row) + 1, np.uint64)
        for i, c in enumerate(text):
            if c in self.row:
                masks[self.row[c]] |= np.uint64(1 << i)
        sizes, one, top = self.lengths[own], np.uint64(1), np.uint64(len(text) - 1)
        plus, minus = np.full(len(own), (1 << len(text)) - 1, np.uint64), np.zeros(len(own), np.uint64)
        cost = np.full(len(own), len(text), np.int64)
        for j in range(int(sizes.max(initial=0))):
            eq = masks[self.places[j, own]]
            diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
            h_plus, h_minus = minus | ~(diagonal | plus), plus & diagonal
            step = ((h_plus >> top) & one).astype(np.int64) - ((h_minus >> top) & one).astype(np.int64)
            cost += np.where(sizes > j, step, 0)
            h_plus = (h_plus << one) | one
            plus, minus = (h_minus << one) | ~(diagonal | h_plus), h_plus & diagonal
        return cost


def whole_bound(shared: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    total = size + sizes
    return np.where(total > 0, 200.0 * shared / np.maximum(total, 1), 100.0)


def partial_bound(shared: np.ndarray, size: int, sizes: np.ndarray) -> np.ndarray:
    least = np.minimum(size, sizes)
    return np.where(shared > 0, 200.0 * shared / np.maximum(least + shared, 1), np.where(least == 0, 100.0, 0.0))


class Candidates:
    """Candidates in the order that decides between equals."""

    def __init__(self, names: Sequence[str]):
        self.back: dict[str, str] = {}
        for c in names:
            self.back.setdefault(sim.processed(c), c)
        self.forms = list(self.back)
        self.letters = Letters(self.forms)
        self.sorted = Letters([sim._sorted_tokens(f) for f in self.forms])
        self.sets = Letters([" ".join(sorted(sim._token_set(f))) for f in self.forms])
        holders: dict[str, list[int]] = {}
        for i, f in enumerate(self.forms):
            for t in sim._token_set(f):
                holders.setdefault(t, []).append(i)
        self.holders = {t: np.array(x) for t, x in holders.items()}
        self.tokens = np.array([len(sim._token_set(f)) for f in self.forms], np.int64)
        self.starts = np.array([[ord(c) for c in f[:4].ljust(4, "\0")] for f in self.forms], np.int64).reshape(len(self.forms), 4)
        #: pairs scored, and pairs there were
        self.scored = self.met = 0

    def __len__(self) -> int:
        return len(self.forms)

    def bounds(self, name: str) -> "Bounds":
        self.met += len(self.forms)
        return Bounds(self, name)

    def best(self, name: str, bound: np.ndarray, score: Score, least: float = 0.0) -> tuple[str | None, float]:
        """As :func:`similarity.best_of`: the first of the greatest scores; one under ``least`` may be any."""
        best, value = -1, -1.0
        order = np.argsort(-bound, kind="stable")
        for i, most in zip(order.tolist(), bound[order].tolist(), strict=True):
            if best >= 0 and (most < value or most < least):
                break
            if most == value and i > best >= 0:
                continue
            self.scored += 1
            s = score(name, self.forms[i])
            if s > value or (s == value and i < best):
                best, value = i, s
        return (self.forms[best], value) if best >= 0 else (None, -1.0)

    def best_edit(self, name: str, bound: np.ndarray, least: float = 0.0, block: int = 128) -> tuple[str | None, float]:
        """:meth:`best` of :func:`similarity.lev_sim`, many candidates at a time."""
        if not 1 <= len(name) <= 64:
            return self.best(name, bound, sim.lev_sim, least)
        order = np.argsort(-bound, kind="stable")
        best, value = -1, -1.0
        for lo in range(0, len(order), block):
            own = order[lo : lo + block]
            if best >= 0:
                own = own[bound[own] >= max(value, least)]
            if not len(own):
                break
            self.scored += len(own)
            longest = np.maximum(len(name), self.letters.lengths[own])
            scores = 100.0 * (1 - self.letters.edits(name, own) / longest)
            most = scores.max()
            first = int(own[scores == most].min())
            if most > value or (most == value and first < best):
                best, value = first, float(most)
        return (self.forms[best], value) if best >= 0 else (None, -1.0)

    def top(self, name: str, bound: np.ndarray, score: Score, least: float, k: int, closer: Score | None = None) -> list[tuple[float, str]]:
        """As :func:`similarity.top_of`; ``closer`` is a second, closer bound for those that pass the first."""
        able = np.flatnonzero(bound >= least)
        able = able[np.argsort(-bound[able], kind="stable")]
        kept: list[tuple[float, int]] = []  # (score, -place), best first
        for i, most in zip(able.tolist(), bound[able].tolist(), strict=True):
            if len(kept) == k and (most, -i) < kept[-1]:
                if most < kept[-1][0]:
                    break
                continue
            if closer is not None:
                most = closer(name, self.forms[i])
                if most < least or (len(kept) == k and (most, -i) < kept[-1]):
                    continue
            self.scored += 1
            s = score(name, self.forms[i])
            if s >= least:
                kept = sorted([*kept, (s, -i)], reverse=True)[:k]
        return [(s, self.forms[-i]) for s, i in kept]


class Bounds:
    """Numbers that no score of a name with each candidate exceeds."""

    def __init__(self, candidates: Candidates, name: str):
        self.of, self.name, self.size = candidates, name, len(name)
        self.shared = candidates.letters.shared(name)

    def edit(self) -> np.ndarray:
        longest = np.maximum(self.size, self.of.letters.lengths)
        return np.where(longest > 0, 100.0 * self.shared / np.maximum(longest, 1) + 1e-9, 100.0)

    def winkler(self) -> np.ndarray:
        m, sizes = self.shared, self.of.letters.lengths
        share = np.where(m > 0, (m / max(self.size, 1) + m / np.maximum(sizes, 1) + 1) / 3, float(not self.size) * (sizes == 0))
        own = np.array([ord(c) for c in self.name[:4].ljust(4, "\1")])
        prefix = np.cumprod(self.of.starts == own, axis=1).sum(axis=1)
        return 100.0 * (share + 0.1 * prefix * (1 - share)) + 1e-9

    def ratio(self) -> np.ndarray:
        return whole_bound(self.shared, self.size, self.of.letters.lengths)

    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """How many different tokens each candidate has in common with the name, and how long those are, joined."""
        count, length = np.zeros(len(self.of), np.int64), np.zeros(len(self.of), np.int64)
        for t in sim._token_set(self.name):
            if t in self.of.holders:
                own = self.of.holders[t]
                count[own] += 1
                length[own] += len(t)
        return count, length + np.maximum(count - 1, 0)

    def token(self) -> np.ndarray:
        """Of sorted tokens, of different ones, and of the common ones with either string."""
        own, single = sim._sorted_tokens(self.name), " ".join(sorted(sim._token_set(self.name)))
        count, length = self.common()
        out = whole_bound(self.of.sorted.shared(own), len(own), self.of.sorted.lengths)
        out = np.maximum(out, whole_bound(self.of.sets.shared(single), len(single), self.of.sets.lengths))
        for size in (len(single), self.of.sets.lengths):
            out = np.maximum(out, np.where(count > 0, 200.0 * length / np.maximum(length + size, 1), 0.0))
        contained = (count > 0) & ((count == self.of.tokens) | (count == len(sim._token_set(self.name))))
        return np.where(contained, 100.0, out + 1e-9)

    def partial(self) -> np.ndarray:
        return partial_bound(self.shared, self.size, self.of.letters.lengths) + 1e-9

    def partial_token(self) -> np.ndarray:
        """All with a token in common have 100; others are bounded by their different tokens, or all of them."""
        own, single = sim._sorted_tokens(self.name), " ".join(sorted(sim._token_set(self.name)))
        out = partial_bound(self.of.sorted.shared(own), len(own), self.of.sorted.lengths)
        out = np.maximum(out, partial_bound(self.of.sets.shared(single), len(single), self.of.sets.lengths))
        return np.where(self.common()[0] > 0, 100.0, out + 1e-9)

    def sequence(self) -> np.ndarray:
        return np.rint(self.ratio())

    def sequence_tokens(self) -> np.ndarray:
        own = sim._sorted_tokens(self.name)
        return np.rint(whole_bound(self.of.sorted.shared(own), len(own), self.of.sorted.lengths))

    def sequence_partial(self) -> np.ndarray:
        single = " ".join(sorted(sim._token_set(self.name)))
        out = np.ceil(partial_bound(self.of.sets.shared(single), len(single), self.of.sets.lengths))
        return np.where(self.common()[0] > 0, 100.0, out)


def closer_partial(a: str, b: str) -> float:
    """A bound of :func:`similarity.partial_ratio` by the longest common subsequence of the whole strings."""
    least, m = min(len(a), len(b)), sim.lcs_length(a, b)
    return 200.0 * m / (least + m) + 1e-9 if m else 100.0 * (not least)


def closer_partial_token(a: str, b: str) -> float:
    x, y = sim._token_set(a), sim._token_set(b)
    if not x or not y:
        return 0.0
    if not x.isdisjoint(y):
        return 100.0
    bound = closer_partial(sim._sorted_tokens(a), sim._sorted_tokens(b))
    if len(x) < len(a.split()) or len(y) < len(b.split()):
        bound = max(bound, closer_partial(" ".join(sorted(x)), " ".join(sorted(y))))
    return bound


#: Of each partial stage: its bound, and a closer one.
PARTIAL = {
    "rapid": [(Bounds.partial, closer_partial), (Bounds.partial_token, closer_partial_token)],
    "sequence": [(Bounds.sequence_partial, None)],
}


def _early(name: str, own: str, listed: Candidates, kind: str) -> tuple[sim.Scored, Bounds]:
    b = listed.bounds(own)
    if kind == "rapid":
        # below what any name of this length needs, only whether there is more matters so far
        near = b.edit()
        best, edit = listed.best_edit(own, near, 70 if len(name) <= 4 else 75 if len(name) == 5 else 82)
        if edit == 100:
            return (listed.back[best], 100.0, "identical", "YES"), b
        if sim.edit_accepts(len(name), edit, 82):
            return (listed.back[best], edit, "levenshtein", "YES"), b
        for bound, score, least, method in ((b.winkler, sim.jaro_winkler, 87, "jaro_winkler_similarity"), (b.ratio, sim.ratio, 85, "fuzz_ratio"), (b.token, sim.token_ratio, 87, "token_ratio")):
            found, value = listed.best(own, bound(), score, least)
            if value >= least:
                return (listed.back[found], value, method, "YES"), b
        best, edit = listed.best_edit(own, near)
        return (listed.back[best], edit, "levenshtein", "NO"), b
    best, value = listed.best(own, b.sequence(), sim.seq_ratio)
    if value == 100:
        return (listed.back[best], 100.0, "identical", "YES"), b
    if sim.edit_accepts(len(name), value, 78):
        return (listed.back[best], float(value), "fuzz_ratio", "YES"), b
    found, score = listed.best(own, b.sequence_tokens(), sim.seq_token_sort_ratio, 78)
    if score >= 78:
        return (listed.back[found], float(score), "fuzz_token_ratio", "YES"), b
    return (listed.back[best], float(value), "fuzz_ratio", "NO"), b


def match_part(name: str, listed: Candidates, kind: str, least: float = 85, k: int = 5) -> tuple[sim.Scored, list[tuple[int, float, str]]]:
    """As :func:`similarity.match_part`, for a prepared list that isn't empty."""
    own = sim.processed(name)
    early, bounds = _early(name, own, listed, kind)
    top: list[tuple[int, float, str]] = []
    if early[3] == "NO":
        for stage, ((_, score, _), (bound, closer)) in enumerate(zip(sim.PARTIAL[kind], PARTIAL[kind], strict=True)):
            top += [(stage, float(s), listed.back[c]) for s, c in listed.top(own, bound(bounds), score, least, k, closer)]
    return early, top


def match(name: str, listed: Candidates, kind: str) -> sim.Scored:
    """As the cascades of :mod:`similarity`, for a prepared list that isn't empty."""
    own = sim.processed(name)
    early, bounds = _early(name, own, listed, kind)
    if early[3] == "YES":
        return early
    for (method, score, second), (bound, closer) in zip(sim.PARTIAL[kind], PARTIAL[kind], strict=True):
        kept = [c for _, c in listed.top(own, bound(bounds), score, 85, 5, closer)]
        found, value = sim.best_of(own, kept, second) if kept else (None, -1.0)
        if value >= 50:
            return listed.back[found], float(value), method, "YES"
    return early
