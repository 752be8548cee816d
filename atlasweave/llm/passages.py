"""Finding stored passages inside whole texts: character q-grams, diagonals, banded alignment.

Shared by benchmark decontamination and license scans. Texts are compared in a normal form: lower
case, and every run of characters that are neither letters nor digits as one space.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

_ASTRAL = re.compile("[\U00010000-\U0010ffff]")
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)
_BITS = 22
BREAK = 1  # between texts; in no pattern


def _normal_table() -> np.ndarray:
    table = np.full(1 << 16, 32, np.uint16)
    for i in range(1 << 16):
        c = chr(i)
        if c.isalnum():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else i
    table[BREAK] = BREAK
    return table


_table: list[np.ndarray] = []


def normal_table() -> np.ndarray:
    if not _table:
        _table.append(_normal_table())
    return _table[0]


@dataclass
class Block:
    """Texts in normal form, one after another: codes, where each code stood in its text, and where
    each text begins among the codes."""

    codes: np.ndarray
    places: np.ndarray
    starts: np.ndarray


def normal_block(texts: list[str | None]) -> Block:
    """Characters beyond the basic plane become one replacement character each, so places are code points."""
    parts, lengths = [], []
    for text in texts:
        raw = (text or "").encode("utf-16-le", "surrogatepass")
        if len(raw) != 2 * len(text or ""):
            raw = _ASTRAL.sub("\ufffd", text).encode("utf-16-le", "surrogatepass")
        parts.append(b"\x01\x00" + raw)
        lengths.append(len(raw) // 2 + 1)
    begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    codes = normal_table()[np.frombuffer(b"".join(parts), "<u2")] if parts else np.zeros(0, np.uint16)
    space = codes == 32
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(space[1:] & (space[:-1] | (codes[:-1] == BREAK)))
    kept = np.flatnonzero(keep)
    starts = np.searchsorted(kept, begins)
    owner_begin = np.repeat(begins[:-1], np.diff(starts))
    return Block(codes[kept], kept - owner_begin - 1, starts)


def normal(text: str) -> np.ndarray:
    """One text's codes, without spaces at the ends."""
    codes = normal_block([text]).codes[1:]
    while len(codes) and codes[-1] == 32:
        codes = codes[:-1]
    return codes


def gram_keys(codes: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit key of the q characters from each position on; q is 4, 8, 12 or 16."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    raw = np.ascontiguousarray(codes, "<u2").tobytes()
    four = np.ndarray((len(codes) - 3,), "<u8", raw, strides=(2,)).copy()
    out = four[:n] * _MULTIPLIERS[0]
    for k in range(1, q // 4):
        out ^= four[4 * k : 4 * k + n] * _MULTIPLIERS[k]
        out *= np.uint64(0xD6E8FEB86659FD93)
    return out


class GramIndex:
    """Where each q-gram stands in the patterns: an inverted index with a bitmap in front."""

    def __init__(self, patterns: list[np.ndarray], q: int, chosen: list[np.ndarray] | None = None):
        """``chosen``: the positions indexed of each pattern, all by default."""
        self.q, self.patterns = q, patterns
        keys, owners, positions = [], [], []
        for i, p in enumerate(patterns):
            own = gram_keys(p, q)
            at = np.arange(len(own)) if chosen is None else chosen[i]
            keys.append(own[at])
            owners.append(np.full(len(at), i))
            positions.append(at)
        every = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.keys = every[order]
        self.owner = (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]
        self.position = (np.concatenate(positions) if positions else np.zeros(0, np.int64))[order]
        self.bitmap = np.zeros(1 << _BITS, bool)
        self.bitmap[self._slot(self.keys)] = True
        self.sizes = np.array([len(p) for p in patterns], np.int64)

    def longest_of(self, pattern: np.ndarray) -> np.ndarray:
        """How far into each pattern a q-gram may stand at most."""
        return self.sizes[pattern]

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - _BITS)).astype(np.int64)

    def lookups(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions in codes whose q-gram is stored, its first entry, how many it has)."""
        keys = gram_keys(codes, self.q)
        at = np.flatnonzero(self.bitmap[self._slot(keys)])
        own = keys[at]
        lo, hi = np.searchsorted(self.keys, own), np.searchsorted(self.keys, own, side="right")
        some = hi > lo
        return at[some], lo[some], (hi - lo)[some]

    def expanded(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position in codes, pattern, position in the pattern) of every shared q-gram of some lookups."""
        which = np.repeat(lo, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.owner[which], self.position[which]

    def hits(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of all."""
        return self.expanded(*self.lookups(codes))


def unedited(pattern: np.ndarray, text: np.ndarray, shift: int, slack: int) -> int | None:
    """Where the pattern first stands as it is in ``text``, within ``slack`` of ``shift``; None if it doesn't."""
    lo, hi = max(0, shift - slack), min(shift + slack, len(text) - len(pattern))
    if len(pattern) and lo <= hi:
        equal = (np.lib.stride_tricks.sliding_window_view(text[lo : hi + len(pattern)], len(pattern)) == pattern).all(axis=1)
        if equal.any():
            return lo + int(equal.argmax())
    return None


def banded(pattern: np.ndarray, text: np.ndarray, shift: int, slack: int, budget: int) -> tuple[int, int, int] | None:
    """The cheapest alignment of the whole pattern with a stretch of ``text`` whose diagonal (text
    position less pattern position) is within ``slack`` of ``shift``: (edits, start, end), or None
    beyond ``budget`` edits. Of equal ones the first that ends is taken."""
    if budget >= 0 and (at := unedited(pattern, text, shift, slack)) is not None:  # nothing is cheaper
        return 0, at, at + len(pattern)
    width = 2 * slack + 1
    big = 1 << 20
    diagonals = shift - slack + np.arange(width)
    inside = (diagonals >= 0) & (diagonals <= len(text))
    cost = np.where(inside, 0, big)
    start = diagonals.copy()
    steps = np.arange(width)
    for i, c in enumerate(pattern):
        at = diagonals + i
        there = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[there] = text[at[there]] == c
        through = cost + ~same
        through[~there] = big
        down = np.append(cost[1:], big) + 1  # the pattern's character has no partner
        best = np.minimum(through, down)
        origin = np.where(through <= down, start, np.append(start[1:], 0))
        # characters of the text without partner: a running minimum along the band
        lowest = np.minimum.accumulate(best - steps)
        run = lowest + steps
        source = np.maximum.accumulate(np.where(best - steps == lowest, steps, -1))
        origin = np.where(run < best, origin[source], origin)
        cost, start = np.minimum(best, run), origin
        if cost.min() > budget:
            return None
    ends = diagonals + len(pattern)
    cost = np.where((ends >= 0) & (ends <= len(text)), cost, big)
    k = int(cost.argmin())
    return (int(cost[k]), int(start[k]), int(ends[k])) if cost[k] <= budget else None


def local(pattern: np.ndarray, text: np.ndarray, lo: int, hi: int) -> tuple[int, int, int, int, int, int] | None:
    """The best alignment of some stretch of the pattern with some stretch of ``text`` on the diagonals
    from ``lo`` to ``hi``: (matched characters, edits, start and end in the pattern, start and end in
    the text), None if nothing matches. An edit costs one and a half matches."""
    diagonals = lo + np.arange(hi - lo + 1)
    steps, far = np.arange(len(diagonals)), -(1 << 30)
    score, matched, edits = (np.zeros(len(diagonals), np.int64) for _ in range(3))
    p0, t0 = np.zeros(len(diagonals), np.int64), diagonals.copy()
    best = (0, None)
    for i, c in enumerate(pattern):
        at = diagonals + i
        there = (at >= 0) & (at < len(text))
        same = np.zeros(len(diagonals), bool)
        same[there] = text[at[there]] == c
        through = np.where(there, score + np.where(same, 2, -3), far)
        down = np.append(score[1:], far) - 3  # the pattern's character has no partner
        skip = down > through
        source = np.where(skip, np.minimum(steps + 1, len(steps) - 1), steps)
        now = np.where(skip, down, through)
        matched, edits, p0, t0 = matched[source] + (same & ~skip), edits[source] + (skip | ~same), p0[source], t0[source]
        # characters of the text without partner: a running maximum along the band
        greatest = np.maximum.accumulate(now + 3 * steps)
        source = np.maximum.accumulate(np.where(now + 3 * steps == greatest, steps, 0))
        edits, matched, p0, t0 = edits[source] + steps - source, matched[source], p0[source], t0[source]
        score = greatest - 3 * steps
        none = score <= 0
        score[none], matched[none], edits[none], p0[none] = 0, 0, 0, i + 1
        t0 = np.where(none, diagonals + i + 1, t0)
        k = int(score.argmax())
        if score[k] > best[0]:
            best = (int(score[k]), (int(matched[k]), int(edits[k]), int(p0[k]), i + 1, int(t0[k]), int(diagonals[k]) + i + 1))
    return best[1]


def regions(index: GramIndex, block: Block, band: np.ndarray, least: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int, int, int]]:
    """(text, pattern, least diagonal, shared q-grams) of the diagonal bands with ``least`` or more.

    Bands of pattern p are 2 * band[p] diagonals wide and overlap by half, so that any alignment
    whose diagonals differ by at most band[p] lies whole in one. Diagonals are within the text.

    Shared q-grams are looked at ``most`` at a time, in the order of the texts, and of what was counted
    only bands that later ones may still add to are kept: a q-gram that every pattern has, in a text
    of any length, takes memory by the number of patterns alone.
    """
    at, lo, n = index.lookups(block.codes)
    n_patterns, offset = len(band), int(band.max(initial=0)) + 1
    span = len(block.codes) + 2 * max((len(p) for p in index.patterns), default=0) + 4 * offset
    # one number a band: text, pattern and column (never below -offset - the longest pattern)
    shift = span // 2
    held, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    done = 0
    while done < len(at):
        upto = max(done + 1, int(np.searchsorted(np.cumsum(n[done:]), most, side="right")) + done)
        where, pattern, position = index.expanded(at[done:upto], lo[done:upto], n[done:upto])
        done = upto
        text = np.searchsorted(block.starts, where, side="right") - 1
        column = np.floor_divide(where - block.starts[text] - position, band[pattern])
        both = np.concatenate([column, column - 1]) + shift
        key = (np.concatenate([text, text]) * n_patterns + np.concatenate([pattern, pattern])) * span + both
        own, times = np.unique(key, return_counts=True)
        if len(held):
            merged, inverse = np.unique(np.concatenate([held, own]), return_inverse=True)
            own, times = merged, np.bincount(inverse, weights=np.concatenate([counts, times])).astype(np.int64)
        over = np.ones(len(own), bool)
        if done < len(at):  # what q-grams from here on may still add to
            next_text = int(np.searchsorted(block.starts, at[done], side="right")) - 1
            p, low = own // span % n_patterns, own % span - shift
            reach = int(at[done] - block.starts[next_text]) - index.longest_of(p)
            over = (own // span // n_patterns < next_text) | ((low + 2) * band[p] <= reach)
        held, counts = own[~over], times[~over]
        own, times = own[over], times[over]
        for k in np.flatnonzero(times >= least[own // span % n_patterns]):
            p = int(own[k] // span % n_patterns)
            yield int(own[k] // span // n_patterns), p, (int(own[k] % span) - shift) * int(band[p]), int(times[k])


def best_spans(found: Iterable[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of overlapping (edits, start, end) the one with the fewest edits, the first of equals."""
    out: list[tuple[int, int, int]] = []
    for x in sorted(set(found)):
        if all(x[2] <= y[1] or y[2] <= x[1] for y in out):
            out.append(x)
    return sorted(out, key=lambda x: x[1:])
