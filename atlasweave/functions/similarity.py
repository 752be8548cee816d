"""String similarity: native Levenshtein, other measures from their definitions, match cascades.

Two empty strings are identical (100), an empty and a full one share nothing (0). Scores are 0 to
100 unless a function says otherwise.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def processed(text: str | None) -> str:
    """Lower case, everything but letters and digits as spaces, stripped."""
    return "".join(c if c.isalnum() else " " for c in (text or "").lower()).strip()


def processed_column(c: Column) -> Column:
    """:func:`processed` of ASCII text as a native expression."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]", " "))


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 less the edits a character of the longer string, 0 to 1, native."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


@lru_cache(maxsize=65_536)
def _masks(text: str) -> dict[str, int]:
    """Where each character stands, a bit a place; not to be changed."""
    out: dict[str, int] = {}
    for i, c in enumerate(text):
        out[c] = out.get(c, 0) | 1 << i
    return out


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, a bit a character of ``a``."""
    if not a or not b:
        return 0
    full, masks = (1 << len(a)) - 1, _masks(a)
    rest = full
    for c in b:
        hit = rest & masks.get(c, 0)
        rest = ((rest + hit) | (rest - hit)) & full
    return len(a) - rest.bit_count()


def levenshtein_distance(a: str, b: str) -> int:
    """Edits between two strings by bit vectors of vertical differences."""
    if not a or not b:
        return len(a) + len(b)
    full, masks, top = (1 << len(a)) - 1, _masks(a), 1 << (len(a) - 1)
    plus, minus, cost = full, 0, len(a)
    for c in b:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        h_plus, h_minus = minus | ~(diagonal | plus) & full, plus & diagonal
        cost += bool(h_plus & top) - bool(h_minus & top)
        h_plus = (h_plus << 1 | 1) & full
        h_minus = h_minus << 1 & full
        plus = (h_minus | ~(diagonal | h_plus)) & full
        minus = h_plus & diagonal
    return cost


def lev_sim(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return 100.0 * (1 - levenshtein_distance(a, b) / longest) if longest else 100.0


def _jaro_share(a: str, b: str) -> float:
    if not a and not b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    used, first = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                first.append(c)
                break
    m = len(first)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(first, (c for c, u in zip(b, used, strict=True) if u), strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro(a: str, b: str) -> float:
    return 100.0 * _jaro_share(a, b)


def jaro_winkler(a: str, b: str) -> float:
    """Jaro with up to 4 characters of common beginning at weight 0.1, above 70 only."""
    share = _jaro_share(a, b)
    if share <= 0.7:
        return 100.0 * share
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return 100.0 * (share + prefix * 0.1 * (1 - share))


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best :func:`ratio` of the shorter string with a window of its length in the longer one;
    windows may hang over either end."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    if a in b:
        return 100.0
    best = 0.0
    for at in range(1 - len(a), len(b)):
        window = b[max(0, at) : at + len(a)]
        # no window can beat the share of the characters it has
        if 200.0 * min(len(a), len(window)) / (len(a) + len(window)) > best:
            best = max(best, ratio(a, window))
    if len(a) == len(b):
        for at in range(1 - len(b), len(a)):
            best = max(best, ratio(a[max(0, at) : at + len(b)], b))
    return best


@lru_cache(maxsize=65_536)
def _sorted_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


@lru_cache(maxsize=65_536)
def _token_set(text: str) -> frozenset[str]:
    return frozenset(text.split())


def _token_sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = _token_set(a), _token_set(b)
    return " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_sorted_tokens(a), _sorted_tokens(b))


def token_set_ratio(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    both, only_a, only_b = _token_sets(a, b)
    if both and (not only_a or not only_b):
        return 100.0
    with_a, with_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    score = ratio(with_a, with_b)
    return max(score, ratio(both, with_a), ratio(both, with_b)) if both else score


def token_ratio(a: str, b: str) -> float:
    return max(token_sort_ratio(a, b), token_set_ratio(a, b))


def partial_token_ratio(a: str, b: str) -> float:
    if not a.split() or not b.split():
        return 0.0
    both, only_a, only_b = _token_sets(a, b)
    if both:
        return 100.0
    return max(partial_ratio(_sorted_tokens(a), _sorted_tokens(b)), partial_ratio(only_a, only_b))


def seq_ratio(a: str, b: str) -> int:
    """Share of matching blocks, a whole number."""
    return round(100 * SequenceMatcher(None, a, b).ratio()) if a or b else 100


def seq_token_sort_ratio(a: str, b: str) -> int:
    return seq_ratio(_sorted_tokens(processed(a)), _sorted_tokens(processed(b)))


def seq_partial_ratio(a: str, b: str) -> int:
    """The best :func:`seq_ratio` of the shorter string with the windows that matching blocks point to."""
    if a == b:
        return 100
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0
    best = 0.0
    for block in SequenceMatcher(None, a, b).get_matching_blocks():
        at = max(0, block[1] - block[0])
        share = SequenceMatcher(None, a, b[at : at + len(a)]).ratio()
        if share > 0.995:
            return 100
        best = max(best, share)
    return round(100 * best)


def _seq_token_set(a: str, b: str, score: Callable[[str, str], int]) -> int:
    a, b = processed(a), processed(b)
    if not a or not b:
        return 0
    both, only_a, only_b = _token_sets(a, b)
    with_a, with_b = f"{both} {only_a}".strip(), f"{both} {only_b}".strip()
    return max(score(both, with_a), score(both, with_b), score(with_a, with_b))


def seq_token_set_ratio(a: str, b: str) -> int:
    return _seq_token_set(a, b, seq_ratio)


def seq_partial_token_set_ratio(a: str, b: str) -> int:
    return _seq_token_set(a, b, seq_partial_ratio)


@lru_cache(maxsize=65_536)
def _counts(text: str) -> Counter[str]:
    return Counter(text)


def shared(a: str, b: str) -> int:
    """How many characters two strings share, wherever they stand: no common subsequence is longer."""
    x, y = _counts(a), _counts(b)
    if len(x) > len(y):
        x, y = y, x
    return sum(min(n, y[c]) for c, n in x.items() if c in y)


def _whole_bound(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * shared(a, b) / total if total else 100.0


def _edit_bound(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return 100.0 * shared(a, b) / longest + 1e-9 if longest else 100.0


def _winkler_bound(a: str, b: str) -> float:
    m = shared(a, b)
    share = (m / len(a) + m / len(b) + 1) / 3 if m else float(not a and not b)
    return 100.0 * (share + 0.4 * (1 - share)) + 1e-9


def _partial_bound(a: str, b: str) -> float:
    least, m = min(len(a), len(b)), shared(a, b)
    return 200.0 * m / (least + m) if m else 100.0 * (not least)


def _token_bound(a: str, b: str, bound: Callable[[str, str], float]) -> float:
    """Of measures of sorted tokens and of what either string has alone: if they share no token and
    repeat none, these are the same."""
    x, y = _token_set(a), _token_set(b)
    if not x.isdisjoint(y) or len(x) < len(a.split()) or len(y) < len(b.split()):
        return 100.0
    return bound(_sorted_tokens(a), _sorted_tokens(b))


def _seq_token_bound(a: str, b: str) -> float:
    a, b = processed(a), processed(b)
    return _seq_bound(_sorted_tokens(a), _sorted_tokens(b))


def _seq_bound(a: str, b: str) -> float:
    return round(_whole_bound(a, b)) if a or b else 100.0


#: A number that no score exceeds, quickly found.
BOUNDS: dict[Callable[[str, str], float], Callable[[str, str], float]] = {
    lev_sim: _edit_bound, jaro_winkler: _winkler_bound, ratio: _whole_bound, partial_ratio: _partial_bound, seq_ratio: _seq_bound,
    token_ratio: lambda a, b: _token_bound(a, b, _whole_bound), partial_token_ratio: lambda a, b: _token_bound(a, b, _partial_bound),
    seq_token_sort_ratio: _seq_token_bound,
}

Scored = tuple[str | None, float, str, str]


def best_of(name: str, candidates: Sequence[str], score: Callable[[str, str], float], least: float = 0.0) -> tuple[str | None, float]:
    """The candidate with the greatest score, the first of equals. Candidates that can't exceed the
    best so far, or can't reach ``least``, aren't scored: below that any result will do."""
    best, value, bound = None, -1.0, BOUNDS.get(score)
    for c in candidates:
        if best is not None and bound is not None:
            most = bound(name, c)
            if most <= value or most < least:
                continue
        s = score(name, c)
        if s > value:
            best, value = c, s
            if s >= 100:
                break
    return best, value


def top_of(name: str, candidates: Sequence[str], score: Callable[[str, str], float], least: float, k: int) -> list[tuple[float, str]]:
    """The k best that reach ``least``, the first of equals first; others aren't scored where a bound says so."""
    bound = BOUNDS.get(score)
    able = ((i, c) for i, c in enumerate(candidates) if bound is None or bound(name, c) >= least)
    scored = sorted(((score(name, c), -i, c) for i, c in able), reverse=True)[:k]
    return [(s, c) for s, _, c in scored if s >= least]


def top_then_ratio(name: str, candidates: Sequence[str], score, second, least: float = 85, k: int = 5) -> tuple[str | None, float]:
    """Of the k best by ``score`` that reach ``least``, the best by ``second``."""
    kept = [c for _, c in top_of(name, candidates, score, least, k)]
    return best_of(name, kept, second) if kept else (None, -1.0)


def edit_accepts(length: int, score: float, general: float) -> bool:
    """Short names may differ more."""
    return (length <= 4 and score >= 70) or (length == 5 and score >= 75) or score >= general


def _prepared(name: str, candidates: Sequence[str]) -> tuple[str, list[str], dict[str, str]]:
    """Processed name and candidates, and the first original of each processed form."""
    back: dict[str, str] = {}
    for c in candidates:
        back.setdefault(processed(c), c)
    return processed(name), list(back), back


def _early_rapid(name: str, own: str, forms: list[str], back: dict[str, str]) -> Scored:
    best, edit = best_of(own, forms, lev_sim)
    if edit == 100:
        return back[best], 100.0, "identical", "YES"
    if edit_accepts(len(name), edit, 82):
        return back[best], edit, "levenshtein", "YES"
    for score, least, method in ((jaro_winkler, 87, "jaro_winkler_similarity"), (ratio, 85, "fuzz_ratio"), (token_ratio, 87, "token_ratio")):
        found, value = best_of(own, forms, score, least)
        if value >= least:
            return back[found], value, method, "YES"
    return back[best], edit, "levenshtein", "NO"


def _early_sequence(name: str, own: str, forms: list[str], back: dict[str, str]) -> Scored:
    best, value = best_of(own, forms, seq_ratio)
    if value == 100:
        return back[best], 100.0, "identical", "YES"
    if edit_accepts(len(name), value, 78):
        return back[best], float(value), "fuzz_ratio", "YES"
    found, score = best_of(own, forms, seq_token_sort_ratio, 78)
    if score >= 78:
        return back[found], float(score), "fuzz_token_ratio", "YES"
    return back[best], float(value), "fuzz_ratio", "NO"


#: Measures of each cascade that one best candidate decides, and the partial stages after them:
#: (method, score, second score).
EARLY = {"rapid": _early_rapid, "sequence": _early_sequence}
PARTIAL = {
    "rapid": [("partial_ratio", partial_ratio, ratio), ("partial_token_ratio", partial_token_ratio, ratio)],
    "sequence": [("partial_ratio", seq_partial_token_set_ratio, seq_ratio)],
}


def match_rapid(name: str, candidates: Sequence[str], kind: str = "rapid") -> Scored:
    """(match, score, method, YES or NO) of the first measure whose best candidate is good enough."""
    if not candidates:
        return None, 0.0, "levenshtein" if kind == "rapid" else "fuzz_ratio", "NO"
    own, forms, back = _prepared(name, candidates)
    early = EARLY[kind](name, own, forms, back)
    if early[3] == "YES":
        return early
    for method, score, second in PARTIAL[kind]:
        found, value = top_then_ratio(own, forms, score, second)
        if value >= 50:
            return back[found], float(value), method, "YES"
    return early


def match_sequence(name: str, candidates: Sequence[str]) -> Scored:
    """The same with measures over matching blocks."""
    return match_rapid(name, candidates, "sequence")


def match_part(name: str, candidates: Sequence[str], kind: str, least: float = 85, k: int = 5) -> tuple[Scored, list[tuple[int, float, str]]]:
    """What some of the candidates give: the result before the partial stages and, if that is NO, the
    (partial stage, score, candidate) of the k best of each that reach ``least``."""
    own, forms, back = _prepared(name, candidates)
    early, top = EARLY[kind](name, own, forms, back), []
    for stage, (_, score, _) in enumerate(PARTIAL[kind]) if early[3] == "NO" else ():
        top += [(stage, float(s), back[c]) for s, c in top_of(own, forms, score, least, k)]
    return early, top


def match_merged(name: str, top: Sequence[tuple[int, float, int, str]], kind: str, k: int = 5) -> Scored | None:
    """The result of the partial stages over all candidates, from the (stage, score, position, candidate)
    of :func:`match_part` of all parts; None if no stage finds any."""
    for stage, (method, _, second) in enumerate(PARTIAL[kind]):
        _, forms, back = _prepared(name, [c for _, _, _, c in sorted((x for x in top if x[0] == stage), key=lambda x: (-x[1], x[2], x[3]))])
        found, value = best_of(processed(name), forms[:k], second)
        if value >= 50:
            return back[found], float(value), method, "YES"
    return None


CASCADES = {"rapid": match_rapid, "sequence": match_sequence}
PAIR_MEASURES: dict[str, Callable[[str, str], float]] = {
    "lev_sim": lev_sim, "jaro": jaro, "jaro_winkler": jaro_winkler, "indel_ratio": ratio, "partial_ratio": partial_ratio,
    "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio, "token_ratio": token_ratio,
    "partial_token_ratio": partial_token_ratio, "seq_ratio": seq_ratio, "seq_token_sort_ratio": seq_token_sort_ratio,
    "seq_token_set_ratio": seq_token_set_ratio, "seq_partial_token_set_ratio": seq_partial_token_set_ratio,
}


def pair_measure(name: str):
    """A measure of two string columns as an Arrow UDF; null if either is null."""
    score = PAIR_MEASURES[name]

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        once = lru_cache(maxsize=100_000)(score)
        return pd.Series([None if x is None or y is None else float(once(x, y)) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


def cascade(kind: str = "rapid"):
    """A cascade of (name, array of candidates) as an Arrow UDF."""
    match = CASCADES[kind]

    @F.pandas_udf("struct<name:string,score:double,method:string,result:string>")
    def run(names: pd.Series, candidates: pd.Series) -> pd.DataFrame:
        rows = [match(n or "", [c for c in cs if c is not None] if cs is not None else []) for n, cs in zip(names, candidates, strict=True)]
        return pd.DataFrame(rows, columns=["name", "score", "method", "result"])

    return run


def register(spark: SparkSession) -> list[str]:
    """Makes every measure and both cascades callable from SQL; returns their names."""
    from atlasweave.functions import phonetic

    made = {n: pair_measure(n) for n in PAIR_MEASURES} | {f"match_{k}": cascade(k) for k in CASCADES} | {n: phonetic.word_code(n) for n in phonetic.CODES}
    for name, udf in made.items():
        spark.udf.register(name, udf)
    return sorted(made)
