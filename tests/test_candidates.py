"""Prepared candidates give what comparing with all gives, and score few."""

import random

import numpy as np
import pytest

from atlasweave.functions import candidates, similarity


def names(r, n, long=False):
    tokens = ["hospital", "clinic", "saint", "marie", "north", "de", "kinshasa", "centre", "sante", "poste", "a", "zz9", "mubende", "gulu"] + ["".join(r.choice("abcdefgi") for _ in range(r.randint(1, 9))) for _ in range(400 if long else 20)]
    out = []
    for _ in range(n):
        own = [r.choice(tokens) for _ in range(r.randint(1, 4))]
        if r.random() < 0.3:
            own.append(r.choice(own))
        t = " ".join(own)
        for _ in range(r.choice((0, 0, 1, 2))):
            at = r.randrange(len(t) + 1)
            t = t[:at] + r.choice("abz -.É") + t[at + r.randrange(2) :]
        out.append(t.title() if r.random() < 0.5 else t)
    return out


@pytest.mark.parametrize("kind", ["rapid", "sequence"])
@pytest.mark.parametrize("seed", range(4))
def test_equal_to_comparing_with_all(kind, seed):
    r = random.Random(seed)
    listed = list(dict.fromkeys([*names(r, 120), "", "--", "aaa", "É"]))
    index = candidates.Candidates(listed)
    for name in [*names(r, 60), "", "...", "a", listed[3]]:
        assert candidates.match(name, index, kind) == similarity.CASCADES[kind](name, listed)
        mine, theirs = candidates.match_part(name, index, kind), similarity.match_part(name, listed, kind)
        assert mine == theirs


def test_bounds_hold():
    r = random.Random(9)
    listed = list(dict.fromkeys(similarity.processed(x) for x in [*names(r, 150), "", "b"]))
    index = candidates.Candidates(listed)
    measures = [("edit", similarity.lev_sim), ("winkler", similarity.jaro_winkler), ("ratio", similarity.ratio), ("token", similarity.token_ratio), ("partial", similarity.partial_ratio), ("partial_token", similarity.partial_token_ratio)]
    measures += [("sequence", similarity.seq_ratio), ("sequence_tokens", similarity.seq_token_sort_ratio), ("sequence_partial", similarity.seq_partial_token_set_ratio)]
    for name in map(similarity.processed, [*names(r, 40), "", "q"]):
        bounds = candidates.Bounds(index, name)
        for bound, score in measures:
            most = getattr(bounds, bound)()
            assert all(score(name, c) <= m for c, m in zip(index.forms, most.tolist(), strict=True)), (name, bound)
        for c in index.forms:
            assert similarity.partial_ratio(name, c) <= candidates.closer_partial(name, c)
            assert similarity.partial_token_ratio(name, c) <= candidates.closer_partial_token(name, c)


def test_edits_of_many_at_once():
    r = random.Random(5)
    listed = ["".join(r.choice("abcé") for _ in range(r.randint(0, 80))) for _ in range(300)]
    letters = candidates.Letters(listed)
    for n in (1, 2, 5, 30, 63, 64):
        name = "".join(r.choice("abcdé") for _ in range(n))
        own = np.array(r.sample(range(300), 200))
        assert letters.edits(name, own).tolist() == [similarity.levenshtein_distance(name, listed[i]) for i in own]


def test_few_pairs_are_scored():
    """50,000 candidates of invented words: few of all pairs are scored by a measure, of names that match and of others."""
    r = random.Random(11)
    syllables = ["ka", "ba", "lu", "mo", "ndi", "te", "ru", "si", "gwa", "po", "fe", "zo", "hy", "vi", "ce", "qui", "jar", "xo", "wen", "dul"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(2, 4)))
    kinds = ["hospital", "clinic", "health post", "centre de sante"]
    listed = list(dict.fromkeys(f"{word()} {word()} {r.choice(kinds)}" for _ in range(50_000)))
    index = candidates.Candidates(listed)
    for i in range(60):
        name = listed[r.randrange(len(listed))]
        at = r.randrange(len(name))
        candidates.match(name[:at] + "x" + name[at + 1 :] if i % 2 else f"{word()} {word()}", index, "rapid")
    print("pairs scored", index.scored / index.met)
    assert index.met > 2_900_000 and index.scored < 0.05 * index.met
