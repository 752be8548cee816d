"""Blocks cut into groups give what whole blocks give, in the partial stages too."""

import random

import pytest

from atlasweave.operators import linkage

FIELDS = ("clean", "name", "score", "method", "result")


@pytest.mark.parametrize("kind", ["rapid", "sequence"])
def test_partial_stages_see_the_whole_block(spark, kind):
    r = random.Random(11)
    word = lambda n: "".join(r.choice("abcdefgh") for _ in range(n))
    names = {word(8) for _ in range(15)} | {f"{word(4)} {word(4)}" for _ in range(5)}
    # eight candidates hold each name, behind more or less text, some of it too much for the second ratio
    cands = {word(r.randint(4, 22)) + n for n in sorted(names) for _ in range(8)}
    left = spark.createDataFrame([("b", n) for n in sorted(names)], "block string, clean string")
    right = spark.createDataFrame([("b", c, i % 50) for i, c in enumerate(sorted(cands, key=lambda c: c[::-1]))], "block string, clean string, pos long")
    found = [{x["clean"]: tuple(x[f] for f in FIELDS) for x in linkage.best_in_blocks(left, right, kind, group).collect()} for group in (1000, 7, 20)]
    assert sum(x[3].startswith("partial") for x in found[0].values()) >= 1
    assert found[1] == found[0]
    assert found[2] == found[0]
