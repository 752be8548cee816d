import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from atlasweave.llm.simhash import fingerprints, links, near_duplicates, one_of_each, stars
from atlasweave.operators.components import components


def plain(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    own = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def roots(fps, radius):
    parent = {x: x for x in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    fps = sorted(parent)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in fps}


def crowd(n=400, seed=1):
    """Fingerprints in dense and sparse groups."""
    r = random.Random(seed)
    out = set()
    for _ in range(8):
        base = r.getrandbits(64)
        bits = r.sample(range(64), 14)
        for _ in range(n // 8):
            out.add(base ^ sum(1 << b for b in r.sample(bits, r.randint(0, 6))))
    return sorted(out)


def test_fingerprints():
    texts = ["", None, "One", "A b", "a B c", "x y z w " * 50, "\x1cÄ ÀB  c\x85d e", "q" * 1000]
    assert [int(x) for x in fingerprints(texts)] == [plain(t) for t in texts]
    assert [int(x) for x in fingerprints(["p q r s t " * 60_000, "a b c d"])] == [plain("p q r s t " * 60_000), plain("a b c d")]


def test_stars():
    fps = crowd(120)
    found = {}
    for a, b in stars(np.array(fps, np.uint64), 3):
        found[int(b)] = int(a)
    want = roots(fps, 3)
    assert {x: found.get(x, x) for x in fps} == want


def test_links_lose_nothing(spark):
    fps = crowd()
    want = roots(fps, 3)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long").repartition(5)
    groups = {}
    for x, root in want.items():
        groups.setdefault(root, set()).add(x)
    for largest in (16_384, 20):  # 20: entries are filed again under finer keys
        got = {}
        for r in components(links(df, 3, largest)).collect():
            got.setdefault(r["root"], set()).add(int(np.int64(r["node"]).view(np.uint64)))
        assert sorted(map(sorted, got.values())) == sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_documents(spark, odd, none, prose):
    base = prose("en", 300, 1).split()
    near = [(100 + i, " ".join([*base[:-1], f"word{i}"])) for i in range(12)]
    far = [(200 + i, prose("de", 120, i)) for i in range(12)]
    df = spark.createDataFrame([*near, *far, *[(300, near[0][1])]], "doc_id long, text string").unionAll(odd.select("doc_id", "text"))
    fps = {}
    rows = [(r["doc_id"], plain(r["text"])) for r in df.collect()]
    want = roots([f for _, f in rows], 3)
    least = {}
    for i, f in rows:
        if i is not None:
            least[want[f]] = min(least.get(want[f], i), i)
    got = near_duplicates(df)
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got.collect()), key=str) == sorted(((i, f"{f:016x}", least.get(want[f])) for i, f in rows), key=str)
    assert near_duplicates(none).isEmpty()
    assert near_duplicates(odd.withColumn("u", F.lit(1))).count() == odd.count()
    assert fps == {}


@pytest.mark.parametrize("most", [200_000, 3])
def test_one_of_each(spark, odd, none, prose, most):
    a, b, c = (prose("en", 200, i) for i in range(3))
    near = [" ".join([*b.split()[:-1], f"end{i}"]) for i in range(4)]
    rows = [(3, a), (7, a), (7, b), (None, c), (None, a), (None, near[0]), (8, near[1]), (8, near[1]), (9, c + " x y z"), (9, "other words only here"), (5, "other words only here")]
    rows += [(9, "other words only here")] * 70 + [(4, "many rows alike")] * 80 + [(11, None), (10, ""), (None, None), (12, "  ")]
    df = spark.createDataFrame([(*r, i % 3, "z") for i, r in enumerate(rows)], "doc_id long, text string, fp int, __x0 string").repartition(3)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else 99, r["text"]) for r in one_of_each(df, most=most).collect())
    kept, seen = [], []
    for i, text in sorted(((99 if i is None else i, t) for i, t in rows), key=lambda r: (r[0], r[1] or "")):
        group = next((g for g in seen if (g[0] ^ plain(text)).bit_count() <= 3), None)  # groups here are no chains
        if group is None:
            seen.append((plain(text),))
            kept.append((i, text))
    assert len(got) == len(kept)
    assert sorted(x[0] for x in got) == sorted(x[0] for x in kept)
    assert one_of_each(df, most=most).columns == df.columns
    assert one_of_each(none, most=most).isEmpty()
    once = one_of_each(odd, most=most)
    assert once.columns == odd.columns
    assert sorted(str(r["doc_id"]) for r in once.collect()) == sorted(["1", "2", "5", "6", "7", "8", "None"])


def test_hot_fingerprints_and_hubs(spark):
    star = [(0, i) for i in range(1, 3000)] + [(3000 + i, 3001 + i) for i in range(40)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(star, "u long, v long").repartition(5)).collect()}
    assert got == {i: 0 if i < 3000 else 3000 for i in range(3041)}
    texts = [(i, "the same words in every one of them" if i % 3 else f"w{i} x{i} y{i} z{i}") for i in range(900)]
    found = near_duplicates(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: 1 if i % 3 else i for i, _ in texts}
