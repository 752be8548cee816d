"""Benchmark passages and licenses."""

import random

import numpy as np
from pyspark.sql import functions as F

from atlasweave.llm.decontaminate import SegmentGrams, find_passages, without_passages
from atlasweave.llm.licenses import TEMPLATES, Scanner, scan_licenses, winnow
from atlasweave.llm.passages import GramIndex, banded, local, normal, normal_block, regions


def plain_best(pattern, text):
    """Fewest edits between the pattern and any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row = row, [i]
        for j, y in enumerate(text, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return min(row)


def test_banded_alignment():
    r = random.Random(3)
    for _ in range(200):
        pattern = [r.choice("abc") for _ in range(12)]
        at = r.randint(0, 10)
        text = [r.choice("abc") for _ in range(at)] + pattern + [r.choice("abc") for _ in range(8)]
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(text))
            text[k : k + 1] = r.choice([[], ["a"], ["b", "c"]])
        codes = lambda s: np.array([ord(c) for c in s], np.uint16)
        want = plain_best(pattern, text)
        got = banded(codes(pattern), codes(text), 0, len(text) + len(pattern), len(pattern))
        assert got is not None
        assert got[0] == want
        assert plain_best(pattern, text[got[1] : got[2]]) == want
        assert banded(codes(pattern), codes(text), 0, len(text) + len(pattern), want - 1) is None


def test_normal_form():
    texts = ["Ab,  c\U0001f600D!", None, "", "x"]
    block = normal_block(texts)
    assert "".join(map(chr, normal("Ab,  cD!"))) == "ab cd"
    first = block.codes[block.starts[0] : block.starts[1]]
    places = block.places[block.starts[0] : block.starts[1]]
    assert [texts[0][p].lower() for c, p in zip(first, places, strict=True) if c > 32] == ["a", "b", "c", "d"]


def edited(r, text, n):
    chars = list(text)
    for _ in range(n):
        chars[r.randrange(len(chars))] = r.choice("qz")
    return "".join(chars)


def test_decontamination(spark, odd, none, prose):
    r = random.Random(7)
    items = [(i, prose("en", 40, f"item{i}")) for i in range(8)] + [(50, None), (51, ""), (52, "short"), (None, prose("en", 40, "lost"))]
    docs = []
    for i in range(8):
        pad, tail = prose("fr", 50, f"a{i}"), prose("fr", 50, f"b{i}")
        docs.append((i, f"{pad}\n{items[i][1].upper()}! {tail}"))  # in full, other case and signs
        docs.append((100 + i, f"{pad} {edited(r, items[i][1], 4)} {tail}"))  # with edits
        docs.append((200 + i, f"{pad} {items[i][1][20:190]} {tail}"))  # a passage
        docs.append((300 + i, f"{pad} {tail}"))  # clean
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for chars in (1 << 24, 300):  # one block of items, several
        hits = find_passages(df, bench, block_chars=chars).collect()
        assert {(h["doc_id"], h["item_id"]) for h in hits} == {(b + i, i) for i in range(8) for b in (0, 100, 200)}
    text = dict(docs)
    for h in hits:
        if h["doc_id"] < 100:
            assert list(normal(text[h["doc_id"]][h["start"] : h["end"]])) == list(normal(items[h["item_id"]][1]))
            assert (h["edits"], h["matched"]) == (0, 1.0)
    assert {x["doc_id"] for x in without_passages(df, bench).collect()} == {300 + i for i in range(8)}
    assert find_passages(odd, bench).isEmpty()
    assert without_passages(odd, bench).count() == odd.count()
    assert without_passages(odd, bench).columns == odd.columns
    assert find_passages(none, bench).isEmpty()
    assert find_passages(df, bench.limit(0)).isEmpty()
    assert without_passages(df, bench.limit(0)).count() == df.count()


def test_licenses(spark, odd, none, prose):
    docs = [
        (1, prose("en", 30, 1) + ". This work is licensed under the GNU General Public License, version 3. " + prose("en", 30, 2)),
        (2, "Released under  the MIT\nLicense."),
        (3, prose("en", 200, 3)),
        (4, "released under the MIT licence"),
        (5, None),
    ]
    got = scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"], r["edits"]) for r in got) == [(1, "GPL-3.0", 0), (2, "MIT", 0), (4, "MIT", 1)]
    r = next(x for x in got if x["doc_id"] == 2)
    assert docs[1][1][r["start"] : r["end"]] == "Released under  the MIT\nLicense"
    assert scan_licenses(odd).isEmpty()
    assert scan_licenses(none).isEmpty()
    assert scan_licenses(odd, {}).isEmpty()


def test_winnow():
    keys = np.random.default_rng(1).integers(0, 50, 200).astype(np.uint64)
    chosen = winnow(keys, 4)
    assert all(any(i <= c < i + 4 and keys[c] == keys[i : i + 4].min() for c in chosen) for i in range(197))
    assert len(winnow(keys[:3], 4)) == 1
    assert len(winnow(keys[:0], 4)) == 0


def plain_local(pattern, text):
    """Score of the best local alignment: 2 a match, -3 an edit."""
    best, row = 0, [0] * (len(text) + 1)
    for x in pattern:
        last, row = row, [0]
        for j, y in enumerate(text, 1):
            row.append(max(0, last[j - 1] + (2 if x == y else -3), last[j] - 3, row[j - 1] - 3))
        best = max(best, *row)
    return best


def test_local_alignment():
    r = random.Random(5)
    codes = lambda s: np.array([ord(c) for c in s], np.uint16)
    for _ in range(150):
        pattern = [r.choice("abc") for _ in range(14)]
        text = [r.choice("abc") for _ in range(r.randint(0, 9))] + pattern[3:11] + [r.choice("abc") for _ in range(5)]
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(text))
            text[k : k + 1] = r.choice([[], ["a"], ["b", "c"]])
        got = local(codes(pattern), codes(text), -len(pattern), len(text))
        assert 2 * got[0] - 3 * got[1] == plain_local(pattern, text)
        part, stretch = pattern[got[2] : got[3]], text[got[4] : got[5]]
        assert plain_local(part, stretch) == 2 * got[0] - 3 * got[1]
        assert len(part) <= got[0] + got[1] >= len(stretch)
    assert local(codes("abc"), codes("xyz"), -3, 3) is None


def test_regions_in_slices():
    r = random.Random(6)
    items = ["".join(r.choice("ab c") for _ in range(r.randint(30, 90))) for _ in range(20)]
    texts = ["".join(r.choice("ab c") for _ in range(r.randint(0, 400))) + r.choice(items) for _ in range(12)] + ["", None]
    block = normal_block(texts)
    for index in (GramIndex([normal(t) for t in items], 4), SegmentGrams([normal(t) for t in items], 4, 20, 4)):
        n = len(index.sizes)
        band, least = np.array([1 + i % 3 for i in range(n)]), np.array([6 + i % 4 for i in range(n)])
        want = sorted(regions(index, block, band, least))
        assert want
        for most in (1, 50, 3000):
            assert sorted(regions(index, block, band, least, most)) == want


def test_license_bodies_in_part(spark, prose):
    body = " ".join(TEMPLATES["MIT"][-1].split())
    words = body.split()
    half = " ".join(words[: len(words) // 2])
    r = random.Random(9)
    docs = [
        (1, "Copyright me. " + body + " and code"),
        (2, prose("fr", 40, 1) + " " + half + " " + prose("fr", 40, 2)),
        (3, prose("de", 30, 1) + " " + edited(r, body, len(body) // 25)),
        (4, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
        (5, prose("en", 300, 4)),
        (6, half + " " + prose("fr", 200, 5) + " " + half),
        (7, TEMPLATES["BSD-3-Clause"][0]),
        (8, TEMPLATES["AGPL-3.0"][0]),
        (9, TEMPLATES["GPL-2.0"][1] + "\n\n" + TEMPLATES["ISC"][0]),
    ]
    rows = {}
    for x in scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        rows.setdefault(x["doc_id"], []).append(x)
    text = dict(docs)
    best = {i: max(found, key=lambda x: x["matched"]) for i, found in rows.items()}
    assert {i: x["license"] for i, x in best.items()} == {1: "MIT", 2: "MIT", 3: "MIT", 4: "MIT", 6: "MIT", 7: "BSD-3-Clause", 8: "AGPL-3.0", 9: best[9]["license"]}
    assert best[1]["coverage"] == 1.0
    assert text[1][best[1]["start"] : best[1]["end"]].startswith("Permission is hereby")
    assert 0.4 < best[2]["coverage"] < 0.6
    assert normal(text[2][best[2]["start"] : best[2]["end"]]).tobytes().startswith(normal(half).tobytes()[:400])
    assert best[3]["coverage"] > 0.9
    assert [(x["coverage"], x["edits"]) for x in rows[4]] == [(1.0, 0)]
    assert sum(0.4 < x["coverage"] < 0.6 for x in rows[6]) == 2
    assert best[7]["coverage"] == best[8]["coverage"] == 1.0
    assert {x["license"] for x in rows[9] if x["coverage"] > 0.9} == {"GPL-2.0", "ISC"}
    # every stretch of a body that is long enough is found, wherever it begins
    codes = normal(body)
    index = Scanner(TEMPLATES, 4, 1, 0.85, 12, 8, 60).bodies
    plain = "".join(map(chr, codes))
    starts = list(range(0, len(plain) - 70, 7))
    found = index.search(normal_block(["zq zq " + plain[at : at + 70] + " zq zq" for at in starts]))
    assert sorted(found) == list(range(len(starts)))


def test_very_long_texts(spark, prose):
    item = prose("en", 40, "far")
    filler = prose("de", 20_000, "long")
    long = (filler + " ") * 20  # over a million characters: a block of its own
    docs = [(1, long + item + " " + long[:1000] + " Released under the MIT License."), (2, None), (3, ""), (1, "short"), (None, "zz " + item)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert len(docs[0][1]) > 1 << 20
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    hits = find_passages(df, bench).collect()
    assert sorted((h["doc_id"], h["item_id"], h["edits"]) for h in hits if h["doc_id"]) == [(1, 7, 0)]
    assert sum(h["doc_id"] is None for h in hits) == 1
    found = next(h for h in hits if h["doc_id"])
    assert list(normal(docs[0][1][found["start"] : found["end"]])) == list(normal(item))
    assert [(x["doc_id"], x["license"], x["start"]) for x in scan_licenses(df).collect()] == [(1, "MIT", docs[0][1].index("Released"))]
