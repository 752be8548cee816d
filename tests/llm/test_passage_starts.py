"""Passages of benchmark items wherever they begin, and short items."""

import random

from atlasweave.llm.decontaminate import SegmentIndex, find_passages, without_passages
from atlasweave.llm.passages import normal, normal_block


def test_every_stretch_of_the_length_is_found(prose):
    r = random.Random(9)
    item = "".join(map(chr, normal(prose("en", 90, "starts"))))[:300].strip()
    index = SegmentIndex([(1, item)], 12, 0.05, 100, 24)
    for n, edits in ((100, 0), (100, 5), (120, 5), (140, 5)):
        texts = []
        for at in range(len(item) - n + 1):
            part = list(item[at : at + n])
            # ends are left: cutting them would make the passage shorter
            for k in r.sample([i for i in range(1, n - 1) if part[i] != " "], edits):
                part[k] = "0"
            texts.append(f"{prose('fr', 5, at)} {''.join(part)} {prose('fr', 5, -at)}")
        found = index.search(normal_block(texts))
        assert [i for i in range(len(texts)) if i not in found] == []
    assert index.search(normal_block([prose("fr", 400, "x")])) == {}


def test_hits_are_dealt_to_all_segments_that_hold_them(prose):
    items = [(i, prose("en", 10 * i + 8, i)) for i in range(8)]
    index = SegmentIndex(items, 12, 0.05, 100, 24)
    for k, (_, codes) in enumerate(index.items):
        at, p, position = index.index.hits(codes)
        own = index.index.item[p] == k
        got = sorted(zip(p[own & (at == index.index.start[p] + position)].tolist(), position[own & (at == index.index.start[p] + position)].tolist(), strict=True))
        segments = [s for s in range(len(index.index.item)) if index.index.item[s] == k]
        assert got == [(s, i) for s in segments for i in range(int(index.index.sizes[s]) - 11)]
        assert index.index.start[segments[-1]] + index.index.sizes[segments[-1]] == len(codes)


def test_short_items_are_found_unedited(spark):
    bench = spark.createDataFrame([(1, "Art of War?"), (2, "7 x 6"), (3, "!!"), (4, "猫が好き")], "item_id long, text string")
    docs = [(1, "the ART, of war"), (2, "part of war"), (3, "art of wart"), (4, "what is 7 x 6"), (5, "私は猫が好きです"), (6, "!! art of"), (7, None), (8, "art of war"), (9, "of war")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = sorted((h["doc_id"], h["item_id"], h["start"], h["end"], h["edits"], h["matched"]) for h in find_passages(df, bench).collect())
    assert got == [(1, 1, 4, 15, 0, 1.0), (4, 2, 8, 13, 0, 1.0), (5, 4, 2, 6, 0, 1.0), (8, 1, 0, 10, 0, 1.0)]
    assert {x["doc_id"] for x in without_passages(df, bench).collect()} == {2, 3, 6, 7, 9}
