import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from atlasweave.llm.packing import Places, fullest, minimum_bin_slack, pack_documents
from atlasweave.llm.tokens import ChunkEncoder, count_tokens, frequent_chunks

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["a<|endoftext|>b don't I'LL x\x1cy ÅÅ Å σΣ　ß ½² 你好 \x85a\xa0b", "", None, "'s'S", "Ⅷ①12", "<|ENDOFTEXT|>", "Σ ΟΔΟΣ", "x" * 300, "é e ́", "İ İ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(library):
    small = ChunkEncoder(PATH, limit=3)  # evicts all the time
    for _ in range(2):
        assert small.values(TEXTS) == [np.array(ids(library, t), "<u4").tobytes() for t in TEXTS]


PLAIN = ChunkEncoder(PATH)
NUMBERS = ChunkEncoder(PATH, numbers=True, limit=50)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F), max_size=40), max_size=4))
def test_encoder_equals_library_on_any_characters(texts):
    want = [PLAIN.library.encode(t, add_special_tokens=False).ids for t in texts]
    assert PLAIN.values(texts) == [np.array(w, "<u4").tobytes() for w in want]
    assert NUMBERS.values(texts) == [len(w) for w in want]


def test_every_character_after_before_and_inside_a_word():
    texts = [t for c in map(chr, range(0x250)) for t in (f"abc{c}", f"{c}abc", f"ab{c}c d{c}", f"Ab{c}{c}", f"7{c}")]
    want = [e.ids for e in PLAIN.library.encode_batch(texts, add_special_tokens=False)]
    assert PLAIN.values(texts) == [np.array(w, "<u4").tobytes() for w in want]


def test_counts(spark, odd, none, library):
    got = count_tokens(odd, PATH, table_size=5, per_task=3)
    assert set(got.columns) == set(odd.columns) | {"n_bytes", "n_tokens", "over_limit"}
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), len(ids(library, r["text"]))) for r in odd.collect())
    assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert count_tokens(none, PATH).isEmpty()
    more = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    assert {r["doc_id"]: r["n_tokens"] for r in count_tokens(more, PATH).collect()} == {i: len(ids(library, t)) for i, t in enumerate(TEXTS)}


def test_frequent_chunks(spark, none):
    r = random.Random(8)
    texts = [" ".join(f"w{int(r.paretovariate(0.7))}" for _ in range(200)) for _ in range(60)]
    want = Counter(w for t in texts for w in t.split())
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(13)
    for fan in (3, 100):  # several levels of summaries
        assert frequent_chunks(df, "text", 10_000, 10_000, fan=fan) == [w for w, _ in sorted(want.items(), key=lambda x: (-x[1], x[0]))]
        assert len(frequent_chunks(df, "text", 30, 100, fan=fan)) == 30
    assert frequent_chunks(none, "text", 30, 10) == []


def test_fullest():
    r = random.Random(4)
    for _ in range(200):
        counts = {r.randint(1, 12): r.randint(1, 4) for _ in range(4)}
        room = r.randint(0, 40)
        sums = {0}
        for k, n in counts.items():
            sums = {s + k * c for s in sums for c in range(n + 1) if s + k * c <= room}
        chosen = fullest(counts, room)
        assert sum(k * n for k, n in chosen.items()) == max(sums)
        assert all(n <= counts[k] for k, n in chosen.items())


def lower_bound(histogram, capacity, small):
    """No packing needs fewer: pieces too long for any piece of ``small`` or more stand alone, those
    over half stand apart, and the others fill at most what these leave."""
    alone = sum(n for k, n in histogram.items() if k > capacity - small)
    half = [(k, n) for k, n in histogram.items() if capacity / 2 < k <= capacity - small]
    rest = sum(k * n for k, n in histogram.items() if small <= k <= capacity / 2)
    room = sum((capacity - k) * n for k, n in half)
    return alone + sum(n for _, n in half) + max(0, -(-(rest - room) // capacity))


def test_bins_take_everything_once():
    r = random.Random(6)
    histogram = {r.randint(1, 100): r.randint(1, 500) for _ in range(60)}
    bins = minimum_bin_slack(histogram, 100)
    taken = Counter()
    for alike, combination in bins:
        assert sum(k * n for k, n in combination.items()) <= 100
        for k, n in combination.items():
            taken[k] += n * alike
    assert taken == Counter(histogram)
    places = Places(bins)
    assert places.n_bins <= 1.01 * max(lower_bound(histogram, 100, small) for small in range(51))


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing(spark, odd, none, library, capacity):
    out = pack_documents(odd, PATH, capacity).collect()
    want = Counter()
    for r in odd.collect():
        own = [*ids(library, r["text"]), 0]
        for piece, at in enumerate(range(0, len(own), capacity)):
            part = own[at : at + capacity]
            want[(r["doc_id"], piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert pack_documents(none, PATH, capacity).isEmpty()
