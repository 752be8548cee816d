"""Spelling variants against a plain comparison of all words."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest

from atlasweave.llm import variants


def plain_words(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(docs):
    words = plain_words(docs)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_edit(v, w)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def misspelt(seed, n=400, alphabet="abÀé"):
    """Documents of words over few letters, so that most have near words, with runs and frequencies of all kinds."""
    r = random.Random(seed)
    base = ["".join(r.choice(alphabet) for _ in range(r.randint(6, 11))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa"]
    docs = []
    for i in range(n):
        words = []
        for _ in range(30):
            w = base[min(int(r.expovariate(0.15)), len(base) - 1)]
            for _ in range(r.choice((0, 0, 0, 0, 1, 1, 2))):
                at, kind = r.randrange(len(w)), r.randrange(3)
                w = w[:at] + r.choice(alphabet) * (kind > 0) + w[at + (kind < 2) :]
            words.append(w.upper() if r.random() < 0.1 else w)
        docs.append((i, r.choice((" ", ", ", "7", "Ā")).join(words)))
    return docs


@pytest.mark.parametrize(("seed", "group"), [(1, 20_000), (2, 30), (3, 4), (4, 1)])
def test_equal_to_plain(spark, seed, group):
    docs = misspelt(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS word", "'y' AS entry")
    expected = plain(docs)
    assert found(variants.spelling_variants(df, group=group)) == expected
    assert any(x[1] != x[2] and x[1] for x in expected) and sum(x[4] for x in expected) > 500


def test_automaton_numbers():
    r = random.Random(5)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(1, 8))) for _ in range(300)})
    a = variants.Automaton(words)
    assert [a.rest(a.start, 0, w, 0) for w in words] == list(range(len(words)))
    assert a.rest(a.start, 0, "cab" * 5, 0) == -1
    assert len(a.arcs) < len({w[:i] for w in words for i in range(9)})  # ends are shared
    for w in words[:60]:
        got = [words[i] for i, _ in a.near(w, 0)]
        assert sorted(got) == [v for v in words if one_edit(w, v)]
    assert variants.Automaton([]).rest(0, 0, "a", 0) == -1


def test_odd_rows(spark, odd, none):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert found(variants.spelling_variants(odd)) == plain(rows)
    assert found(variants.spelling_variants(none)) == set()
    assert found(variants.spelling_variants(spark.createDataFrame([(None, "longest longest"), (None, None)], "doc_id long, text string"))) == plain([(None, "longest longest")])


def test_query(spark):
    where = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{where}/documents.parquet").collect()]
    assert found(variants.op12_spelling_variants(spark, where)) == plain(docs)
