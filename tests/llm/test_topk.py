import random

import pytest
from pyspark.sql import functions as F

from atlasweave.llm.topk import CandidateBlock, Questions, top_k, whole_numbers


def brute(vectors, queries, k):
    out = set()
    for q, a in queries:
        scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors if i != q and len(a) == len(b))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("rows", [7, 1000])
def test_against_brute_force(spark, rows):
    r = random.Random(1)
    same = [r.randint(-300, 300) for _ in range(12)]
    vectors = [(i, same if i % 3 == 0 else [r.randint(-300, 300) for _ in range(12)]) for i in range(300)] + [(1000 + i, [1, 2, i]) for i in range(4)]
    queries = [v for v in vectors if v[0] % 10 == 0]
    df = spark.createDataFrame([*vectors, (2000, None), (None, [1] * 12)], "vec_id long, v array<long>")
    got = top_k(df.withColumn("longest", F.lit("clash")), df.filter("vec_id % 10 = 0"), 5, rows=rows, round_bytes=2000)
    assert {tuple(x) for x in got.collect()} == brute(vectors, queries, 5)


def test_large_numbers_are_exact():
    import numpy as np

    big = 3_000_000_000
    asked = Questions(np.array([9]), np.array([[1, 1]]), 2)
    asked.search(CandidateBlock(np.array([1, 2]), np.array([[big, 1], [big, 2]])))
    asked.search(CandidateBlock(np.array([3]), np.array([[big, 2]])))
    assert asked.found().to_pydict() == {"query_id": [9, 9], "vec_id": [2, 3], "score": [big + 2, big + 2]}


def test_repeated_ids_count_once_by_their_best(spark):
    r = random.Random(5)
    rows = [(i % 60, [r.randint(-9, 9) for _ in range(4)]) for i in range(150)]
    rows += rows[:20] * 3
    df = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    best = {}
    for q, a in rows:
        for i, b in rows:
            if i != q and q % 10 == 0:
                score = sum(x * y for x, y in zip(a, b, strict=True))
                best[q, i] = max(best.get((q, i), score), score)
    want = set()
    for q in {q for q, _ in best}:
        ranked = sorted((-s, i) for (p, i), s in best.items() if p == q)[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked)}
    assert {tuple(x) for x in top_k(df, df.filter("vec_id % 10 = 0"), 5, rows=9, round_bytes=100).collect()} == want


def test_components_and_empty(spark):
    rows = [(1, [0.5, -0.001]), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, None), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", whole_numbers(F.col("e"), 256).alias("v"))
    assert {r["vec_id"]: r["v"] for r in df.collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
    assert top_k(df.limit(0), df.limit(0)).isEmpty()
    assert top_k(df, df.limit(0)).isEmpty()
    assert top_k(df, df).isEmpty()  # a vector alone in its width has no candidate
