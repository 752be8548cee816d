"""Training samples where rows share an id, or a text."""

import pytest
from pyspark.sql import functions as F

from atlasweave.llm import langid, toxicity
from atlasweave.llm.common import sampled


@pytest.mark.parametrize("key", [0, 1, 7, None])
def test_one_id_teaches_every_language(spark, prose, key):
    rows = [(key, prose("en", 30, i), "en") for i in range(600)] + [(key, prose("fr", 30, i), "fr") for i in range(30)] + [(key, "la même ligne", "es")] * 500
    trees = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=40)
    assert trees.languages == ["en", "es", "fr"]


def test_samples_are_bounded_and_whole(spark):
    df = spark.range(50_000).selectExpr("id % 3 AS g", "CAST(1 AS long) AS doc_id", "CAST(id DIV 3 AS string) AS text").unionAll(spark.range(20_000).selectExpr("3L", "1L", "'same'"))
    rows = sampled(df, "g", 200).collect()
    counts = {g: len([r for r in rows if r["g"] == g]) for g in range(4)}
    assert counts == {0: 200, 1: 200, 2: 200, 3: 200}  # copies of the one row of group 3
    assert len({tuple(r) for r in rows if r['g'] < 3}) == 600
    few = spark.createDataFrame([(1, 1, 'a')] * 3 + [(1, 1, 'b')] * 50 + [(1, 1, 'c')], 'g long, doc_id long, text string')
    kept = [r['text'] for r in sampled(few, 'g', 5).collect()]
    assert len(kept) == 5 and set(kept) == {'a', 'b', 'c'}
    assert len(sampled(few, 'g', 100).collect()) == 54
    assert sorted(rows) == sorted(sampled(df.repartition(7), "g", 200).collect())  # whatever the order
    assert sampled(df.limit(0), "g", 5).count() == 0


def test_labels_of_one_id(spark):
    docs = spark.range(3_000).selectExpr("if(id < 2900, 5, id) AS doc_id", "concat('text ', id) AS text")
    labels = spark.range(3_000).selectExpr("if(id < 2900, 5, id) AS doc_id", "cast(id = 2999 as int) AS toxic").unionAll(spark.createDataFrame([(5, 0), (None, 1)], "doc_id long, toxic int"))
    rows = toxicity.training_rows(docs, labels, per_class=5)
    assert len(rows) == 6 and [r["doc_id"] for r in rows if r["toxic"]] == [2999]
    assert len({r["text"] for r in rows if not r["toxic"]}) == 5
    alone = toxicity.training_rows(docs.filter("doc_id = 5"), labels.filter(F.col("doc_id") == 5), per_class=5)
    assert len(alone) == 5
