from collections import Counter

import corpus_pipeline
from atlasweave.llm import registry


def documents(spark, prose):
    rows = [(i, prose(lang, 60, i), lang, f"s{i % 3}", 0) for i, lang in enumerate(["en", "de", "fr", "es"] * 15)]
    long = prose("en", 400, "long").split()
    rows += [(500, " ".join(long), "en", "s0", 0), (501, " ".join(long), "en", "s0", 0), (502, " ".join([*long[:-1], "other"]), "en", "s1", 0)]
    rows += [(600, prose("fr", 30, "p") + " " + prose("en", 45, "leak") + " " + prose("fr", 30, "q"), "fr", "s1", 0)]
    rows += [(700, "12 34 !!", "en", "s1", 0), (701, None, None, None, None), (702, "", "en", "s2", 0)]
    rows += [(800, prose("es", 40, "pii") + " a@b.com +49 30 1234567 end", "es", "s2", 0), (801, "x " + prose("es", 50, "c"), None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.selectExpr("doc_id", "text", "lang", "source", "coalesce(n_chars, 0) + coalesce(length(text), 0) AS n_chars")


def test_stages(spark, prose, tmp_path):
    spark.createDataFrame([(1, prose("en", 45, "leak"))], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, prose)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    ids = lambda df: Counter(r["doc_id"] for r in df.select("doc_id").collect())
    start, sf = ids(docs), str(tmp_path)
    steps = dict(corpus_pipeline.STAGES)
    known = steps["language_id"](spark, docs, sf)
    assert known.columns == docs.columns
    assert ids(known) == start - Counter([700, 701, 702])
    single = steps["near_duplicates"](spark, known, sf)
    assert single.columns == docs.columns
    assert ids(single) == ids(known) - Counter([501, 502])
    clean = steps["decontamination"](spark, single, sf)
    assert ids(clean) == ids(single) - Counter([600])
    private = steps["personal_data"](spark, clean, sf)
    assert private.columns == docs.columns
    before, after = ({r["doc_id"]: r for r in x.collect()} for x in (clean, private))
    assert after[800]["text"].endswith("[EMAIL] [PHONE] end")
    assert after[800]["n_chars"] == len(after[800]["text"])
    assert all(after[i] == before[i] for i in before if i != 800)
    packed = steps["packing"](spark, private, sf).collect()
    assert {r["doc_id"] for r in packed} == set(ids(private))
    whole = corpus_pipeline.run(spark, sf).collect()
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(whole) == key(packed)


def test_stages_take_odd_rows(spark, odd, none, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for df in (odd, none):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, df, str(tmp_path)).columns == odd.columns
        assert corpus_pipeline.STAGES[-1][1](spark, df, str(tmp_path)).count() >= (df is odd)


def test_registry():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))
