"""A corpus pipeline over ``documents``: language identification, near-duplicates, benchmark
decontamination, personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on every row the stage before has kept, over whole
texts of any length. An empty table gives an empty one; columns may have any names and, but for the
last stage, come out as they went in. Repeated rows are rows each, but for near-duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm import decontaminate, langid, packing, pii, simhash
from atlasweave.llm.common import fresh_names, read_table, split_of, written

#: SQL expresses none of context trees, bit-majority fingerprints, alignment and packing.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: those without a letter, empty and null texts."""
    trees = langid.train(docs.filter(split_of(F.col("doc_id")) != 1))
    (found,) = fresh_names(docs.columns, 1)
    return langid.identify(docs, trees, out=found).filter(F.col(f"{found}.lang_pred") != langid.UNDETERMINED).drop(found)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies, the one with the least id. Rows without an id are
    taken like others and come last; of repeated rows one stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of ``benchmark``; null and empty texts hold none."""
    return decontaminate.without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind; n_chars follows the new text. Null texts stay null."""
    clean = pii.redact_personal_data(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the texts into sequences of at most 2048 tokens: one row for each piece of a document. A null
    or empty text is a piece of its own; a null id stays null."""
    import public_tokenizers

    # the executors' heaps are full of what earlier stages left, so the caches are smaller than alone
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), cache=250_000)


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written before the next reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
