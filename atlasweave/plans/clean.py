"""The clean pipeline: standard names, spelling, types apart from names, metadata, checks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.functions import text
from atlasweave.functions.ids import with_required_fields
from atlasweave.functions.similarity import best_of, seq_ratio
from atlasweave.session import spread
from atlasweave.sources.dictionaries import Dictionaries, admin_label, poi_labels
from atlasweave.sources.tables import check_columns


@dataclass(frozen=True)
class CleanConfig:
    name: str
    iso: str
    source: str
    row_id: str
    poi_kind: str = "health_facility"
    type: str = ""
    boundaries: dict[int, str] = field(default_factory=dict)
    language: str = ""
    lat: str = ""
    long: str = ""
    date: str | None = None


def map_type(df: DataFrame, column: str, out: str, score: str, dictionary: Dictionaries) -> DataFrame:
    """The dictionary's type closest to ``column`` and how close; abbreviations come first and stand
    for their (last) type. Null stays null, and an empty dictionary maps all to null.

    Types are few and repeat: a task compares each it meets once and keeps up to 100,000 results. So
    ``df`` is gone through once, without a shuffle.
    """
    entries = [*dictionary.abbreviations, *dictionary.types]
    full = dict(zip(dictionary.abbreviations, dictionary.types, strict=False))
    lowered = [e.lower() for e in entries]

    def closest(value: str) -> tuple[str | None, int]:
        found, s = best_of(value.lower(), lowered, seq_ratio)
        entry = entries[lowered.index(found)] if found is not None else None
        return full.get(entry, entry), int(s) if found is not None else 0

    @F.pandas_udf("struct<t:string,s:int>")
    def best(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = lru_cache(maxsize=100_000)(closest)
        for values in batches:
            yield pd.DataFrame([(None, None) if v is None else known(v) for v in values], columns=["t", "s"])

    mapped = df.withColumn("__b", best(F.col(column)))
    return mapped.withColumns({out: F.col("__b.t"), score: F.col("__b.s")}).drop("__b")


def clean(df: DataFrame, config: CleanConfig, dictionary: Dictionaries) -> DataFrame:
    """``df`` with standard boundary names, name, type, scores, metadata and checks. One shuffle deals
    the rows over all cores, since cleaning takes long for few bytes."""
    check_columns(df, "input", [config.name, config.type, config.lat, config.long, *config.boundaries.values()])
    name, kind = poi_labels(config.poi_kind)
    out = text.with_standard_names(spread(df), {c: admin_label(config.iso, level) for level, c in sorted(config.boundaries.items()) if c})
    out = out.withColumn("clean_name", text.preclean(F.col(config.name)))
    out = out.withColumn("corrected_name", text.correct_spelling(F.col("clean_name"), dictionary.spelling))
    out = out.withColumn("corrected_name", text.clean_type_info(F.col("corrected_name"), dictionary.types, dictionary.abbreviations))
    out = out.withColumn("__final", text.remove_type_info(F.col("corrected_name"), dictionary.types, dictionary.abbreviations))
    out = out.withColumn("extract_type", text.extract_type(F.col("corrected_name"), F.col("__final")))
    out = out.withColumn(name, F.nullif(F.col("__final"), F.lit(""))).drop("__final")
    out = map_type(out, "extract_type", kind, "score", dictionary)
    if config.type:
        out = map_type(out, config.type, f"{kind}_orig", "score_orig", dictionary)
    out = out.withColumn(kind, text.fix_language(F.col(kind), config.language))
    out = with_required_fields(out, config.source, config.iso, config.row_id, config.date)
    out = out.withColumns({name: F.coalesce(F.col(name), F.lit("")), kind: F.coalesce(F.col(kind), F.lit(""))})
    return out.withColumns(text.sanity_columns(F.col(name), F.col(kind))).drop("clean_name", "corrected_name")
