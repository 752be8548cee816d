"""Row, group and set operators on tables, each a pure DataFrame transformation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.functions.ids import fresh_names, unique_key
from atlasweave.functions.text import transliterate
from atlasweave.operators.skew import joined_by_key
from atlasweave.session import stored


def with_row_id(df: DataFrame, order: Sequence[str], out: str = "_rid") -> DataFrame:
    """Numbers rows from 0 in the order of ``order``. The sort is by ranges, so no task sees all
    rows: each partition counts its rows, and offsets are added to numbers within partitions. The
    sorted table is stored, since a number refers to the partition that gave it."""
    ordered = df.withColumn("__o", F.struct(*order)).repartitionByRange("__o").sortWithinPartitions("__o")
    placed = stored(ordered.withColumn("__p", F.spark_partition_id()).withColumn("__n", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = placed.groupBy("__p").agg(F.count("*").alias("__c"))
    before = sizes.select("__p", F.coalesce(F.sum("__c").over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__b"))
    return placed.join(before, "__p").withColumn(out, F.col("__b") + F.col("__n")).drop("__o", "__p", "__n", "__b")


def rename_apart(df: DataFrame, other: DataFrame, suffix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``suffix`` on every column that ``other`` has as well."""
    taken = set(other.columns) - set(keep)
    return df.withColumnsRenamed({c: f"{c}{suffix}" for c in df.columns if c in taken})


def drop_prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(prefix)])


def with_fallback(df: DataFrame, name: str | None, dummy: str) -> tuple[DataFrame, str]:
    """``df`` and the name of a column: the given one if the table has it, else a constant dummy."""
    if name and name in df.columns:
        return df, name
    return df.withColumn(dummy, F.lit(dummy)), dummy


def keep_where(df: DataFrame, keys: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Rows whose ``column`` is among the keys."""
    return df.join(keys.select(F.col(key or column).alias("__k")).distinct(), F.col(column) == F.col("__k"), "left_semi")


def drop_where(df: DataFrame, keys: DataFrame, column: str, key: str | None = None) -> DataFrame:
    """Rows whose ``column`` is not among the keys; null columns stay, null keys drop nothing."""
    return df.join(keys.select(F.col(key or column).alias("__k")).distinct(), F.col(column) == F.col("__k"), "left_anti")


def _as_text(key: Column) -> Column:
    """A key that is never null: null is unlike any text."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit(""))


def with_group_size(df: DataFrame, columns: Sequence[str], out: str = "count") -> DataFrame:
    """The number of rows with the same key (nulls are a key). Counted before the join back, and rows of keys
    with many stay where they are in it."""
    k, j, n = fresh_names([*df.columns, out], 3)
    keyed = df.drop(out).withColumn(k, _as_text(unique_key(columns)))
    sizes = stored(keyed.groupBy(F.col(k).alias(j)).agg(F.count("*").alias(out)).withColumn(n, F.col(out)))
    return joined_by_key(keyed, sizes, {k: j}, n).drop(k, j)


def with_duplicate_flag(df: DataFrame, column: str) -> DataFrame:
    """``<column>_isUnique``: 1 if the value occurs more than once, else 0."""
    return with_group_size(df, [column], "__c").withColumn(f"{column}_isUnique", (F.col("__c") > 1).cast("int")).drop("__c")


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return df.groupBy(column).agg(F.count("*").alias("n")).filter((F.col("n") > 1) & F.col(column).isNotNull())


def expand(df: DataFrame, column: str, out: str = "match_uuid_expand", sep: str = "/") -> DataFrame:
    """One row for each part of ``column``; a null stays one row with a null part."""
    return df.withColumn(out, F.explode_outer(F.array_distinct(F.split(F.col(column), F.lit(sep)))))


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("__r = 1").drop("__r")


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key in the given order; fewer if the key has fewer. Each task
    passes on ``k`` rows a key at most."""
    ranked = df.withColumn("__r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__r") <= k).drop("__r")


def with_group_max(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """``out``: the greatest ``value`` of the rows with the same keys (nulls are a key), aggregated
    before it is joined back."""
    k, j, n, top = fresh_names([*df.columns, out], 4)
    keyed = df.withColumn(k, F.concat_ws("\x01", *[_as_text(F.col(f"`{c}`")) for c in keys]))
    tops = stored(keyed.groupBy(F.col(k).alias(j)).agg(F.max(value).alias(top), F.count("*").alias(n)))
    return joined_by_key(keyed.drop(out) if out not in keys else keyed, tops, {k: j}, n).withColumn(out, F.col(top)).drop(k, j, top)


def with_repeat_flag(df: DataFrame, column: str, order: str, out: str = "was_dupe") -> DataFrame:
    """True on every row of a value but its first; ``order`` tells rows apart."""
    first = df.groupBy(F.col(column).alias("__k")).agg(F.min(order).alias("__first"))
    joined = df.join(first, F.col(column).eqNullSafe(F.col("__k")), "left")
    return joined.withColumn(out, ~F.col(order).eqNullSafe(F.col("__first"))).drop("__k", "__first")


def joined_values(value: Column, order: Column, sep: str = "/") -> Column:
    """Aggregate: distinct values in first-seen order, joined."""
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("o"), value.alias("v"))))
    return F.array_join(F.array_distinct(F.transform(ordered, lambda x: x["v"])), sep)


def overlap(left: Sequence[str], right: Sequence[str]) -> Column:
    """How many values, whatever their columns, two sets of columns share; nulls count for nothing."""
    text = lambda cs: F.array_compact(F.array(*[F.col(c).cast("string") for c in cs]))
    return F.size(F.array_intersect(text(left), text(right)))


def difference(left: Column, right: Column) -> Column:
    """Words of ``left``, upper case, once each and in order, that ``right`` lacks; null if there are none."""
    words = lambda c: F.split(F.upper(c), " ")
    return F.nullif(F.array_join(F.array_except(words(left), words(right)), " "), F.lit(""))


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of all tables, by name; a missing column is null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def transfer_columns(df: DataFrame, match: DataFrame, df_uuid: str, match_uuid: str, columns: Sequence[str]) -> DataFrame:
    """``df`` expanded by uuid with the match table's ``columns``; names both have get ``_2``."""
    wide = expand(df, df_uuid)
    other = rename_apart(match.select(F.col(match_uuid).alias("__u"), *columns), wide, "_2", keep=["__u"])
    return wide.join(other, F.col("match_uuid_expand") == F.col("__u"), "left").drop("__u")


def looked_up(df: DataFrame, match: DataFrame, df_key: str, match_key: str, columns: Mapping[str, str], order: str) -> DataFrame:
    """``df`` with columns of the first row of ``match`` that has its key, null if there is none."""
    first = match.groupBy(F.col(match_key).alias("__k")).agg(F.min_by(F.struct(*[F.col(c) for c in columns]), F.col(order)).alias("__s"))
    out = df.join(first, F.col(df_key) == F.col("__k"), "left")
    return out.withColumns({new: F.col("__s").getField(old) for old, new in columns.items()}).drop("__k", "__s")


def match_report(df: DataFrame, kind: str, result: str, score: str) -> DataFrame:
    """Rows and mean score of each method and result."""
    return df.groupBy(F.col(kind).alias("match_type"), F.col(result).alias("match_result")).agg(F.count("*").alias("n"), F.round(F.avg(score), 2).alias("avg_score"))


def word_frequency(names: DataFrame, column: str, threshold: int = 10) -> DataFrame:
    """Words and how often they occur, from ``threshold`` times on."""
    words = names.select(F.explode(F.split(F.col(column), r"\s+")).alias("word")).filter("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= threshold)


def type_candidates(words: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """Words of a frequency table that are type keywords, with their counts."""
    return words.filter(F.col("word").isin(*keywords)) if keywords else words.limit(0)


def spelling_candidates(words: DataFrame, distance: int = 1, least: int = 4) -> DataFrame:
    """(word, misspelling): pairs of words within ``distance`` edits, the more frequent one first.

    Two words within d edits that are cut into d + 1 pieces share a piece up to d characters aside,
    so words are joined on pieces and offsets, and only then compared.
    """
    own = words.filter(F.length("word") >= least).select("word", "n").withColumn("f", transliterate(F.lower("word")))
    pieces = distance + 1

    def cut(size: Column, i: int) -> tuple[Column, Column]:
        width = F.floor(size / pieces).cast("int")
        begin = F.lit(i) * width + 1
        return begin, (size - F.lit(i) * width) if i == pieces - 1 else width

    index, probes = [], []
    for i in range(pieces):
        begin, width = cut(F.length("f"), i)
        index.append(F.struct(F.lit(i).alias("i"), F.length("f").alias("size"), F.substr(F.col("f"), begin, width).alias("piece")))
        for other in range(-distance, distance + 1):
            size = F.length("f") + other
            b, w = cut(size, i)
            for shift in range(-distance, distance + 1):
                probes.append(F.struct(F.lit(i).alias("i"), size.alias("size"), F.when(b + shift >= 1, F.substr(F.col("f"), b + shift, w)).alias("piece")))
    a = own.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("f").alias("fa"), F.explode(F.array(*index)).alias("k")).select("*", "k.*").drop("k")
    b = own.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("f").alias("fb"), F.explode(F.array_distinct(F.array(*probes))).alias("k")).select("*", "k.*").drop("k")
    met = a.join(b, ["i", "size", "piece"]).filter((F.col("a") != F.col("b")) & (F.levenshtein("fa", "fb") <= distance))
    better = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    pair = met.select(F.when(better, F.col("a")).otherwise(F.col("b")).alias("word"), F.when(better, F.col("b")).otherwise(F.col("a")).alias("misspelling"))
    return pair.distinct()
