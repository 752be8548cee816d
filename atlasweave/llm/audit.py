"""Audit of how filters interact: what each removes, alone, after others and in every order.

A text's failures are one bit mask, worked out by native expressions. Documents are counted by mask,
2^k cells for k filters in each part of the table, and every order of the filters is read from the
cells, so the corpus is passed once however many orders there are.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasweave.llm.common import read_table

#: How many partitions rows without an id, which have no label, are spread over.
SPREAD = 256
SPACES = "\t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_list(text: Column) -> Column:
    """Maximal runs without a space or one of the five control characters that break lines or cells."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def quality_conditions(text: Column) -> dict[str, Column]:
    """When a text, not null, fails: A under 100 words, B under 80 % distinct words, C over 10 %
    capitals, D a sign of ``#$%&*|``."""
    words = word_list(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * (F.length(text) - F.length(F.translate(text, UPPER, ""))) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def mask_counts(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column], repeat: str, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic): documents by the filters they fail, and how many of them some row of
    ``labels`` says are good (quality 1) or toxic.

    Bit i of the mask is the i-th letter, in alphabetical order, of ``conditions`` (columns over ``docs``)
    and ``repeat``: a text that a smaller key has as well, wherever in the table. Texts are grouped by
    SHA-256, so no text is shuffled; a group's rows are counted by cell before it meets, so a text of
    any number of copies is a few rows. A null text is empty; a null part is the empty string; rows
    without a key repeat nothing and have no label. Repeated rows count each, and with equal keys
    none repeats the other. An empty table gives an empty result; other columns are ignored.
    """
    letters = sorted([*conditions, repeat])
    if len(set(letters)) != len(conditions) + 1 or any(len(x) != 1 for x in letters):
        raise ValueError("filters are single letters, once each")
    bit = {x: 1 << i for i, x in enumerate(letters)}
    mask = sum((F.when(fails, bit[x]).otherwise(0) for x, fails in conditions.items()), F.lit(0))
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.unhex(F.sha2(whole, 256)).alias("same"), F.col(key).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.cast("int").alias("mask"))
    rows = rows.groupBy("same", "id", "part", "mask").agg(F.count("*").alias("n"))
    said = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("of")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # rows without an id join nothing, wherever they are sent
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("same"), F.lit(SPREAD))).otherwise(0).alias("salt")
    joined = rows.withColumn("salt", salt).join(said.withColumn("salt_of", F.lit(0).cast("long")), (F.col("id") == F.col("of")) & (F.col("salt") == F.col("salt_of")), "left")
    # of a text: its least key in each cell, how many rows have that, and how many have none
    cells = joined.groupBy("same", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(
        F.sum("n").alias("n"), F.min("id").alias("least"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("n"))), F.lit(0)).alias("without"), F.max_by("n", -F.col("id")).alias("at_least")
    )
    first = F.min("least").over(Window.partitionBy("same"))
    original = F.col("without") + F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = cells.withColumn("first", first).select(
        "part", "good", "toxic", F.explode(F.array(F.struct(F.col("mask").alias("mask"), original.alias("n")), F.struct((F.col("mask") + bit[repeat]).alias("mask"), (F.col("n") - original).alias("n")))).alias("c")
    )
    counted = split.filter("c.n > 0").groupBy("part", F.col("c.mask").alias("mask"))
    return counted.agg(F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


def order_audit(cells: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order of the filters and step, from ``mask_counts`` (whose bits are the
    letters in alphabetical order): kept after the step, removed by it, redundant (failing its filter,
    removed earlier), unique_fails (failing its filter only), good_lost and toxic_lost of the removed, and
    shapley: what its filter removes, summed over all orders.

    Zeros are rows. A part has 2^k cells at most, whatever it holds, and k! * k result rows.
    """
    letters = "".join(sorted(letters))
    orders = ["".join(p) for p in permutations(letters)]
    each = cells.select("*", F.explode(F.array(*map(F.lit, orders))).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))

    def bits(holds) -> Column:
        return sum((F.when(holds(F.instr(F.col("filter_order"), x)), 1 << i).otherwise(0) for i, x in enumerate(letters)), F.lit(0))

    fails, earlier = F.col("mask").bitwiseAND(bits(lambda at: at == F.col("step"))) > 0, F.col("mask").bitwiseAND(bits(lambda at: at < F.col("step"))) > 0
    count = lambda of, when: F.sum(F.when(when, F.col(of)).otherwise(F.lit(0).cast("long")))
    # a document goes to each of the filters it fails in equally many orders
    share = F.floor(F.lit(len(orders)) / F.bit_count("mask")).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        count("n", ~fails & ~earlier).alias("kept"),
        count("n", fails & ~earlier).alias("removed"),
        count("n", fails & earlier).alias("redundant"),
        count("n", fails & (F.bit_count("mask") == 1)).alias("unique_fails"),
        count("good", fails & ~earlier).alias("good_lost"),
        count("toxic", fails & ~earlier).alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share).otherwise(F.lit(0).cast("long"))).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    return order_audit(mask_counts(docs, labels, quality_conditions(F.coalesce("text", F.lit(""))), "E"), "ABCDE")


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < 100)::INT AS "A",
    (100 * len(list_distinct(words)) < 80 * len(words))::INT AS "B",
    (100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text))::INT AS "C",
    regexp_matches(text, '[#$%&*|]')::INT AS "D",
    coalesce(w.doc_id > first, false)::INT AS "E"
  FROM w LEFT JOIN l USING (doc_id)),
cells AS (SELECT part, "A", "B", "C", "D", "E", count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
x(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
failed AS (SELECT part, filter_order, n, good, toxic, list_transform(string_split(filter_order, ''), lambda letter: CASE letter WHEN 'A' THEN "A" WHEN 'B' THEN "B" WHEN 'C' THEN "C" WHEN 'D' THEN "D" ELSE "E" END) AS fails
  FROM cells, orders),
steps AS (SELECT part, filter_order, step, n, good, toxic, fails[step] = 1 AS own, coalesce(list_sum(fails[1:step - 1]), 0) > 0 AS earlier, list_sum(fails) = 1 AS single
  FROM failed, range(1, 6) AS s(step)),
r AS (SELECT part, filter_order, step::INT AS step,
    sum(CASE WHEN NOT own AND NOT earlier THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN own AND NOT earlier THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN own AND earlier THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN own AND single THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN own AND NOT earlier THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN own AND NOT earlier THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT *, sum(removed) OVER (PARTITION BY part, filter_order[step])::BIGINT AS shapley FROM r
"""
