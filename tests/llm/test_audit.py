"""Filter audits against a plain restatement, whatever the rows are like."""

import re
from collections import Counter
from itertools import permutations

from pyspark.sql import functions as F

from atlasweave.llm import audit


def plain(docs, labels):
    """Rows (doc_id, text, lang) and (doc_id, quality, toxic) to the audit, one document at a time."""
    texts = [t or "" for _, t, _ in docs]
    least = {}
    for (i, _, _), t in zip(docs, texts, strict=True):
        if i is not None:
            least[t] = min(least.get(t, i), i)
    rows = []
    for (i, _, lang), t in zip(docs, texts, strict=True):
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and least[t] < i,
        }
        said = [(q, x) for j, q, x in labels if j == i and i is not None]
        rows.append((lang or "", fails, any(q == 1 for q, _ in said), any(x == 1 for _, x in said)))
    found, removed_by = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r[1:] for r in rows if r[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = list(range(len(own)))
            for step, x in enumerate(order, 1):
                gone = [k for k in left if own[k][0][x]]
                earlier = set(range(len(own))) - set(left)
                redundant = sum(own[k][0][x] for k in earlier)
                left = [k for k in left if not own[k][0][x]]
                unique = sum(f[x] and sum(f.values()) == 1 for f, _, _ in own)
                removed_by[part, x] += len(gone)
                found[part, order, step] = (len(left), len(gone), redundant, unique, sum(own[k][1] for k in gone), sum(own[k][2] for k in gone))
    return {k: (*v, removed_by[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(docs, labels):
    made = audit.order_audit(audit.mask_counts(docs, labels, audit.quality_conditions(F.coalesce("text", F.lit(""))), "E"), "ABCDE")
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in made.collect()}


def test_equal_to_plain(spark):
    many = " ".join(f"word{i}" for i in range(120))
    docs = [(1, many, "en"), (2, many, "en"), (2, many, "de"), (3, many + " #", None), (4, "AB", "en"), (5, None, "en"), (6, "", "fr"), (7, "", "fr"), (7, "", "fr"), (None, many, "en"), (None, many, "en")]
    docs += [(8, many + "\x0b\x85x", "fr"), (9, "a " * 300, "fr"), (10, "LOUD " * 200, ""), (11, "a " * 300, None), (12, many + "\U0001f600", "de")]
    labels = [(1, 1, 0), (1, None, 1), (2, 1, 0), (4, 0, 1), (5, None, None), (None, 1, 1), (9, 1, 1), (9, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "'x' AS same", "'y' AS id", "0 AS mask", "1 AS n")
    got = audited(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got == plain(docs, labels)
    assert len(got) == 4 * 600  # de, en, fr and none


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd.collect()]
    assert audited(odd, labels) == plain(rows, [(1, 1, 1)])
    assert audited(none, labels) == {}
    assert audited(odd, labels.limit(0)) == plain(rows, [])


def test_copies_are_few_rows(spark):
    """Half of all rows are one text: all but the first are repeats."""
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 2 = 0, 'same', concat('other ', id)) AS text", "'en' AS lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    cells = {r["mask"]: r["n"] for r in audit.mask_counts(docs, labels, {}, "E").collect()}
    assert cells == {0: 10_001, 1: 9_999}
