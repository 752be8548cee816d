"""Licenses with edits spread so that no long stretch is left unedited."""

import random

import numpy as np
import pytest

from atlasweave.llm.decontaminate import find_passages
from atlasweave.llm.licenses import TEMPLATES, LicenseIndex, scan_licenses
from atlasweave.llm.passages import normal, normal_block


def test_spread_edits_are_found(spark):
    docs = [(1, "Released unter the MIT Iicense"), (2, "some words. Licemsed under XC BY-NC 4,0! more")]
    got = scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["license"], r["edits"]) for r in got) == [(1, "MIT", 2), (2, "CC-BY-NC-4.0", 2)]


def test_all_edits_of_the_budget_are_found():
    r = random.Random(4)
    index = LicenseIndex(TEMPLATES, 4, 1, 0.85)
    cases, texts = [], []
    for name, p, budget in zip(index.names, index.index.patterns, index.edits, strict=True):
        for _ in range(40):
            chars = [chr(c) for c in p]
            for at in sorted(r.sample(range(1, len(chars) - 1), int(budget)), reverse=True):
                chars[at : at + 1] = r.choice(["", "q", chars[at] + "z"])
            if "  " in "".join(chars):  # the normal form would make it more edits
                continue
            cases.append(name)
            texts.append("vor dem text " + "".join(chars) + " nach dem text")
    found = index.search(normal_block(texts))
    assert [i for i, name in enumerate(cases) if name not in {h[0] for h in found.get(i, [])}] == []


def test_short_templates_are_searched():
    index = LicenseIndex({"X": ["ab cd"], "Y": ["zlib notes"]}, 4, 1, 0.7)
    assert len(normal("ab cd")) == 5
    assert len(index.unsure) == 2
    found = index.search(normal_block(["nothing", "long before Ab, cx after", "a zlub motes"]))
    assert {k: [(h[0], h[4]) for h in v] for k, v in found.items()} == {1: [("X", 1)], 2: [("Y", 2)]}
    assert np.all(index.edits == [1, 3])


@pytest.mark.parametrize("step", [9, 11, 14])
def test_a_body_behind_its_unedited_notice(spark, step):
    """The notice as it is, the rest of the body with one character in every few changed: the body is reported."""
    notice, body = TEMPLATES["MIT"][2:4]
    assert body.startswith(notice)
    rest = list(body[len(notice) :])
    for i in range(step - 1, len(rest), step):
        rest[i] = "q" if rest[i].isalpha() else rest[i]
    text = "some words in front " + notice + "".join(rest) + " and behind"
    rows = scan_licenses(spark.createDataFrame([(1, text), (2, "x " + notice + " y")], "doc_id long, text string")).collect()
    best = {r["doc_id"]: max((x for x in rows if x["doc_id"] == r["doc_id"]), key=lambda x: x["matched"]) for r in rows}
    assert best[1]["license"] == "MIT" and best[1]["coverage"] > 0.8 and best[1]["end"] - best[1]["start"] > 900
    assert best[2]["license"] == "MIT" and best[2]["end"] - best[2]["start"] <= len(notice)


def test_key_named_like_a_result(spark):
    df = spark.createDataFrame([(1, "Released under the MIT License")], "edits long, text string")
    with pytest.raises(ValueError, match="edits"):
        scan_licenses(df, key="edits")
    with pytest.raises(ValueError, match="start"):
        find_passages(df.withColumnRenamed("edits", "start"), df.selectExpr("edits AS item_id", "text"), key="start")
