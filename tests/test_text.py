"""Rule vectors of the text functions."""

import pytest
from pyspark.sql import functions as F

from atlasweave.functions import phonetic, text


def apply(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in rows]


def test_preclean(spark):
    cases = {
        "Heart1Hosp": "Heart 1 Hosp", "C.S. Saint-Luc II": "CS Saint Luc 2", "John`s R&D": "John s R D", "&": "And", "clinic I v": "Clinic 1 5",
        "St. Mary's And co iii": "St Mary'S and Co 3", "CS KAYAMBA & fils": "Cs Kayamba Fils", "hopital general de reference N 4bis": "Hopital General De Reference N 4 Bis",
        None: "", "": "", "X-II": "X Ii", "X Ii": "X 2", "Hôpital Œuvre Straße": "Hopital Oeuvre Strasse",
    }
    assert apply(spark, list(cases), text.preclean) == list(cases.values())


def test_title_case(spark):
    assert apply(spark, ["john's o'neil 3rd c.s", ""], text.title_case) == ["John'S O'Neil 3Rd C.S", ""]


def test_spelling(spark):
    fix = lambda c: text.correct_spelling(c, {"Hospital": ["Hopsital", "Hosptial"], "A$1": ["cost"], "Empty": []})
    assert apply(spark, ["Kaya hopsital", "a cost", "Hopsitals", None], fix) == ["Kaya Hospital", "a A$1", "Hopsitals", None]


def test_types(spark):
    assert apply(spark, ["C S Kaya", "Kaya c s", "c s", "Kaya district hospital"], lambda c: text.clean_type_info(c, ["Hospital District"], ["CS"])) == ["CS Kaya", "Kaya CS", "c s", "Kaya Hospital District"]
    remove = lambda c: text.remove_type_info(c, ["Centre De Sante", "Post"], ["CS"])
    assert apply(spark, ["Kayamba Centre De Sante", "Postville", "Dosso", "Cs Kaya"], remove) == ["Kayamba", "ville", "so", "Kaya"]
    assert text.type_keywords(["Centre De Sante", "Poste/Case"]) == ["Centre De Sante", "Poste/Case", "Centre", "Poste", "Sante", "Case"]


def test_extract_type(spark):
    rows = [("Kayamba Centre De Centre Sante", "Kayamba"), ("Kayamba", "Kayamba"), (None, None), ("De Kaya Du", "Kaya")]
    got = spark.createDataFrame(rows, "a string, b string").select(text.extract_type(F.col("a"), F.col("b")).alias("o")).collect()
    assert [r["o"] for r in got] == ["Centre De Sante", None, None, "Du"]


def test_language(spark):
    assert apply(spark, ["Hopital General De Reference"], lambda c: text.fix_language(c, "French")) == ["Hôpital Général de Référence"]
    assert apply(spark, ["Centro De Saude General"], lambda c: text.fix_language(c, "Portuguese")) == ["Centro de Saúde Geral"]
    assert apply(spark, ["De"], lambda c: text.fix_language(c, "English")) == ["De"]


@pytest.mark.parametrize(("last", "signs"), [(True, "("), (False, ")(")])
def test_sanity(spark, last, signs):
    row = spark.createDataFrame([("Dosso (Major)", None)], "n string, t string").select(*[c.alias(k) for k, c in text.sanity_columns(F.col("n"), F.col("t"), last).items()]).first()
    assert tuple(row) == (13, 0, signs, "")


def test_phonetic(spark):
    assert phonetic.nysiis("Watkins") == "WATCAN"
    assert phonetic.match_rating_code("Smithers") == "SMTHRS"
    assert phonetic.metaphone("Knight") == "NT"
    assert apply(spark, ["Robert 12", "a", None], lambda c: phonetic.phonetic_column(c, "soundex"))[0] == "R163 12"
    assert apply(spark, ["a", None], lambda c: phonetic.phonetic_column(c, "nysiis", fill=False)) == [None, None]
