"""Names are cleaned once a value, not once a row and step."""

from pyspark.sql import functions as F

from atlasweave.operators import linkage


def test_names_are_cleaned_once(spark, monkeypatch):
    cleaned, real = spark.sparkContext.accumulator(0), linkage.preclean

    def counted(c):
        return real(F.udf(lambda x: cleaned.add(1) or x, "string")(c))

    monkeypatch.setattr(linkage, "preclean", counted)
    rows = spark.range(2000).selectExpr("id", "concat('Post ', id % 4) AS name")
    other = spark.range(500).selectExpr("id AS pos", "concat('Post ', id % 3) AS mname")
    out = linkage.block_match(rows, "name", other, "mname", "pos")
    assert out.filter("name_match_type = 'identical'").count() == 1500
    assert cleaned.value < 500
