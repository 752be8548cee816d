"""Tables of which nine tenths have one name, one spot or no part: no task of a join back reads them all."""

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import linkage, skew, spatial, tables

N = 4_000


@pytest.fixture(autouse=True)
def few_rows_are_many(monkeypatch):
    monkeypatch.setattr(skew, "LEAST_HOT", 300)


def rows_of_tasks(df):
    return max(r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())


@pytest.fixture
def rows(spark):
    return spark.range(0, N, 1, 8).selectExpr(
        "id", "if(id % 10 < 9, 'Gulu Clinic', concat('Post ', id)) AS name", "if(id % 10 < 9, 30.0, 31 + id * 1e-3) AS lon", "2.5 AS lat", "if(id % 10 < 9, null, concat('u', id % 50)) AS part", "if(id % 10 < 9, ' ', 'x') AS blank"
    )


def test_one_name(spark, rows):
    match = spark.createDataFrame([(1, "Gulu Clinic"), (2, "Post 9")], "pos long, mname string")
    out = linkage.block_match(rows, "name", match, "mname", "pos")
    assert out.count() == N and out.filter("name_match_type = 'identical'").count() == N * 9 // 10 + 1
    assert rows_of_tasks(out) < N / 4


def test_one_spot(spark, rows):
    match = spark.createDataFrame([(1, "Gulu Clinic", 30.0, 2.5001)], "pos long, mname string, mlon double, mlat double")
    out = linkage.distance_match(rows, "id", "name", ("lon", "lat"), match, "mname", ("mlon", "mlat"), "pos", ["mname"])
    assert out.filter("name_match_result = 'YES'").count() == N * 9 // 10
    assert rows_of_tasks(out) < N / 4
    found = spatial.clusters(rows, "id", "lon", "lat", 50, "c")
    assert found.filter("c = 1").count() == N * 9 // 10


def test_no_part(spark, rows):
    points = spark.createDataFrame([(f"u{i}", 31.0, 2.5, i) for i in range(50)], "u string, mlon double, mlat double, pos long")
    out = linkage.match_distance(rows, "part", ("lon", "lat"), points, "u", ("mlon", "mlat"), "pos", "km")
    assert out.filter("km is not null").count() == N // 10
    assert rows_of_tasks(out) < N / 4


def test_group_sizes_and_maxima(rows):
    for column in ("blank", "part", "name"):
        out = tables.with_group_size(rows, [column], "size")
        assert out.filter("id = 0").first()["size"] == N * 9 // 10
        assert rows_of_tasks(out) < N / 4
    top = tables.with_group_max(rows, ["part", "blank"], "id", "top")
    assert top.filter("id = 0").first()["top"] == N - 2 and rows_of_tasks(top) < N / 4
    assert top.count() == N
