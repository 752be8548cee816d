"""A stream of several batches gives what one join of all rows gives, with the match table prepared once."""

import pytest
from pyspark.sql import functions as F

from atlasweave.operators.linkage import block_match, match_columns
from atlasweave.streaming import matching


@pytest.fixture
def tables(spark):
    rows = spark.range(60).selectExpr("id", "concat(if(id % 3 = 0, 'Gulu ', 'Lira '), if(id % 2 = 0, 'Hospital', 'Clinik'), ' ', id % 7) AS name", "concat('d', id % 4) AS district")
    match = spark.range(40).selectExpr("id AS pos", "concat(if(id % 3 = 0, 'Gulu ', 'Lira '), 'Clinic ', id % 9) AS mname", "concat('d', id % 5) AS mdistrict")
    return rows, match


def plain(df):
    return sorted(tuple(r) for r in df.select("id", *match_columns("name")).withColumn("name_match_score", F.round("name_match_score", 6)).collect())


def test_batches_equal_one_join(spark, tables, tmp_path):
    rows, match = tables
    expected = plain(block_match(rows, "name", match, "mname", "pos", "", ["district"], ["mdistrict"]))
    for k in range(3):  # three batches, a file each
        rows.filter(F.col("id") % 3 == k).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in*")
    matching.match_stream(stream, "name", match, "mname", "pos", ["district"], ["mdistrict"], f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.select("batch").distinct().count() == 3
    assert plain(out) == expected


def test_batches_do_not_prepare_the_match_table(spark, tables, tmp_path):
    rows, match = tables
    index = matching.store_match_index(match, "mname", "pos", ["mdistrict"], path=f"{tmp_path}/index")
    batch = matching.match_batch(rows, "name", index, ["district"])
    plan = batch._jdf.queryExecution().analyzed().toString()
    assert "mname" not in plan and "mdistrict" not in plan
    assert plain(batch) == plain(block_match(rows, "name", match, "mname", "pos", "", ["district"], ["mdistrict"]))
    with pytest.raises(Exception, match="exists"):
        matching.store_match_index(match, "mname", "pos", ["mdistrict"], path=f"{tmp_path}/index")
