"""Match tables in which several records have one uuid."""

from atlasweave.operators import linkage

RECORDS = [(7, "A", "x", "y", 5.0), (2, "A", "p", "q", 1.0), (4, "A", "x", "q", 9.0), (3, "B", "x", "y", 2.0), (9, "B", "p", "q", 8.0)]


def test_first_record_by_order_counts(spark):
    records = spark.createDataFrame(RECORDS, "pos long, u string, ma string, mb string, plon double").selectExpr("*", "0D AS plat").repartition(5)
    got = {r["__u"]: r["__mlon"] for r in linkage.match_points(records, "u", ("plon", "plat"), "pos").collect()}
    assert got == {"A": 1.0, "B": 2.0}
    # of the first records B's shares more with the row; of A's others one would share as much
    df = spark.createDataFrame([(1, 1, "A", "YES", "x", "y"), (2, 1, "B", "YES", "x", "y")], "row long, id long, part string, result string, a string, b string").selectExpr("*", "part AS uuid")
    kept = linkage.resolve_by_attribute(df, "id", "uuid", "part", "result", ["a", "b"], records, "u", ["ma", "mb"], "pos", "row")
    assert [(r["row"], r["uuid"]) for r in kept.collect()] == [(2, "B")]


def test_every_record_of_a_matched_uuid_is_flagged(spark):
    records = spark.createDataFrame(RECORDS, "pos long, u string, ma string, mb string, plon double")
    matched = spark.createDataFrame([("A", "YES"), ("B", "NO")], "part string, result string")
    got = {r["pos"]: r["ismatch"] for r in linkage.with_is_match(records, "u", matched, "part", "result").collect()}
    assert got == {7: "YES", 2: "YES", 4: "YES", 3: "NO", 9: "NO"}
