"""Tables, spatial operators, linkage, sources: small cases with known results."""

import random

import pytest
from pyspark.sql import functions as F

from atlasweave.operators import linkage, spatial, tables
from atlasweave.operators.components import components
from atlasweave.sources import dictionaries
from atlasweave.sources.tables import check_columns, check_files, config_section, file_type, load_table, save_table, with_coordinate


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_row_ids_and_groups(spark):
    df = spark.createDataFrame([(i * 7 % 50, "x" if i % 3 else None) for i in range(50)], "k int, v string").repartition(5)
    got = tables.with_row_id(df, ["k"])
    assert rows(got, "k", "_rid") == sorted([(i, i) for i in range(50)], key=str)
    sizes = {r["v"]: r["count"] for r in tables.with_group_size(df, ["v"]).collect()}
    assert sizes == {"x": 33, None: 17}
    assert tables.with_group_size(df, ["k", "v"]).filter("count <> 1").isEmpty()


def test_expand_and_join(spark):
    df = spark.createDataFrame([(1, "A/B"), (2, "C"), (3, "A/B"), (4, None)], "id int, u string")
    assert rows(tables.expand(df, "u"), "id", "match_uuid_expand") == rows(spark.createDataFrame([(1, "A"), (3, "A"), (1, "B"), (3, "B"), (2, "C"), (4, None)], "a int, b string"), "a", "b")
    keys = spark.createDataFrame([(1,), (None,)], "id int")
    assert [r["id"] for r in tables.drop_where(df, keys, "id").collect()] == [2, 3, 4]


def test_clusters(spark):
    # A and B are 10 m apart, C is far; D stands on A; E has no point
    df = spark.createDataFrame([(1, 0.0, 1.0), (2, 0.00009, 1.0), (3, 1.0, 1.0), (4, 0.0, 1.0), (5, None, 1.0)], "id int, lon double, lat double")
    assert rows(spatial.clusters(df, "id", "lon", "lat", 25, "c"), "id", "c") == rows(spark.createDataFrame([(1, 1), (2, 1), (3, -1), (4, 1), (5, None)], "id int, c long"), "id", "c")


def test_near_pairs_far_north(spark):
    r = random.Random(3)
    pts = [(i, r.uniform(10, 10.2), r.uniform(69.9, 70.0)) for i in range(150)]
    a = spark.createDataFrame(pts, "i int, x double, y double")
    b = a.select(F.col("i").alias("j"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    got = spatial.near_pairs(a, b, 700, ("x", "y"), ("x2", "y2"))
    from atlasweave.functions.geo import haversine_km

    brute = a.crossJoin(b).filter(haversine_km(F.col("x"), F.col("y"), F.col("x2"), F.col("y2")) <= 0.7)
    assert rows(got, "i", "j") == rows(brute, "i", "j")


def test_ring_distance(spark):
    ring = F.expr("array(named_struct('x', 0D, 'y', 0D), named_struct('x', 1D, 'y', 0D), named_struct('x', 1D, 'y', 1D), named_struct('x', 0D, 'y', 1D))")
    df = spark.createDataFrame([(0.5, 0.5), (2.0, 0.0), (0.5, -1.0)], "x double, y double").select(spatial.ring_distance(F.col("x"), F.col("y"), ring).alias("d"))
    got = [r["d"] for r in df.collect()]
    assert got[0] == 0
    assert got[1] == pytest.approx(spatial.METRES_PER_DEGREE)
    assert got[2] == pytest.approx(spatial.METRES_PER_DEGREE)


def test_components(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}
    assert components(spark.createDataFrame([], "u long, v long")).isEmpty()


def test_block_match_groups_agree(spark):
    """Cutting blocks into small groups changes nothing."""
    r = random.Random(2)
    names = [("b", "".join(r.choice("abcde") for _ in range(6))) for _ in range(40)]
    cands = [("b", "".join(r.choice("abcde") for _ in range(6)), i) for i in range(30)]
    left = spark.createDataFrame(sorted(set(names)), "block string, clean string")
    right = spark.createDataFrame(cands, "block string, clean string, pos long").dropDuplicates(["block", "clean"])
    whole = rows(linkage.best_in_blocks(left, right, "rapid", 1000).filter("method <> 'partial_ratio' and method <> 'partial_token_ratio'"), "clean", "name", "method")
    parts = {x[0]: x for x in rows(linkage.best_in_blocks(left, right, "rapid", 7), "clean", "name", "method")}
    assert all(parts[x[0]] == x for x in whole)


def test_block_match(spark):
    df = spark.createDataFrame([(1, "Kaya", "a"), (2, "Kayo", "a"), (3, "Kaya", "z"), (4, None, "a"), (5, "Kaya", None)], "id int, name string, adm string")
    match = spark.createDataFrame([(1, "kaya", "a"), (2, "Other Place", "a"), (3, "kaya", "b")], "pos int, mname string, madm string")
    got = linkage.block_match(df, "name", match, "mname", "pos", "admin2", ["adm"], ["madm"])
    found = {r["id"]: (r["name_match_name"], r["name_match_result"], r["name_match_type"]) for r in got.collect()}
    assert found[1] == ("Kaya", "YES", "admin2/ identical")
    assert found[2] == ("Kaya", "YES", "admin2/ levenshtein")
    assert found[3] == (None, "NO", None)
    assert found[5] == (None, "NO", None)
    assert found[4][1] == "NO"


def test_resolvers(spark):
    df = spark.createDataFrame([(1, "A", "levenshtein", 95.0, "YES"), (2, "A", "levenshtein", 88.0, "YES"), (3, "B", "identical", 100.0, "YES"), (4, "B", "partial_ratio", 100.0, "YES")], "id int, u string, t string, s double, r string")
    got = linkage.resolve_by_best_match(df, "u", "id", "t", "s", "r", "id")
    assert {x["id"]: x["r"] for x in got.collect()} == {1: "YES", 2: "NO", 3: "YES", 4: "NO"}


def test_sources(spark, tmp_path):
    assert [file_type(p) for p in ("a/b.csv", "x.gdb/layer", "y.XLSX", "z", "q.gpkg")] == ["csv", "feature", "excel", "unknown", "gpkg"]
    (tmp_path / "latin.csv").write_bytes("a , lat\nhôtel,1\n<NULL>,null\n".encode("latin-1"))
    df = load_table(spark, str(tmp_path / "latin.csv"), lat="lat")
    assert rows(df, "a", "lat") == [("hôtel", 1.0), (None, None)]
    assert rows(load_table(spark, save_table(df, str(tmp_path / "out.parquet"))), "a") == [("hôtel",), (None,)]
    with pytest.raises(Exception, match="no coordinate"):
        with_coordinate(spark.createDataFrame([("x1",)], "v string"), "v").collect()
    with pytest.raises(ValueError, match="lacks b"):
        check_columns(df, "input", ["a", "", None, "b"])
    with pytest.raises(FileNotFoundError):
        check_files(spark, [str(tmp_path / "none")])
    (tmp_path / "c.ini").write_text("[inputs]\nname = x\nflag = True\n")
    assert config_section(str(tmp_path / "c.ini"), "inputs", ["name"])["flag"] == "True"
    with pytest.raises(KeyError):
        config_section(str(tmp_path / "c.ini"), "inputs", ["other"])


def test_dictionaries(spark, tmp_path):
    assert dictionaries.country_file_name("civ") == "Cote_dIvoire"
    assert dictionaries.poi_labels("school") == ("g3_school", "g3_school_type")
    assert dictionaries.poi_labels("zoo")[0] == "g3_unknown"
    with pytest.raises(ValueError, match="no boundary level"):
        dictionaries.admin_label("nga", "boundary4")
    folder = tmp_path / "school"
    folder.mkdir()
    (folder / "moz_spelling_dictionary.csv").write_text("word,misspelling\nEscola,Escolla\nEscola,Escla\n")
    (folder / "moz_type_dictionary.csv").write_text("type,abbreviation\nEscola Primaria,EP\n")
    got = dictionaries.load_dictionaries(spark, "moz", "school", str(tmp_path))
    assert got == dictionaries.Dictionaries({"Escola": ["Escolla", "Escla"]}, ["Escola Primaria"], ["EP"])
    assert tuple(dictionaries.dictionary_report(spark, str(tmp_path)).first()) == ("school", 1, 1, 1)
