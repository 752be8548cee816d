"""Pipelines against their parts: DuckDB for what SQL can say, plain Python for the rest."""

import re

import duckdb
import pytest
from test_definitions import seq, seq_set

from atlasweave.functions import text
from atlasweave.plans.clean import CleanConfig, clean
from atlasweave.queries import ABBREVIATIONS, BOXES, CLUSTER_SQL, CUSTOMER_POINTS, DICTIONARY, NEAREST_SQL, POI, QUERIES, SIGNS_SQL, SQL, TABLE, TYPES, preclean_sql
from atlasweave.sources.tables import load_table, save_table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in "region nation customer supplier part".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def mapped(value):
    """The closest entry of the dictionary, abbreviations first, and how close."""
    if value is None:
        return None, None
    entries, full = [*ABBREVIATIONS, *TYPES], dict(zip(ABBREVIATIONS, TYPES, strict=True))
    s, _, e = max((seq(value.lower(), e.lower()), -i, e) for i, e in enumerate(entries))
    return full.get(e, e), s


def french(value):
    for word, written in text.FRENCH.items() if value else ():
        value = re.sub(rf"\b{word.title()}\b", written, value)
    return value or ""


def test_clean(spark, con):
    final, extracted = dict(con.execute(SQL["type_remove"]).fetchall()), dict(con.execute(SQL["type_extract"]).fetchall())
    raw = {r[0]: r[1:] for r in con.execute(f"SELECT k, {preclean_sql('brand')}, kind, upper(substr(md5(concat('WHO|moz|', CAST(k AS STRING))), 1, 10)) FROM ({POI})").fetchall()}
    signs = dict(con.execute(f"SELECT DISTINCT name, {SIGNS_SQL} FROM (SELECT unnest(?) AS name)", [[x or "" for x in final.values()]]).fetchall())
    got = QUERIES["pipeline_clean"](spark, SF).collect()
    assert len(got) == len(raw)
    for r in got:
        brand, kind, code = raw[r["k"]]
        name = final[r["k"]] or ""
        label, score = mapped(extracted[r["k"]])
        other, other_score = mapped(kind)
        assert (r["g3_prov"], r["g3_hltfac"], r["extract_type"]) == (brand, name, extracted[r["k"]])
        assert (r["g3_hltfac_type"], r["score"]) == (french(label), score)
        assert (r["g3_hltfac_type_orig"], r["score_orig"]) == (other, other_score)
        assert (r["g3_id"], r["g3_date"], r["g3_iso"], r["g3_source"]) == (f"WHO_{code}", "20240101", "moz", "WHO")
        assert (r["name_length"], r["type_length"], r["special_chars"]) == (len(name), len(french(label)), signs[name])


def test_assess(spark, con):
    got = {r["k"]: r for r in QUERIES["pipeline_assess"](spark, SF).collect()}
    points = {k: (lat, lon) for k, lat, lon in con.execute(f"SELECT k, CAST(lat AS DOUBLE), CAST(lon AS DOUBLE) FROM ({CUSTOMER_POINTS})").fetchall()}
    assert sorted(got) == sorted(points)
    placed = {k for k, (lat, lon) in points.items() if lat and lon}
    near = {k: (region, nation, d) for k, _, region, nation, d in con.execute(NEAREST_SQL).fetchall()}
    own = {k: (nation, region) for k, nation, region in con.execute(f"SELECT c_custkey, {preclean_sql('concat(chr(78), substr(concat(chr(65), chr(84)), 1, 2), chr(73), chr(79), chr(78), chr(95), CAST(c_nationkey AS STRING))')}, {preclean_sql('r_name')} FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey").fetchall()}
    clean = dict(con.execute(f"SELECT DISTINCT admin1, {preclean_sql('admin1')} FROM ({BOXES}) UNION SELECT DISTINCT admin2, {preclean_sql('admin2')} FROM ({BOXES})").fetchall())
    close = lambda a, b: "YES" if seq(a, b) >= 75 or seq_set(a, b, seq) >= 98 else "NO"
    for k, r in got.items():
        if k not in placed:
            assert (r["settlement_type"], r["admin1_bryMatch"], r["admin2_bryMatch"], r["is_overlap"], r["geo_dbscan_r25_cluster_id"]) == ("NA", "NA", "NA", "NA", None)
            continue
        assert r["settlement_type"] == (near[k][0] if k in near and near[k][2] < 250 else "Out of a settlement")
        assert r["admin1_bryMatch"] == (close(own[k][1], clean[near[k][0]]) if k in near else "NO")
        assert r["admin2_bryMatch"] == (close(own[k][0], clean[near[k][1]]) if k in near else "NO")
    for metres in (25, 50):
        located = CUSTOMER_POINTS + " WHERE c_custkey IN (SELECT unnest(?))"
        want = con.execute(CLUSTER_SQL.replace(CUSTOMER_POINTS, located).replace("<= 60", f"<= {metres}"), [sorted(placed)]).fetchall()
        assert {k: r[f"geo_dbscan_r{metres}_cluster_id"] for k, r in got.items() if k in placed} == dict(want)


def test_configuration_equals_calls(spark, tmp_path):
    """What files and configuration give is what the functions give."""
    from pyspark.sql import functions as F

    from atlasweave.plans.match import MatchConfig, match

    got = QUERIES["config_pipeline"](spark, SF)
    poi = spark.read.parquet(f"{SF}/part.parquet").createOrReplaceTempView("part") or spark.sql(POI).select("name", "kind", "brand")
    table = spark.sql(TABLE).select("mname", "madmin1", "madmin2", "mkind")
    from atlasweave.plans.run import _numbered
    from atlasweave.sources.dictionaries import Dictionaries

    config = CleanConfig("name", "moz", "WHO", "_rid", type="kind", boundaries={1: "brand"})
    cleaned = clean(_numbered(poi), config, Dictionaries()).drop("_rid")
    ready = load_table(spark, save_table(cleaned, str(tmp_path / "c.csv")))
    wanted = match(_numbered(ready), _numbered(table.select([F.col(c).cast("string") for c in table.columns]), "_mrid"), MatchConfig("g3_hltfac", "_rid", "mname", "_mrid", "", "g3_prov", "", "", "madmin2", ""))[0]
    columns = ["name", "g3_hltfac_match_name", "g3_hltfac_match_result", "g3_hltfac_match_type", "match_uuid_expand"]
    plain = lambda df: sorted(tuple("" if x in (None, " ") else str(x) for x in r) for r in df.select(*columns).collect())
    assert plain(got) == plain(wanted)
    assert DICTIONARY.types == TYPES


def test_admin_check_query(spark, con):
    near = {k: (nation, d) for k, _, _, nation, d in con.execute(NEAREST_SQL).fetchall()}
    clean = dict(con.execute(f"SELECT DISTINCT admin2, {preclean_sql('admin2')} FROM ({BOXES})").fetchall())
    for r in QUERIES["admin_check"](spark, SF).collect():
        if r["k"] not in near:
            assert (r["admin2_bry_clean"], r["admin2_bryMatch"], r["metres"]) == (None, "NO", None)
            continue
        own, name = f"Nation {r['k'] % 25}", clean[near[r["k"]][0]]
        yes = seq(own, name) >= 75 or seq_set(own, name, seq) >= 98
        assert (r["admin2_bry_clean"], r["admin2_bryMatch"]) == (name, "YES" if yes else "NO")
        assert r["metres"] == pytest.approx(near[r["k"]][1], abs=0.01)
