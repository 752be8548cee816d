"""Workbooks, shapefiles, geopackages: written and read back, and built by hand."""

import datetime
import io
import sqlite3
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from atlasweave.plans.run import run_assess
from atlasweave.sources import dictionaries, layers, workbooks
from atlasweave.sources.tables import load_polygons, load_table, polygon_parts, save_table


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def workbook(sheets, shared=(), styles=None, strict=True):
    """A workbook from sheets of raw row XML."""
    main, relation = workbooks.MAIN[1:-1], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{relation}"><sheets>' + "".join(f'<sheet name="s{i}" sheetId="{i}" r:id="r{i}"/>' for i in range(len(sheets))) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="{"worksheets" if i else "/xl/worksheets"}/x{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si>{s}</si>" for s in shared) + "</sst>")
        if styles:
            z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}">{styles}</styleSheet>')
        for i, s in enumerate(sheets):
            z.writestr(f"xl/worksheets/x{i}.xml", f'<worksheet xmlns="{main}"><sheetData>{s}</sheetData></worksheet>')
    return out.getvalue()


def test_workbook_by_hand(spark, tmp_path):
    styles = '<numFmts><numFmt numFmtId="170" formatCode="[Red]0.0"/><numFmt numFmtId="171" formatCode="yyyy\\-mm"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
    one = '<row><c t="s" r="A1"><v>0</v></c><c t="s" r="C1"><v>1</v></c><c t="s" r="D1"><v>0</v></c></row>'
    one += '<row><c r="A2"><v>1.50</v></c><c r="C2" s="1"><v>45292</v></c><c r="D2" t="b"><v>1</v></c></row><row/>'
    one += '<row><c r="A4" t="e"><v>#N/A</v></c><c r="B4" s="2"><v>7</v></c><c r="C4" s="3"><v>45292.5</v></c></row>'
    two = '<row><c t="inlineStr"><is><t>other</t></is></c><c t="s"><v>1</v></c></row><row><c t="str"><v>x &amp; y</v></c></row>'
    (tmp_path / "b.xlsx").write_bytes(workbook([one, two, ""], ["<t>a</t>", "<r><t>d</t></r><r><t>ay</t></r><rPh><t>no</t></rPh>"], styles))
    got = load_table(spark, str(tmp_path / "b.xlsx"))
    assert got.columns == ["a", "Unnamed: 1", "day", "a.1", "other"]
    want = [("1.50", None, "2024-01-01", "True", None), (None, "7", "2024-01-01 12:00:00", None, None), (None, None, None, None, "x & y")]
    assert rows(got, "*") == sorted(want, key=str)


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "é <&> \x01\"'", 0.5, True, datetime.date(2024, 1, 2)), (2, None, None, None, None), (3, "  ", -1e300, False, None)], "a int, `b c` string, d double, e boolean, f date")
    path = save_table(df.withColumn("geometry", F.lit("no")), str(tmp_path / "out.xls"))
    assert path.endswith("out.xlsx")
    got = load_table(spark, path)
    assert rows(got, "*") == sorted([("1", "é <&> \"'", "0.5", "True", "2024-01-02"), ("2", None, None, None, None), ("3", "  ", "-1e+300", "False", None)], key=str)
    assert load_table(spark, save_table(df.limit(0), str(tmp_path / "none.xlsx"))).columns == df.columns
    assert save_table(df, str(tmp_path / "flat.gpkg")).endswith("flat.xlsx")


def box(x, y, size):
    return [(x, y), (x, y + size), (x + size, y + size), (x + size, y), (x, y)]  # clockwise


LAYER = [
    (1, "Nord é", 1.5, True, layers.wkb_polygon([box(0.0, 0.0, 4.0), box(1.0, 1.0, 1.0)[::-1]])),
    (2, None, None, None, layers.wkb_many(6, [layers.wkb_polygon([box(0.0, 0.0, 1.0)]), layers.wkb_polygon([box(5.0, 5.0, 3.0), box(6.0, 6.0, 1.0)[::-1]])])),
    (3, "x" * 300, -2.0, False, None),
]


@pytest.fixture
def layer(spark):
    return spark.createDataFrame([(*r[:4], r[4] and bytearray(r[4])) for r in LAYER], "bid long, nm string, v double, ok boolean, geometry binary")


@pytest.mark.parametrize("suffix", ["shp", "gpkg"])
def test_layer_round_trip(spark, tmp_path, layer, suffix):
    path = save_table(layer, str(tmp_path / f"l.{suffix}"))
    got = {r["bid"]: r for r in load_polygons(spark, path).collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1]["nm"], got[1]["v"], got[1]["ok"]) == ("Nord é", 1.5, True)
    assert (got[2]["v"], got[2]["ok"]) == (None, None)
    assert got[3]["nm"] == "x" * (254 if suffix == "shp" else 300)
    for i, _, _, _, blob in LAYER:
        parts = got[i]["ring"]
        assert (parts and [[[tuple(p) for p in ring] for ring in part] for part in parts]) == polygon_parts(blob)
    points = spark.createDataFrame([(1, bytearray(layers.wkb_point((1.25, -2.5)))), (2, None)], "k long, geometry binary")
    back = load_table(spark, save_table(points, str(tmp_path / f"p.{suffix}")))
    assert rows(back, "k", F.hex("geometry")) == rows(points, "k", F.hex("geometry"))
    assert load_table(spark, save_table(points.limit(0), str(tmp_path / f"e.{suffix}"))).isEmpty()


def test_shapes_by_hand():
    line = struct.pack("<i4d2i2i", 13, 0, 0, 2, 1, 2, 4, 0, 2) + struct.pack("<8d", 0, 0, 1, 1, 2, 0, 2, 1) + b"\0" * 48
    many = struct.pack("<i4di", 8, 0, 0, 1, 1, 2) + struct.pack("<4d", 0, 0, 1, 1)
    body = b"".join(struct.pack(">2i", i, len(r) // 2) + r for i, r in enumerate((struct.pack("<i", 0), line, many, struct.pack("<i3d", 11, 3, 4, 5))))
    got = list(layers.shapes(b"\0" * 100 + body))
    want = [None, layers.wkb_many(5, [layers.wkb_line([(0, 0), (1, 1)]), layers.wkb_line([(2, 0), (2, 1)])]), layers.wkb_many(4, [layers.wkb_point((0, 0)), layers.wkb_point((1, 1))]), layers.wkb_point((3, 4))]
    assert got == want
    assert layers._dbf_names(["a_long_name_one", "a_long_name_two", "b"]) == ["a_long_nam", "a_long_n_1", "b"]
    # a hole lies in the smallest outer ring around it
    big, small = box(0, 0, 10), box(1, 1, 5)
    assert layers.polygons_of([big, box(2, 2, 1)[::-1], small]) == [[big], [small, box(2, 2, 1)[::-1]]]


def test_geopackage_of_others(spark, tmp_path):
    base = sqlite3.connect(str(tmp_path / "x.gpkg"))
    base.execute("CREATE TABLE gpkg_geometry_columns (table_name, column_name)")
    base.execute('CREATE TABLE "my layer" (fid INTEGER PRIMARY KEY, "shape" BLOB, name TEXT(20), n MEDIUMINT, at DATETIME, pic BLOB)')
    base.execute("INSERT INTO gpkg_geometry_columns VALUES ('my layer', 'shape')")
    blob = layers.wkb_point((1.0, 2.0))
    envelope = b"GP" + struct.pack("<BBi4d", 0, 3, 4326, 1, 1, 2, 2) + blob
    base.executemany('INSERT INTO "my layer" VALUES (?, ?, ?, ?, ?, ?)', [(1, envelope, "a", 5, "2024-01-01T00:00:00Z", b"x"), (2, b"GP" + struct.pack("<BBi", 0, 17, 4326), None, None, None, None)])
    base.commit()
    base.close()
    got = load_table(spark, str(tmp_path / "x.gpkg"))
    assert got.columns == ["fid", "name", "n", "at", "geometry"]
    assert rows(got, "fid", "name", "n", F.hex("geometry")) == [(1, "a", 5, blob.hex().upper()), (2, None, None, None)]


def test_dictionaries_as_workbooks(spark, tmp_path):
    folder = tmp_path / "school"
    folder.mkdir()
    save_table(spark.createDataFrame([("Escola", "Escolla"), ("Escola", "Escla"), (None, "x")], "word string, misspelling string").coalesce(1), str(folder / "moz_spelling_dictionary.xlsx"))
    save_table(spark.createDataFrame([("Escola Primaria", "EP")], "type string, abbreviation string"), str(folder / "moz_type_dictionary.xlsx"))
    got = dictionaries.load_dictionaries(spark, "moz", "school", str(tmp_path))
    assert got == dictionaries.Dictionaries({"Escola": ["Escolla", "Escla"]}, ["Escola Primaria"], ["EP"])
    assert tuple(dictionaries.dictionary_report(spark, str(tmp_path)).first()) == ("school", 1, 1, 1)
    with pytest.raises(ValueError, match="over 1 rows"):
        dictionaries._bounded(load_table(spark, str(folder / "moz_spelling_dictionary.xlsx")), ["word"], 1)


def test_assess_from_files(spark, tmp_path):
    """The assess pipeline from a configuration whose boundaries are a shapefile and a geopackage."""
    folder = str(tmp_path)
    poi = [(1, "Clinic A", "Clinic", "North", "1.5", "1.5"), (2, "Clinic B", "", "North", "2.5", "2.5"), (3, "Clinic C", "Clinic", "South", "7.5", "0.5"), (4, "No place", "Clinic", "North", "0", "0"), (5, "In the hole", "Clinic", "North", "1.2", "1.2")]
    table = spark.createDataFrame(poi, "n int, g3_hltfac string, g3_hltfac_type string, district string, long string, lat string").drop("n")
    save_table(table, f"{folder}/poi_preprocessing1.csv")
    districts = [("North", layers.wkb_polygon([box(0.5, 0.5, 4.0), box(1.1, 1.1, 0.2)[::-1]])), ("South", layers.wkb_polygon([box(6.0, 0.0, 4.0)]))]
    save_table(spark.createDataFrame([(n, bytearray(g)) for n, g in districts], "name string, geometry binary"), f"{folder}/districts.shp")
    towns = [("urban", layers.wkb_polygon([box(1.4, 1.4, 0.2)])), ("rural", layers.wkb_polygon([box(7.0, 0.0, 1.0)]))]
    save_table(spark.createDataFrame([(t, bytearray(g)) for t, g in towns], "type string, geometry binary"), f"{folder}/towns.gpkg")
    general = {"poi_input_filename": "poi.csv", "poi_output_dir": folder, "poi_data_type": "health_facility", "poi_lat_field": "lat", "poi_long_field": "long"}
    second = {"poi_field": "g3_hltfac", "poi_admin1": "district", "admin1_bdry_var": "name", "admin_bdry_file": f"{folder}/districts.shp", "path_sett_extent": f"{folder}/towns.gpkg", "poi_output_extension_type": ".xlsx"}
    path = run_assess(spark, {"about_POI_table": general, "preprocessing1": {"poi_output_extension_type": ".csv"}, "preprocessing2": second})
    got = {r["g3_hltfac"]: r for r in load_table(spark, path).collect()}
    assert {n: r["settlement_type"] for n, r in got.items()} == {"Clinic A": "urban", "Clinic B": "Out of a settlement", "Clinic C": "rural", "No place": "NA", "In the hole": "Out of a settlement"}
    assert [got[n]["admin1_bryMatch"] for n in ("Clinic A", "Clinic B", "Clinic C", "No place")] == ["YES", "YES", "YES", "NA"]
    assert got["In the hole"]["admin1_bryMatch"] == "NO"  # 250 m from no district
    assert float(got["In the hole"]["dist_to_admin1_bry_border_km"]) == pytest.approx(0.1 * 2**0.5 * 111.195, rel=0.01)
