"""Vector layers: shapefiles and geopackages, read by an executor and written without any library.

Geometries are well-known binary in two dimensions. Coordinates are taken as they are: layers are
expected in degrees.
"""

from __future__ import annotations

import json
import sqlite3
import struct
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.sources.files import parsed, write_bytes

Point = tuple[float, float]
Ring = list[Point]
WGS84 = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
MOST_BYTES = 2 << 30


def _points(points: Iterable[Point]) -> bytes:
    points = list(points)
    return struct.pack("<I", len(points)) + b"".join(struct.pack("<2d", *p) for p in points)


def wkb_point(p: Point) -> bytes:
    return struct.pack("<BI2d", 1, 1, *p)


def wkb_line(line: Ring) -> bytes:
    return struct.pack("<BI", 1, 2) + _points(line)


def wkb_polygon(rings: list[Ring]) -> bytes:
    return struct.pack("<BII", 1, 3, len(rings)) + b"".join(map(_points, rings))


def wkb_many(code: int, parts: list[bytes]) -> bytes:
    """Points (4), lines (5) or polygons (6) as one geometry; a single part is itself."""
    return parts[0] if len(parts) == 1 else struct.pack("<BII", 1, code, len(parts)) + b"".join(parts)


def _area(ring: Ring) -> float:
    """Twice the signed area: negative if the ring is clockwise."""
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))


def _inside(p: Point, ring: Ring) -> bool:
    found = False
    for a, b in zip(ring, [*ring[1:], ring[0]], strict=True):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            found = not found
    return found


def polygons_of(rings: list[Ring]) -> list[list[Ring]]:
    """Rings of a shapefile as polygons: clockwise ones are outer, each other one is a hole of the
    smallest outer one around it."""
    outer = [[r] for r in rings if _area(r) <= 0] or [[r] for r in rings[:1]]
    taken = {id(x[0]) for x in outer}
    for hole in rings:
        if id(hole) not in taken:
            around = [x for x in outer if _inside(hole[0], x[0])]
            min(around or outer, key=lambda x: abs(_area(x[0]))).append(hole)
    return outer


def shapes(content: bytes) -> Iterator[bytes | None]:
    """Geometries of a .shp file; null shapes are None. Z and M are left out."""
    at = 100
    while at + 8 <= len(content):
        size = struct.unpack_from(">i", content, at + 4)[0] * 2
        at += 8
        code = struct.unpack_from("<i", content, at)[0]
        base, body = code % 10, at + 4
        at += size
        if code == 0:
            yield None
        elif base == 1:
            yield wkb_point(struct.unpack_from("<2d", content, body))
        elif base == 8:
            n = struct.unpack_from("<i", content, body + 32)[0]
            yield wkb_many(4, [wkb_point(struct.unpack_from("<2d", content, body + 36 + 16 * i)) for i in range(n)])
        elif base in (3, 5):
            n_parts, n = struct.unpack_from("<2i", content, body + 32)
            starts = [*struct.unpack_from(f"<{n_parts}i", content, body + 40), n]
            flat = struct.unpack_from(f"<{2 * n}d", content, body + 40 + 4 * n_parts)
            parts = [[(flat[2 * i], flat[2 * i + 1]) for i in range(a, b)] for a, b in zip(starts, starts[1:], strict=False)]
            yield wkb_many(5, [wkb_line(p) for p in parts]) if base == 3 else wkb_many(6, [wkb_polygon(p) for p in polygons_of(parts)])
        else:
            raise ValueError(f"unknown shape type {code}")


def dbf_fields(content: bytes) -> list[tuple[str, str, int, int]]:
    """(name, kind, width, decimals) of the columns of a .dbf file."""
    out, at = [], 32
    while content[at] != 0x0D:
        name = content[at : at + 11].split(b"\0")[0].decode("latin-1").strip()
        out.append((name, chr(content[at + 11]), content[at + 16], content[at + 17]))
        at += 32
    return out


def dbf_rows(content: bytes, encoding: str) -> Iterator[list[str | None] | None]:
    """Values as text, dates in ISO form; None for rows that are marked as deleted."""
    n, start, size = struct.unpack_from("<IHH", content, 4)
    fields = dbf_fields(content)
    for i in range(n):
        row = content[start + i * size : start + (i + 1) * size]
        at, out = 1, []
        for _, kind, width, _ in fields:
            text = row[at : at + width].decode(encoding, "replace").strip(" \0")
            at += width
            if kind == "D":
                text = f"{text[:4]}-{text[4:6]}-{text[6:8]}" if len(text) == 8 and text.isdigit() else ""
            elif kind == "L":
                text = {"T": "true", "Y": "true", "F": "false", "N": "false"}.get(text.upper(), "")
            elif kind in "NF" and set(text) <= {"*"}:
                text = ""
            out.append(text or None)
        yield None if row[:1] == b"*" else out


def _dbf_type(kind: str, decimals: int) -> str:
    return {"N": "double" if decimals else "long", "F": "double", "L": "boolean", "D": "date"}.get(kind, "string")


def _table(spark: SparkSession, paths: list[str], columns, rows) -> DataFrame:
    """A table from two parsers: of (name, type) pairs, and of rows of text values with a geometry."""
    known = json.loads(parsed(spark, paths, lambda files: [[json.dumps(columns(files))]], "names string").first()["names"])
    table = parsed(spark, paths, rows, "cells array<string>, geometry binary")
    return table.select(*[F.col("cells")[i].try_cast(kind).alias(name) for i, (name, kind) in enumerate(known)], "geometry")


def read_shapefile(spark: SparkSession, path: str) -> DataFrame:
    """A shapefile (.shp with its .dbf, and .cpg if there is one) as its columns and ``geometry``."""
    from atlasweave.sources.tables import exists

    stem = path[: -len(".shp")]
    paths = [path, *(f"{stem}.{s}" for s in ("dbf", "cpg") if exists(spark, f"{stem}.{s}"))]

    def columns(files: dict[str, bytes]) -> list:
        return [(name, _dbf_type(kind, decimals)) for name, kind, _, decimals in dbf_fields(files["dbf"])] if "dbf" in files else []

    def rows(files: dict[str, bytes]) -> Iterator[list]:
        encoding = files.get("cpg", b"utf-8" if "cpg" in files else b"latin-1").decode().strip().lower() or "utf-8"
        values = dbf_rows(files["dbf"], encoding) if "dbf" in files else None
        for shape in shapes(files["shp"]):
            own = next(values, None) if values is not None else []
            if own is not None:
                yield [own, shape]

    return _table(spark, paths, columns, rows)


def _geopackage(content: bytes) -> sqlite3.Connection:
    base = sqlite3.connect(":memory:")
    base.deserialize(content)
    base.text_factory = lambda b: b.decode("utf-8", "replace")
    return base


def _layer_of(base: sqlite3.Connection, layer: str | None) -> tuple[str, str]:
    """(table, its geometry column): the named layer, or the first."""
    found = base.execute("SELECT table_name, column_name FROM gpkg_geometry_columns ORDER BY rowid").fetchall()
    own = [x for x in found if layer in (None, x[0])]
    if not own:
        raise ValueError(f"no layer {layer or ''} in the geopackage")
    return own[0]


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _gpkg_type(declared: str) -> str:
    kind = declared.upper().split("(")[0]
    if kind in ("BOOLEAN",):
        return "boolean"
    if kind in ("TINYINT", "SMALLINT", "MEDIUMINT", "INT", "INTEGER"):
        return "long"
    return {"FLOAT": "double", "DOUBLE": "double", "REAL": "double", "DATE": "date", "DATETIME": "timestamp"}.get(kind, "string")


def without_header(blob: bytes | None) -> bytes | None:
    """Well-known binary of a geometry as geopackages hold it; None if it is empty."""
    if blob is None or blob[:2] != b"GP" or blob[3] >> 4 & 1:
        return None
    return blob[8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] :]


def read_geopackage(spark: SparkSession, path: str, layer: str | None = None) -> DataFrame:
    """A layer of a geopackage, the first by default, as its columns and ``geometry``."""

    def described(base: sqlite3.Connection) -> tuple[str, str, list]:
        table, geometry = _layer_of(base, layer)
        own = base.execute(f"PRAGMA table_info({_quoted(table)})").fetchall()
        return table, geometry, [(x[1], _gpkg_type(x[2])) for x in own if x[1] != geometry and not x[2].upper().startswith("BLOB")]

    def columns(files: dict[str, bytes]) -> list:
        return described(_geopackage(files["gpkg"]))[2]

    def rows(files: dict[str, bytes]) -> Iterator[list]:
        base = _geopackage(files["gpkg"])
        table, geometry, names = described(base)
        wanted = ", ".join(_quoted(x) for x in [geometry, *(n for n, _ in names)])
        for blob, *values in base.execute(f"SELECT {wanted} FROM {_quoted(table)}"):
            yield [[None if v is None else str(v) for v in values], without_header(blob)]

    return _table(spark, [path], columns, rows)


def _bounds(points: Iterable[Point]) -> tuple[float, float, float, float]:
    xs, ys = zip(*points, strict=True)
    return min(xs), min(ys), max(xs), max(ys)


def _sql_type(kind: str) -> str:
    return {"tinyint": "INTEGER", "smallint": "INTEGER", "int": "INTEGER", "bigint": "INTEGER", "float": "REAL", "double": "REAL", "boolean": "BOOLEAN", "date": "DATE"}.get(kind, "TEXT")


def write_geopackage(df: DataFrame, path: str, layer: str) -> None:
    """``df`` as the one layer of a geopackage, ``geometry`` (well-known binary) being its geometry. The
    format is one file, made on the driver from streamed rows; over 2 GB is an error."""
    base = sqlite3.connect(":memory:")
    base.executescript(
        """PRAGMA application_id = 1196444487; PRAGMA user_version = 10300;
        CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT NOT NULL, srs_id INTEGER PRIMARY KEY, organization TEXT NOT NULL, organization_coordsys_id INTEGER NOT NULL, definition TEXT NOT NULL, description TEXT);
        CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT NOT NULL, identifier TEXT UNIQUE, description TEXT DEFAULT '', last_change DATETIME DEFAULT CURRENT_TIMESTAMP, min_x DOUBLE, min_y DOUBLE, max_x DOUBLE, max_y DOUBLE, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT PRIMARY KEY, column_name TEXT NOT NULL, geometry_type_name TEXT NOT NULL, srs_id INTEGER NOT NULL, z TINYINT NOT NULL, m TINYINT NOT NULL);"""
    )
    for name, number, organization, definition in (("WGS 84", 4326, "EPSG", WGS84), ("Undefined Cartesian", -1, "NONE", "undefined"), ("Undefined geographic", 0, "NONE", "undefined")):
        base.execute("INSERT INTO gpkg_spatial_ref_sys VALUES (?, ?, ?, ?, ?, NULL)", (name, number, organization, number, definition))
    kinds = [(c, t) for c, t in df.dtypes if c != "geometry"]
    fid = "fid"
    while fid in (c.lower() for c, _ in kinds):
        fid += "_"
    declared = "".join(f", {_quoted(c)} {_sql_type(t)}" for c, t in kinds)
    base.execute(f"CREATE TABLE {_quoted(layer)} ({fid} INTEGER PRIMARY KEY AUTOINCREMENT, geom BLOB{declared})")
    base.execute("INSERT INTO gpkg_contents (table_name, data_type, identifier, srs_id) VALUES (?, 'features', ?, 4326)", (layer, layer))
    base.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'GEOMETRY', 4326, 0, 0)", (layer,))
    own = df.select("geometry", *[F.col(f"`{c}`") if _sql_type(t) not in ("TEXT", "DATE") else F.col(f"`{c}`").cast("string") for c, t in kinds])
    insert = f"INSERT INTO {_quoted(layer)} (geom{''.join(', ' + _quoted(c) for c, _ in kinds)}) VALUES (?{', ?' * len(kinds)})"
    head = b"GP" + struct.pack("<BBi", 0, 1, 4326)
    size = 0
    for row in own.toLocalIterator():
        blob = None if row[0] is None else head + bytes(row[0])
        size += len(blob or b"") + sum(len(str(v)) for v in row[1:])
        if size > MOST_BYTES:
            raise ValueError("a geopackage of over 2 GB isn't written")
        base.execute(insert, (blob, *row[1:]))
    base.commit()
    write_bytes(df.sparkSession, path, base.serialize())


def geometry_rings(blob: bytes) -> tuple[int, list[Ring]]:
    """(kind of shape, its parts) of well-known binary: points as parts of one point, rings of polygons
    as shapefiles turn them, outer ones clockwise. Kinds are those of shapefiles."""
    at = 0

    def take(form: str) -> tuple:
        nonlocal at
        found = struct.unpack_from(form, blob, at)
        at += struct.calcsize(form)
        return found

    def geometry() -> tuple[int, list[Ring]]:
        end = "<" if take("B")[0] else ">"
        code = take(f"{end}I")[0]
        more = (code >> 31 & 1) + (code >> 30 & 1)
        if code >> 29 & 1:
            take(f"{end}I")
        code &= 0x1FFFFFFF
        more, code = more + (0, 1, 1, 2)[code // 1000 % 4], code % 1000
        point = lambda: take(f"{end}{2 + more}d")[:2]
        count = lambda: take(f"{end}I")[0]
        if code == 1:
            return 1, [[point()]]
        if code == 2:
            return 3, [[point() for _ in range(count())]]
        if code == 3:
            rings = [[point() for _ in range(count())] for _ in range(count())]
            return 5, [r if (_area(r) <= 0) == (i == 0) else r[::-1] for i, r in enumerate(rings) if r]
        if code in (4, 5, 6):
            parts = [geometry()[1] for _ in range(count())]
            return {4: 8, 5: 3, 6: 5}[code], [r for p in parts for r in p]
        raise ValueError(f"geometry type {code} isn't written to shapefiles")

    return geometry()


def _shape(kind: int, parts: list[Ring]) -> bytes:
    if kind == 1:
        return struct.pack("<i2d", 1, *parts[0][0])
    flat = [p for part in parts for p in part]
    box = struct.pack("<4d", *_bounds(flat))
    points = b"".join(struct.pack("<2d", *p) for p in flat)
    if kind == 8:
        return struct.pack("<i", 8) + box + struct.pack("<i", len(flat)) + points
    starts, n = [], 0
    for part in parts:
        starts.append(n)
        n += len(part)
    return struct.pack("<i", kind) + box + struct.pack(f"<2i{len(starts)}i", len(parts), n, *starts) + points


def _dbf_names(columns: list[str]) -> list[str]:
    """Names of ten bytes at most, different from each other."""
    out: list[str] = []
    for c in columns:
        name, n = c.encode("ascii", "replace")[:10].decode(), 0
        while name.lower() in (x.lower() for x in out):
            n += 1
            name = f"{c.encode('ascii', 'replace').decode()[: 9 - len(str(n))]}_{n}"
        out.append(name)
    return out


def write_shapefile(df: DataFrame, path: str) -> None:
    """``df`` as a shapefile: .shp, .shx, .dbf, .cpg and .prj. Names are cut to ten characters and texts to
    254 bytes, as the format asks; all geometries have to be of one kind. Made on the driver from
    streamed rows; over 2 GB is an error."""
    kinds = [(c, t) for c, t in df.dtypes if c != "geometry"]
    whole, real = ("tinyint", "smallint", "int", "bigint"), ("float", "double")
    own = df.select("geometry", *[F.col(f"`{c}`") if t in (*whole, *real, "boolean") else F.col(f"`{c}`").cast("string") for c, t in kinds])
    widths = [19 if t in whole else 24 if t in real else 1 if t == "boolean" else 254 for _, t in kinds]
    shp, shx, dbf, boxes, found, n = bytearray(), bytearray(), bytearray(), [], 0, 0

    def cell(value, kind: str, width: int) -> bytes:
        if value is None:
            return b" " * width
        if kind == "boolean":
            return b"T" if value else b"F"
        if kind in (*whole, *real):
            return (repr(float(value)) if kind in real else str(value)).rjust(width).encode()[:width]
        return str(value).encode()[:width].decode("utf-8", "ignore").encode().ljust(width)

    for blob, *values in own.toLocalIterator():
        record = struct.pack("<i", 0)
        if blob is not None:
            kind, parts = geometry_rings(bytes(blob))
            if parts:
                if found and kind != found:
                    raise ValueError("a shapefile holds one kind of geometry")
                found, record = kind, _shape(kind, parts)
                boxes.append(_bounds(p for part in parts for p in part))
        n += 1
        shx += struct.pack(">2i", (100 + len(shp)) // 2, len(record) // 2)
        shp += struct.pack(">2i", n, len(record) // 2) + record
        dbf += b" " + b"".join(cell(v, t, w) for v, (_, t), w in zip(values, kinds, widths, strict=True))
        if len(shp) > MOST_BYTES or len(dbf) > MOST_BYTES:
            raise ValueError("a shapefile of over 2 GB isn't written")
    box = (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)) if boxes else (0.0,) * 4

    def head(size: int) -> bytes:
        return struct.pack(">7i", 9994, 0, 0, 0, 0, 0, (100 + size) // 2) + struct.pack("<2i8d", 1000, found, *box, 0, 0, 0, 0)

    fields = b"".join(
        struct.pack("<11sc4xBB14x", name.encode(), b"N" if t in whole else b"F" if t in real else b"L" if t == "boolean" else b"C", w, 17 if t in real else 0)
        for name, (_, t), w in zip(_dbf_names([c for c, _ in kinds]), kinds, widths, strict=True)
    )
    start = struct.pack("<4BIHH20x", 3, 95, 7, 26, n, 33 + len(fields), 1 + sum(widths)) + fields + b"\r"
    stem, spark = path[: -len(".shp")], df.sparkSession
    for suffix, content in (("shp", head(len(shp)) + shp), ("shx", head(len(shx)) + shx), ("dbf", start + dbf + b"\x1a"), ("cpg", b"UTF-8"), ("prj", WGS84.encode())):
        write_bytes(spark, f"{stem}.{suffix}", bytes(content))
