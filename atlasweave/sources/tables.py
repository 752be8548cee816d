"""Readers and writers by file type, checks before reading, configuration.

Tables are CSV, JSON, ORC or parquet through Spark's readers, workbooks (.xlsx), shapefiles and
geopackages through readers of this package, so any file system that Spark knows will do. Old
workbooks (.xls) and layers of .gdb folders need libraries and are read where those exist.
"""

from __future__ import annotations

import configparser
import struct
from collections.abc import Mapping, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.functions.geo import coordinate
from atlasweave.sources.layers import read_geopackage, read_shapefile, write_geopackage, write_shapefile
from atlasweave.sources.workbooks import read_workbook, write_workbook

FILE_TYPES = {".csv": "csv", ".xlsx": "excel", ".xls": "excel", ".shp": "shape", ".gpkg": "gpkg", ".parquet": "parquet", ".json": "json", ".orc": "orc"}
NULL_TOKEN = "<NULL>"


def file_type(path: str) -> str:
    """Kind of file by suffix; ``feature`` for a layer of a .gdb folder; ``unknown`` else."""
    folder, _, name = path.replace("\\", "/").rpartition("/")
    if ".gdb" in folder:
        return "feature"
    return FILE_TYPES.get("." + name.rpartition(".")[2].lower() if "." in name else "", "unknown")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems have ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def check_files(spark: SparkSession, inputs: Sequence[str], output_folders: Sequence[str] = ()) -> None:
    """Raises if an input or a folder for output is missing."""
    missing = [p for p in (*inputs, *output_folders) if p and not exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"missing: {', '.join(missing)}")


def check_columns(df: DataFrame, source: str, columns: Sequence[str | None]) -> None:
    """Raises if a column that is named (not blank) is missing."""
    missing = [c for c in columns if c and c not in df.columns]
    if missing:
        raise ValueError(f"{source} lacks {', '.join(missing)}")


def _read_csv(spark: SparkSession, path: str, schema: str | None, encoding: str) -> DataFrame:
    reader = spark.read.option("header", True).option("encoding", encoding).option("multiLine", False)
    return (reader.schema(schema) if schema else reader).csv(path)


def _sheets(spark: SparkSession, path: str) -> DataFrame:
    """All sheets of a workbook, one after another; an old one (.xls) needs a reader on the driver."""
    if path.lower().endswith(".xlsx"):
        return read_workbook(spark, path)
    import pandas as pd

    sheets = pd.read_excel(path, sheet_name=None, dtype=str)
    return spark.createDataFrame(pd.concat(sheets.values(), ignore_index=True))


def _layer(spark: SparkSession, path: str, layer: str | None) -> DataFrame:
    """A layer of a .gdb folder with its geometry as well-known binary; needs a reader on the driver."""
    import geopandas

    frame = geopandas.read_file(path, layer=layer) if layer else geopandas.read_file(path)
    return spark.createDataFrame(frame.assign(geometry=frame.geometry.to_wkb()))


def polygon_parts(blob: bytes | None) -> list[list[list[tuple[float, float]]]] | None:
    """The parts of a polygon or multipolygon in well-known binary, each its exterior ring and holes of
    (x, y), with z, m and srid left out; None for other geometries."""
    if blob is None:
        return None
    at = 0

    def take(form: str) -> tuple:
        nonlocal at
        found = struct.unpack_from(form, blob, at)
        at += struct.calcsize(form)
        return found

    def geometry() -> list | None:
        end = "<" if take("B")[0] else ">"
        code = take(f"{end}I")[0]
        more = (code >> 31 & 1) + (code >> 30 & 1)  # extended: z and m as flags
        if code >> 29 & 1:
            take(f"{end}I")
        code &= 0x1FFFFFFF
        more, code = more + (0, 1, 1, 2)[code // 1000 % 4], code % 1000
        if code == 3:
            return [[[take(f"{end}{2 + more}d")[:2] for _ in range(take(f"{end}I")[0])] for _ in range(take(f"{end}I")[0])]]
        if code == 6:
            return [part for _ in range(take(f"{end}I")[0]) for part in geometry()]
        return None

    return geometry()


def load_polygons(spark: SparkSession, path: str) -> DataFrame:
    """A table of any known type with ``ring``: if it has none, the parts of the polygons of its
    geometry (well-known binary, degrees), null where that is no polygon."""
    df = load_table(spark, path)
    if "ring" in df.columns or dict(df.dtypes).get("geometry") != "binary":
        return df

    @F.arrow_udf("array<array<array<struct<x:double,y:double>>>>")
    def parts(geometries: pa.Array) -> pa.Array:
        made = [polygon_parts(g) for g in geometries.to_pylist()]
        kind = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))
        return pa.array([p and [[[{"x": x, "y": y} for x, y in ring] for ring in rings] for rings in p] for p in made], kind)

    return df.withColumn("ring", parts("geometry"))


def load_table(spark: SparkSession, path: str, lat: str = "", long: str = "", null: str | None = NULL_TOKEN, strip_headers: bool = True, schema: str | None = None) -> DataFrame:
    """A table of any known type. CSV columns are text unless a schema is given; a CSV that isn't
    UTF-8 is read as ISO-8859-1. The null token becomes null, coordinates doubles (a value that
    is no number is an error), headers lose white space at the ends."""
    kind = file_type(path)
    if kind == "csv":
        df = _read_csv(spark, path, schema, "UTF-8")
        texts = [c for c, t in df.dtypes if t == "string"]
        broken = [F.contains(F.col(f"`{c}`"), F.lit("�")) for c in texts]
        if broken and not df.filter(F.coalesce(F.greatest(*broken) if len(broken) > 1 else broken[0], F.lit(False))).isEmpty():
            df = _read_csv(spark, path, schema, "ISO-8859-1")
    elif kind in ("parquet", "json", "orc"):
        df = spark.read.format(kind).load(path)
    elif kind == "excel":
        df = _sheets(spark, path)
    elif kind == "shape":
        df = read_shapefile(spark, path)
    elif kind == "gpkg":
        df = read_geopackage(spark, path)
    elif kind == "feature":
        folder, _, layer = path.rpartition("/")
        df = _layer(spark, folder, layer)
    else:
        raise ValueError(f"unknown kind of file: {path}")
    if null is not None:
        df = df.select(*[F.nullif(F.col(f"`{c}`"), F.lit(null)).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])
    if strip_headers:
        df = df.toDF(*[c.strip() for c in df.columns])
    for c in (lat, long):
        if c and c in df.columns:
            df = with_coordinate(df, c)
    return df


def with_coordinate(df: DataFrame, column: str) -> DataFrame:
    """``column`` as double; text that is neither a number, blank nor null-like raises."""
    value = coordinate(F.col(column))
    text = F.col(column).cast("string")
    known = value.isNotNull() | text.isNull() | text.rlike("(?i)null") | (F.trim(text) == "")
    return df.withColumn(column, F.when(known, value).otherwise(F.raise_error(F.concat(F.lit(f"{column}: no coordinate: "), text)).cast("double")))


def _stem(path: str) -> str:
    return path.replace("\\", "/").rpartition("/")[2].rpartition(".")[0]


def save_table(df: DataFrame, path: str) -> str:
    """Writes by the path's type and returns where: text formats lose geometry, vector formats
    without geometry fall back to a workbook; '' if the type is unknown. Old workbooks (.xls) are
    written as new ones; layers of .gdb folders need a writer on the driver."""
    kind = file_type(path)
    flat = df.drop("geometry", "SHAPE")
    if kind == "csv":
        flat.write.mode("overwrite").option("header", True).csv(path)
        return path
    if kind in ("parquet", "json", "orc"):
        df.write.mode("overwrite").format(kind).save(path)
        return path
    if kind == "excel":
        path = path if path.lower().endswith(".xlsx") else path.rpartition(".")[0] + ".xlsx"
        write_workbook(flat, path, _stem(path))
        return path
    if kind in ("shape", "gpkg", "feature"):
        if "geometry" not in df.columns:
            return save_table(df, path.rpartition(".")[0] + ".xlsx")
        ready = vector_ready(df, kind)
        if kind == "shape":
            write_shapefile(ready, path)
        elif kind == "gpkg":
            write_geopackage(ready, path, _stem(path))
        else:
            import geopandas

            folder, _, layer = path.rpartition("/")
            frame = ready.toPandas()
            frame["geometry"] = geopandas.GeoSeries.from_wkb(frame["geometry"])
            geopandas.GeoDataFrame(frame, crs="EPSG:4326").to_file(folder, layer=layer, driver="OpenFileGDB")
        return path
    return ""


def vector_ready(df: DataFrame, kind: str) -> DataFrame:
    """Columns as vector formats take them: times as text; in geopackages null text as ''."""
    out = df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c, t in df.dtypes if t.startswith("timestamp")})
    return out.na.fill("", subset=[c for c, t in out.dtypes if t == "string"]) if kind == "gpkg" else out


def config_section(source: str | Mapping[str, Any], section: str, required: Sequence[str] = ()) -> dict[str, Any]:
    """A section of an INI file, or a mapping as it is; missing keys raise."""
    if isinstance(source, Mapping):
        found = dict(source.get(section, source))
    else:
        parser = configparser.ConfigParser(inline_comment_prefixes=None)
        if not parser.read(source):
            raise FileNotFoundError(source)
        if section not in parser:
            raise KeyError(f"{source} lacks section {section}")
        found = {k: v.strip() for k, v in parser[section].items()}
    missing = [k for k in required if k not in found]
    if missing:
        raise KeyError(f"section {section} lacks {', '.join(missing)}")
    return found


def is_true(value: Any) -> bool:
    return str(value).strip().lower() == "true"
