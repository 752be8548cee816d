"""Single files through Spark's file systems: formats that are one file, whoever reads them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bytes(spark: SparkSession, path: str, content: bytes, step: int = 4 << 20) -> None:
    """``content`` as the file ``path`` of any file system that Spark knows; one that is there is replaced."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        for at in range(0, len(content), step):
            out.write(bytearray(content[at : at + step]))
    finally:
        out.close()


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern with * names, in order."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return sorted(str(x.getPath().toString()) for x in found or ())


def parsed(spark: SparkSession, paths: list[str], parse: Callable[[dict[str, bytes]], Iterable[list]], schema: str) -> DataFrame:
    """Rows that an executor makes of the contents of some files of one table, by suffix."""
    fields = [x.split()[0] for x in schema.split(", ")]
    files = spark.read.format("binaryFile").load(paths).select(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).alias("suffix"), "content")
    one = files.groupBy().agg(F.collect_list(F.struct("suffix", "content")).alias("files"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column(0).to_pylist():
                held: list[list] = []
                for found in parse({f["suffix"]: f["content"] for f in row}):
                    held.append(found)
                    if len(held) == 10_000:
                        yield made(held)
                        held = []
                yield made(held)

    def made(rows: list[list]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], fields)

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(spark.createDataFrame([], schema).schema).types
    return one.mapInArrow(run, schema)
