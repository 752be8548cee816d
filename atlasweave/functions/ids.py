"""Composite keys, identifiers that depend on content alone, and required metadata."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh_names(columns: Iterable[str], n: int) -> list[str]:
    """``n`` names that no column has, in any case, and that need no quotes."""
    start, taken = "__", [c.lower() for c in columns]
    while any(c.startswith(start) for c in taken):
        start += "_"
    return [f"{start}x{i}" for i in range(n)]


def unique_key(columns: Sequence[str], sep: str = "_") -> Column:
    """One column as it is; several as text with ``sep`` between, null as ``nan``."""
    if not columns:
        raise ValueError("a key needs at least one column")
    if len(columns) == 1:
        return F.col(columns[0])
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])


def code_of(key: Column, length: int = 10) -> Column:
    """The code of a key: the first digits of its MD5, so equal keys have equal codes everywhere."""
    return F.upper(F.substr(F.md5(key.cast("string").cast("binary")), F.lit(1), F.lit(length)))


def with_code(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """``df`` with a code for each distinct key; a null one-column key has none."""
    return df.withColumn(out, code_of(unique_key(columns)))


def with_required_fields(df: DataFrame, source: str, iso: str, row_id: str, date: str | None = None) -> DataFrame:
    """g3_iso, g3_date (yyyyMMdd, today by default), g3_source and g3_id, the source and the row's code."""
    day = F.lit(date) if date else F.date_format(F.current_date(), "yyyyMMdd")
    code = code_of(F.concat_ws("|", F.lit(source), F.lit(iso), F.col(row_id).cast("string")))
    return df.withColumns({"g3_iso": F.lit(iso), "g3_date": day, "g3_source": F.lit(source), "g3_id": F.concat_ws("_", F.lit(source), code)})
