"""The match pipeline: link an input table to a match table and resolve duplicates."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.operators import linkage, settle, tables
from atlasweave.session import spread, stored, stored_lists
from atlasweave.sources.tables import check_columns


@dataclass(frozen=True)
class MatchConfig:
    name: str
    row_id: str
    match_name: str
    match_order: str
    admin1: str = ""
    admin2: str = ""
    type: str = ""
    match_admin1: str = ""
    match_admin2: str = ""
    match_type: str = ""
    by_distance: bool = False
    metres: float = 500.0
    point: tuple[str, str] = ("long", "lat")
    match_point: tuple[str, str] = ("long", "lat")
    least_score: float = 90.0


def match(df: DataFrame, other: DataFrame, config: MatchConfig) -> tuple[DataFrame, DataFrame]:
    """(the input, a row for each surviving candidate, with match columns; the match table with
    ismatch). Every input row comes out at least once.

    Order: by distance if asked for; admin1, then admin2 within admin1, both on the whole match table;
    names within admin2; losers of duplicates once more within admin2, without the records that are
    taken; what is left within admin1; then duplicates over everything. Tables that several later
    steps read are stored, so that names are scored once.
    """
    c = config
    check_columns(df, "input", [c.row_id, c.name])
    check_columns(other, "match table", [c.match_order, c.match_name])
    df, other = spread(df), spread(other)
    a1, a2, kind = c.admin1, c.admin2, c.type
    m1, m2, mkind = c.match_admin1, c.match_admin2, c.match_type
    if a1 not in df.columns:
        (df, a1), (other, m1) = tables.with_fallback(df, None, "dummy_admin1"), tables.with_fallback(other, None, "dummy_admin1")
    if a2 not in df.columns:
        (df, a2), (other, m2) = tables.with_fallback(df, None, "dummy_admin2"), tables.with_fallback(other, None, "dummy_admin2")
    if kind not in df.columns:
        (df, kind), (other, mkind) = tables.with_fallback(df, None, "dummy_type"), tables.with_fallback(other, None, "dummy_type")
    name, mname = c.name, c.match_name
    if name == mname:
        other, mname = other.withColumnRenamed(mname, f"mt_{mname}"), f"mt_{mname}"
    result, score, uuid, method = f"{name}_match_result", f"{name}_match_score", f"{name}_match_uuid", f"{name}_match_type"
    muuid, part = f"{mname}_uuid", "match_uuid_expand"

    table = other
    for column, levels, of in ((m1, [], None), (m2, [f"{m1}_cleaned"], None), (mname, [f"{m1}_cleaned", f"{m2}_cleaned"], mkind)):
        table = linkage.with_match_code(linkage.with_clean_values(table, column, f"{column}_cleaned"), column, levels, of, cleaned=True)
    table = stored(table)
    left, done, rest = table, [], df
    if c.by_distance:
        near = stored_lists(linkage.distance_match(df, c.row_id, name, c.point, table, mname, c.match_point, c.match_order, [], c.metres), uuid)
        done.append(near.filter(F.col(result) == "YES"))
        left = linkage.excluded(table, muuid, near, uuid, (F.col(score) >= c.least_score) & (F.col(result) == "YES"))
        rest = near.filter(F.col(result) == "NO")

    rest = stored(linkage.block_match(rest, a1, table, m1, c.match_order))
    rest = stored(linkage.block_match(rest, a2, table, m2, c.match_order, "admin1", [f"{a1}_updated"], [f"{m1}_cleaned"]))
    admin2 = ([f"{a1}_updated", f"{a2}_updated"], [f"{m1}_cleaned", f"{m2}_cleaned"])
    inside = rest.filter(F.col(f"{a2}_match_result") == "YES")
    attributes = [a1, a2, kind]
    records = settle.code_records(table, muuid, [m1, m2, mkind], c.match_point if c.by_distance else None, c.match_order)
    columns = settle.Columns(c.row_id, uuid, part, result, score, method, attributes)

    pass1 = stored(linkage.block_match(inside, name, left, mname, c.match_order, "admin2", *admin2, mkind))
    yes1 = pass1.filter(F.col(result) == "YES")
    if c.by_distance:
        yes1 = linkage.resolve_composite_by_distance(yes1, uuid, result, c.point, table, muuid, c.match_point, c.match_order, c.row_id, c.metres)
    yes1 = settle.numbered(yes1, uuid)
    single = stored(settle.settled(yes1, columns, records))
    yes1 = yes1.drop("__row")
    kept_ids = single.filter("__r = 'YES'").select(F.col("__i").alias(c.row_id)).distinct()
    lost_ids = tables.drop_where(single.filter("__r = 'NO'").select(F.col("__i").alias(c.row_id)).distinct(), kept_ids, c.row_id)
    left = linkage.excluded(left, muuid, single, "__p", (F.col("__r") == "YES") & (F.col("__s") >= c.least_score))

    again = tables.keep_where(inside, lost_ids, c.row_id)
    pass2 = stored(linkage.block_match(again, name, left, mname, c.match_order, "admin2", *admin2, mkind))
    yes2 = pass2.filter(F.col(result) == "YES")
    left = linkage.excluded(left, muuid, yes2, uuid, F.col(score) >= c.least_score)
    done += [tables.keep_where(yes1, kept_ids, c.row_id), yes2]

    wider = tables.union_all([rest.filter(F.col(f"{a2}_match_result") == "NO"), pass1.filter(F.col(result) == "NO"), pass2.filter(F.col(result) == "NO")])
    last = linkage.block_match(wider, name, left, mname, c.match_order, "admin1", [f"{a1}_updated"], [f"{m1}_cleaned"], mkind)
    merged = tables.union_all([*done, last]).withColumn("orig_result", F.col(result))
    if c.by_distance:
        columns = replace(columns, point=c.point, metres=c.metres)
    out = stored(settle.settled_rows(merged, columns, records))
    out = out.withColumns({part: F.coalesce(part, F.lit(" ")), uuid: F.coalesce(uuid, F.lit(" "))})
    out = tables.with_group_size(tables.with_group_size(out, [part], "one_to_many_dup"), [c.row_id], "many_to_one_dup")
    out = stored(out)
    return tables.drop_prefixed(out, "dummy"), tables.drop_prefixed(linkage.with_is_match(table, muuid, out, part, result), "dummy")
