"""The assess pipeline: codes, duplicates, settlements, overlaps, boundaries, clusters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlasweave.functions.ids import with_code
from atlasweave.functions.text import fix_language, preclean
from atlasweave.operators import linkage, spatial
from atlasweave.operators.tables import drop_prefixed, with_duplicate_flag
from atlasweave.session import spread, stored
from atlasweave.sources.tables import check_columns


@dataclass(frozen=True)
class AssessConfig:
    row_id: str
    name: str
    type: str
    poi_kind: str
    admin1: str = ""
    admin2: str = ""
    lat: str = "lat"
    long: str = "long"
    boundary_admin1: str = ""
    boundary_admin2: str = ""
    boundary_order: str = "bid"
    ring: str = "ring"
    settlement_type: str = "type"
    settlement_order: str = "sid"
    language: str = ""


def assess(df: DataFrame, boundary: DataFrame, settlements: DataFrame, config: AssessConfig) -> DataFrame:
    """``df`` with all quality columns; boundaries and settlements have a ``ring``, which is a
    ring, an array of rings or an array of parts that are each an array of rings."""
    c = config
    if not (c.admin1 or c.admin2):
        raise ValueError("admin1 or admin2 is needed")
    check_columns(df, "input", [c.row_id, c.name, c.type, c.lat, c.long, c.admin1, c.admin2])
    check_columns(boundary, "boundaries", [c.ring, c.boundary_order, c.boundary_admin1, c.boundary_admin2])
    names = [(a, b, n) for a, b, n in ((c.admin1, c.boundary_admin1, 1), (c.admin2, c.boundary_admin2, 2)) if a and b]
    out = spread(df).withColumns({a: preclean(F.col(a)) for a, _, _ in names})
    out = out.withColumn(c.type, F.coalesce(F.nullif(F.col(c.type), F.lit("")), F.lit(c.poi_kind)))
    out = out.withColumn(c.name, F.coalesce(F.nullif(F.col(c.name), F.lit("")), F.col(c.type)))
    out = with_duplicate_flag(with_code(out, [*[a for a, _, _ in names], c.name, c.type], "poi_code"), "poi_code")
    out = out.withColumn(c.type, fix_language(F.col(c.type), c.language))
    located = lambda x: F.when((F.coalesce(F.col(c.lat), F.lit(0)) != 0) & (F.coalesce(F.col(c.long), F.lit(0)) != 0), F.col(x))
    out = out.withColumns({c.lat: located(c.lat), c.long: located(c.long)})
    out = stored(spatial.check_by_settlement(out, c.row_id, c.long, c.lat, settlements, c.ring, c.settlement_order, c.settlement_type))
    out = spatial.overlaps(out, c.row_id, c.type, c.long, c.lat)
    for a, b, n in names:
        out = stored(spatial.check_by_admin(out, c.row_id, c.long, c.lat, a, boundary, c.ring, c.boundary_order, b, f"admin{n}_bry"))
    levels: tuple[list[str], list[str]] = ([], [])
    table = boundary
    for a, b, n in names:
        table = linkage.with_match_code(table, b, levels[1], None)
        out = stored(linkage.block_match(out, a, table, b, c.boundary_order, f"admin{n - 1}" if levels[0] else "", levels[0], levels[1]))
        levels = ([f"{a}_updated"], [f"{b}_cleaned"])
    for a, b, n in names:
        asked = (F.col(f"admin{n}_bryMatch") == "NO") & (F.col(f"{a}_match_result") == "YES")
        out = spatial.border_distance(out, c.long, c.lat, f"{a}_match_name", asked, boundary, c.ring, c.boundary_order, b, f"dist_to_admin{n}_bry_border_km")
    for metres in (25, 50):
        out = spatial.clusters(out, c.row_id, c.long, c.lat, metres, f"geo_dbscan_r{metres}_cluster_id")
    distances = [x for x in out.columns if x.startswith("dist_to_")]
    out = spatial.mask_without_location(
        out, c.long, c.lat, ("geo_dbscan_r25_cluster_id", "geo_dbscan_r50_cluster_id"), ("is_overlap", "settlement_type", *[f"admin{n}_bryMatch" for _, _, n in names]), tuple(distances)
    )
    return drop_prefixed(out, "dummy")
