"""Runs a pipeline from an INI file or a mapping: ``python -m atlasweave.plans.run clean -c config.ini``.

Sections and keys are those that users' configuration files have (fixed names). Tables get a row
number in the order of all their columns where no id column is named.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from atlasweave.operators.tables import with_row_id
from atlasweave.plans.assess import AssessConfig, assess
from atlasweave.plans.clean import CleanConfig, clean
from atlasweave.plans.match import MatchConfig, match
from atlasweave.sources.dictionaries import Dictionaries, load_dictionaries, poi_labels
from atlasweave.sources.tables import check_files, config_section, is_true, load_polygons, load_table, save_table

ROW = "_rid"


def _value(x: Any) -> str:
    """A configured name; blank and "None" are none."""
    return "" if str(x).strip() in ("", "None") else str(x).strip()


def _numbered(df: DataFrame, out: str = ROW) -> DataFrame:
    plain = [f"`{c}`" for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    return with_row_id(df, plain, out)


def _step_path(general: Mapping[str, Any], step: int, extension: str) -> str:
    return f"{general['poi_output_dir']}/{general['poi_input_filename'].split('.')[0]}_preprocessing{step}{extension}"


def run_clean(spark: SparkSession, source: str | Mapping[str, Any]) -> str:
    g = config_section(source, "about_POI_table", ["data_source", "poi_input_dir", "poi_input_filename", "poi_output_dir", "country_ISO", "poi_name_field"])
    extension = config_section(source, "preprocessing1", ["poi_output_extension_type"])["poi_output_extension_type"]
    path = f"{g['poi_input_dir']}/{g['poi_input_filename']}"
    check_files(spark, [path], [g["poi_output_dir"]])
    lat, long, kind = _value(g.get("poi_lat_field", "")), _value(g.get("poi_long_field", "")), g.get("poi_data_type", "health_facility")
    folder = _value(g.get("dictionaries_dir", ""))
    config = CleanConfig(
        g["poi_name_field"], g["country_ISO"], g["data_source"], ROW, kind, _value(g.get("poi_type_field", "")),
        {n: g[f"boundary{n}"] for n in range(1, 5) if _value(g.get(f"boundary{n}", ""))}, g.get("language", ""), lat, long,
    )
    words = load_dictionaries(spark, config.iso, kind, folder) if folder else Dictionaries()
    return save_table(clean(_numbered(load_table(spark, path, lat, long)), config, words).drop(ROW), _step_path(g, 1, extension))


def run_assess(spark: SparkSession, source: str | Mapping[str, Any]) -> str:
    g = config_section(source, "about_POI_table", ["poi_input_filename", "poi_output_dir", "poi_data_type", "poi_lat_field", "poi_long_field"])
    before = config_section(source, "preprocessing1", ["poi_output_extension_type"])["poi_output_extension_type"]
    s = config_section(source, "preprocessing2", ["poi_field", "admin_bdry_file", "path_sett_extent"])
    path = _step_path(g, 1, before)
    check_files(spark, [path, s["admin_bdry_file"], s["path_sett_extent"]], [g["poi_output_dir"]])
    config = AssessConfig(
        ROW, s["poi_field"], poi_labels(g["poi_data_type"])[1], g["poi_data_type"], _value(s.get("poi_admin1", "")), _value(s.get("poi_admin2", "")), g["poi_lat_field"], g["poi_long_field"],
        _value(s.get("admin1_bdry_var", "")), _value(s.get("admin2_bdry_var", "")), boundary_order="bid", settlement_order="sid", language=g.get("language", ""),
    )
    points = _numbered(load_table(spark, path, config.lat, config.long))
    made = assess(points, _numbered(load_polygons(spark, s["admin_bdry_file"]), "bid"), _numbered(load_polygons(spark, s["path_sett_extent"]), "sid"), config)
    return save_table(made.drop(ROW), _step_path(g, 2, s.get("poi_output_extension_type", ".gpkg")))


def run_match(spark: SparkSession, source: str | Mapping[str, Any]) -> tuple[str, str]:
    c = config_section(source, "inputs", ["it_input_dir", "it_input_filename", "it_output_dir", "it_output_filename", "it_poi_name", "mt_input_dir", "mt_input_filename", "mt_output_dir", "mt_output_filename", "mt_poi_name"])
    paths = {x: f"{c[f'{x}_{w}_dir']}/{c[f'{x}_{w}_filename']}" for x in ("it", "mt") for w in ("input",)}
    check_files(spark, list(paths.values()), [c["it_output_dir"], c["mt_output_dir"]])
    named = {k: _value(c.get(k, "")) for k in ("it_poi_type", "it_admin1", "it_admin2", "it_id", "it_lat", "it_long", "mt_poi_type", "mt_admin1", "mt_admin2", "mt_lat", "mt_long")}
    df = _numbered(load_table(spark, paths["it"], named["it_lat"], named["it_long"]))
    other = _numbered(load_table(spark, paths["mt"], named["mt_lat"], named["mt_long"]), "_mrid")
    config = MatchConfig(
        c["it_poi_name"], named["it_id"] if named["it_id"] in df.columns else ROW, c["mt_poi_name"], "_mrid", named["it_admin1"], named["it_admin2"], named["it_poi_type"], named["mt_admin1"], named["mt_admin2"],
        named["mt_poi_type"], is_true(c.get("match_by_distance", "False")), float(c.get("match_distance_m", 500)), (named["it_long"], named["it_lat"]), (named["mt_long"], named["mt_lat"]),
    )
    matched, table = match(df, other, config)
    return save_table(matched.drop(ROW), f"{c['it_output_dir']}/{c['it_output_filename']}"), save_table(table.drop("_mrid"), f"{c['mt_output_dir']}/{c['mt_output_filename']}")


PIPELINES = {"clean": run_clean, "assess": run_assess, "match": run_match}


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="atlasweave")
    parser.add_argument("pipeline", choices=sorted(PIPELINES))
    parser.add_argument("-c", "--config", required=True, help="configuration file")
    given = parser.parse_args(arguments)
    print(PIPELINES[given.pipeline](SparkSession.builder.appName("atlasweave").getOrCreate(), given.config))


if __name__ == "__main__":
    main()
