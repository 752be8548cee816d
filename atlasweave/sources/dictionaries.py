"""Static lookups and the spelling and type dictionaries."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.sources.files import listed
from atlasweave.sources.tables import exists, load_table

#: Country names by ISO code (fixed values).
COUNTRY_NAMES = {
    "AGO": "Angola", "BDI": "Burundi", "BEN": "Benin", "BFA": "Burkina Faso", "BWA": "Botswana", "CAF": "Central African Republic",
    "CIV": "Côte d'Ivoire", "CMR": "Cameroon", "COD": "COD", "COG": "Republic of the Congo", "COM": "Comoros", "CPV": "Cabo Verde",
    "DJI": "Djibuti", "ERI": "Eritrea", "ESH": "Western Sahara", "ETH": "Ethiopia", "GAB": "Gabon", "GHA": "Ghana", "GIN": "Guinea",
    "GMB": "The Gambia", "GNB": "Guinea Bissau", "GNQ": "Equatorial Guinea", "KEN": "Kenya", "LBR": "Liberia", "LSO": "Lesotho",
    "MDG": "Madagascar", "MLI": "Mali", "MOZ": "Mozambique", "MRT": "Mauritania", "MUS": "Mauritius", "MWI": "Malawi", "NAM": "Namibia",
    "NER": "Niger", "NGA": "Nigeria", "REU": "Réunion", "RWA": "Rwanda", "SDN": "Sudan", "SEN": "Senegal", "SLE": "Sierra_Leone",
    "SOM": "Somalia", "SSD": "South_Sudan", "STP": "Sao Tome and Principe", "SWZ": "Eswatini", "SYC": "Seychelles", "TCD": "Chad",
    "TGO": "Togo", "TZA": "Tanzania", "UGA": "Uganda", "ZAF": "South Africa", "ZMB": "Zambia", "ZWE": "Zimbabwe",
}
#: Output label of each kind of point of interest (fixed values).
POI_LABELS = {"health_facility": "g3_hltfac", "school": "g3_school", "settlement": "g3_settl", "religious_cnt": "g3_relcnt"}
#: Output labels of boundary levels 0 to 4 by ISO code; None where a country has no such level (fixed values).
BOUNDARY_LABELS = {
    "cod": ["g3_cntry", "g3_prov", "g3_ant", "g3_zs", "g3_as"],
    "sle": ["g3_cntry", "g3_prov", "g3_dist", "g3_chief", "g3_sec"],
    "nga": ["g3_cntry", "g3_state", "g3_lga", "g3_ward", None],
    "moz": ["g3_cntry", "g3_prov", "g3_dist", "g3_posto", None],
    "zmb": ["g3_cntry", "g3_prov", "g3_dist", "g3_ward", None],
    "bfa": ["g3_cntry", "g3_regn", "g3_distsan", "g3_comm", None],
}


def country_file_name(iso: str) -> str:
    """The country's name as part of a file name: ASCII, underscores for spaces, no apostrophe."""
    import unicodedata

    plain = unicodedata.normalize("NFD", COUNTRY_NAMES[iso.upper()]).encode("ascii", "ignore").decode()
    return plain.replace("'", "").replace(" ", "_")


def admin_label(iso: str, level: int | str) -> str:
    """Label of a boundary level (2, "2" or "boundary2"); an error if the country has none."""
    label = BOUNDARY_LABELS[iso.lower()][int(str(level).removeprefix("boundary"))]
    if label is None:
        raise ValueError(f"{iso} has no boundary level {level}")
    return label


def poi_labels(kind: str) -> tuple[str, str]:
    """Labels of the name and type columns of a kind of point of interest."""
    name = POI_LABELS.get({"religious_cntr": "religious_cnt"}.get(kind, kind), "g3_unknown")
    return name, f"{name}_type"


@dataclass(frozen=True)
class Dictionaries:
    """Spelling corrections (word to its misspellings, in order) and types with abbreviations. These
    are curated lists of a few thousand rows, held by the driver."""

    spelling: dict[str, list[str]] = field(default_factory=dict)
    types: list[str] = field(default_factory=list)
    abbreviations: list[str] = field(default_factory=list)


def dictionary_path(spark: SparkSession, folder: str, iso: str, kind: str, what: str) -> str:
    """The dictionary's workbook, or the CSV where there is none."""
    paths = [f"{folder}/{kind}/{iso}_{what}_dictionary.{suffix}" for suffix in ("xlsx", "csv")]
    return paths[0] if exists(spark, paths[0]) else paths[1]


def _bounded(table: DataFrame, columns: list[str], most: int = 200_000) -> list:
    """Rows of a curated list, in their order; more than ``most`` are an error, not a driver's load."""
    rows = table.select(*columns).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a dictionary of over {most} rows")
    return rows


def spelling_from(table: DataFrame) -> dict[str, list[str]]:
    """word -> misspellings in the order of the table's rows."""
    out: dict[str, list[str]] = {}
    for r in _bounded(table.filter("word is not null and misspelling is not null"), ["word", "misspelling"]):
        out.setdefault(r["word"], []).append(r["misspelling"])
    return out


def load_dictionaries(spark: SparkSession, iso: str, kind: str, folder: str) -> Dictionaries:
    spelling = spelling_from(load_table(spark, dictionary_path(spark, folder, iso, kind, "spelling")))
    rows = _bounded(load_table(spark, dictionary_path(spark, folder, iso, kind, "type")), ["type", "abbreviation"])
    return Dictionaries(spelling, [r["type"] for r in rows if r["type"]], [r["abbreviation"] for r in rows if r["abbreviation"]])


def dictionary_report(spark: SparkSession, folder: str) -> DataFrame:
    """How many countries and dictionaries each kind of point of interest has under ``folder``, on any
    file system that Spark knows."""
    parts = [path.replace("\\", "/").split("/")[-2:] for path in listed(spark, f"{folder}/*/*_dictionary.*")]
    found = [(kind, name.split("_")[0], name.split("_")[1]) for kind, name in parts]
    rows = spark.createDataFrame(found, "kind string, iso string, what string")
    return rows.groupBy("kind").agg(F.count_distinct("iso").alias("countries"), F.count_if(F.col("what") == "spelling").alias("spelling"), F.count_if(F.col("what") == "type").alias("types"))
