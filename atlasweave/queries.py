"""Registered queries over the driver's tables and their DuckDB SQL.

No table has names with types, coordinates or boundaries, so these are derived by expressions that
Spark and DuckDB both read: names from parts, points and boxes from keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.functions import geo, phonetic, similarity, text
from atlasweave.functions.ids import with_code, with_required_fields
from atlasweave.operators import linkage, spatial, tables
from atlasweave.plans.assess import AssessConfig, assess
from atlasweave.plans.clean import CleanConfig, clean, map_type
from atlasweave.plans.match import MatchConfig, match
from atlasweave.sources import dictionaries
from atlasweave.sources.tables import load_table, save_table, with_coordinate
from atlasweave.streaming.matching import match_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TYPES = ["Centre De Sante", "Hospital District", "Hopital General", "Clinic", "Poste De Sante/Dispensaire"]
ABBREVIATIONS = ["CS", "HD", "HG", "CL", "PS"]
SPELLING = {"Hopital": ["Hopitol", "Hoptial"], "Sante": ["Snte", "Santee"], "Centre": ["Center", "Cantre"]}
DICTIONARY = dictionaries.Dictionaries(SPELLING, TYPES, ABBREVIATIONS)

#: A facility name for each part, with misspellings, numerals, signs and types.
NAME = """CASE p_partkey % 9 WHEN 0 THEN concat(p_name, ' Hopitol') WHEN 1 THEN concat(replace(p_name, ' ', '-'), ' II')
 WHEN 2 THEN concat('c s ', p_name) WHEN 3 THEN concat(p_name, ' Centre de Snte') WHEN 4 THEN concat(p_name, p_partkey)
 WHEN 5 THEN concat('District Hospital ', p_name, ' & co. iii') WHEN 6 THEN concat(p_name, ' Clinic (Major)!')
 WHEN 7 THEN concat('Hopital General de ', p_name, ' V') ELSE p_name END"""
POI = f"SELECT p_partkey AS k, {NAME} AS name, p_type AS kind, p_brand AS brand FROM part"
LAT, LONG = "(({k} * {k} * 31 + {k} * 7919) % 997) * 0.0003", "(({k} * {k} * 17 + {k} * 104729) % 899) * 0.0003"


def _point(key: str) -> str:
    return f"{LAT.format(k=key)} AS lat, {LONG.format(k=key)} AS lon"


CUSTOMER_POINTS = f"SELECT c_custkey AS k, {_point('c_custkey')} FROM customer"
SUPPLIER_POINTS = f"SELECT s_suppkey AS s, {LAT.format(k='s_suppkey')} AS slat, {LONG.format(k='s_suppkey')} AS slon FROM supplier"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _sql(spark: SparkSession, sf: str, statement: str, *names: str) -> DataFrame:
    """A derived table: ``statement`` over the named tables."""
    for n in names:
        spark.read.parquet(f"{sf}/{n}.parquet").createOrReplaceTempView(n)
    return spark.sql(statement)


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _title(x: str) -> str:
    return f"coalesce(list_aggregate(list_transform(regexp_extract_all({x}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: concat(upper(w[1]), lower(w[2:]))), 'string_agg', ''), '')"


def _sub(x: str, pattern: str, by: str) -> str:
    pattern, by = pattern.replace("'", "''"), by.replace("'", "''")
    return f"regexp_replace({x}, '{pattern}', '{by}', 'g')"


def _squeezed(x: str) -> str:
    return _sub(_sub(x, r"\s+", " "), "^ | $", "")


def preclean_sql(x: str) -> str:
    t = f"strip_accents(replace(replace(coalesce(CAST({x} AS STRING), ''), 'ß', 'ss'), 'œ', 'oe'))"
    t = _title(f"(CASE WHEN {t} = '&' THEN 'and' ELSE {t} END)")
    for pattern, by in ((r" And\b", " and"), (r"`S\b", " `s"), (r" Iii\b", " 3"), (r" Ii\b", " 2"), (r" I\b", " 1"), (r" Iv\b", " 4"), (r" V\b", " 5"), ("([0-9]+)", r" \1 "), (r"\.", "")):
        t = _sub(t, pattern, by)
    return _squeezed(_sub(t, "[^a-zA-Z0-9()']", " "))


def spelling_sql(x: str) -> str:
    for word, wrong in SPELLING.items():
        x = _sub(x, "(?i)" + "|".join(rf"\b{w}\b" for w in wrong), word)
    return x


KEYWORDS = text.type_keywords(TYPES)


def type_info_sql(x: str) -> str:
    for a in ABBREVIATIONS:
        x = _sub(_sub(x, f"(?i)^{' '.join(a)} ", f"{a} "), f"(?i) {' '.join(a)}$", f" {a}")
    for t in KEYWORDS:
        if len(t.split()) == 2:
            x = _sub(x, "(?i)" + " ".join(t.split()[::-1]), t)
    return x


def without_type_sql(x: str) -> str:
    x = _sub(_title(x), "|".join(KEYWORDS), "")
    x = _sub(x, "|".join(rf"\b{a.title()}\b" for a in sorted(ABBREVIATIONS, key=lambda a: (-len(a), a))), " ")
    return _squeezed(_sub(x, r"\bDe\b|\bDo\b|\bDa\b|\bDu\b|^Dos|^Das", " "))


@query(f"SELECT p_partkey AS k, {preclean_sql('name')} AS clean FROM (SELECT p_partkey, {NAME} AS name FROM part)")
def preclean_part(spark, sf):
    return _sql(spark, sf, POI, "part").select("k", text.preclean(F.col("name")).alias("clean"))


@query(f"SELECT c_custkey AS k, {preclean_sql('c_name')} AS clean FROM customer")
def preclean_customer(spark, sf):
    return _read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), text.preclean(F.col("c_name")).alias("clean"))


@query(f"SELECT doc_id, {preclean_sql('text')} AS clean FROM documents")
def preclean_docs(spark, sf):
    return _read(spark, sf, "documents").select("doc_id", text.preclean(F.col("text")).alias("clean"))


@query(f"SELECT k, {spelling_sql(preclean_sql('name'))} AS fixed FROM ({POI})")
def spelling_fix(spark, sf):
    return _sql(spark, sf, POI, "part").select("k", text.correct_spelling(text.preclean(F.col("name")), SPELLING).alias("fixed"))


def _fixed(spark, sf) -> DataFrame:
    fixed = text.clean_type_info(text.correct_spelling(text.preclean(F.col("name")), SPELLING), TYPES, ABBREVIATIONS)
    return _sql(spark, sf, POI, "part").withColumn("fixed", fixed)


FIXED_SQL = f"SELECT k, kind, {type_info_sql('c')} AS fixed FROM (SELECT k, kind, {spelling_sql('p')} AS c FROM (SELECT k, kind, {preclean_sql('name')} AS p FROM ({POI})))"


@query(f"SELECT k, fixed FROM ({FIXED_SQL})")
def type_abbrev_fix(spark, sf):
    return _fixed(spark, sf).select("k", "fixed")


@query(f"SELECT k, {without_type_sql('fixed')} AS final FROM ({FIXED_SQL})")
def type_remove(spark, sf):
    return _fixed(spark, sf).select("k", text.remove_type_info(F.col("fixed"), TYPES, ABBREVIATIONS).alias("final"))


def _typed(spark, sf) -> DataFrame:
    final = _fixed(spark, sf).withColumn("final", text.remove_type_info(F.col("fixed"), TYPES, ABBREVIATIONS))
    return final.withColumn("extracted", text.extract_type(F.col("fixed"), F.col("final")))


@query(f"""
WITH f AS (SELECT k, fixed, {without_type_sql('fixed')} AS final FROM ({FIXED_SQL})),
w AS (SELECT k, string_split(upper(fixed), ' ') AS a, string_split(upper(final), ' ') AS b, upper(fixed) = upper(final) AS same FROM f),
d AS (SELECT k, same, list_aggregate(list_filter(a, lambda x, i: x <> '' AND NOT list_contains(b, x) AND list_position(a, x) = i), 'string_agg', ' ') AS t FROM w)
SELECT k, CASE WHEN same THEN NULL ELSE nullif({_title("regexp_replace(coalesce(t, ''), '(?i)^de |^do |^da |^du | du$| de$| do$| da$|^de$|^do$|^da$|^du$', '', 'g')")}, '') END AS extracted FROM d""")
def type_extract(spark, sf):
    return _typed(spark, sf).select("k", "extracted")


LANGUAGE_NAME = "concat('Centre Hopital General De Reference ', CASE c_custkey % 4 WHEN 0 THEN 'Maternite' WHEN 1 THEN 'La Sante' WHEN 2 THEN 'Baptist Hopital' ELSE 'Tradi-Praticien' END)"


def language_sql(x: str) -> str:
    for word, written in text.FRENCH.items():
        if word.isascii():
            x = _sub(x, rf"\b{word.title()}\b", written)
        else:  # \b is ASCII only here
            x = f"replace({x}, '{word.title()}', '{written}')"
    return x


@query(f"SELECT c_custkey AS k, {language_sql(LANGUAGE_NAME)} AS written FROM customer")
def language_fix(spark, sf):
    return _sql(spark, sf, f"SELECT c_custkey AS k, {LANGUAGE_NAME} AS t FROM customer", "customer").select("k", text.fix_language(F.col("t"), "French").alias("written"))


@query()
def map_type_best(spark, sf):
    return map_type(_typed(spark, sf), "extracted", "mapped", "score", DICTIONARY).select("k", "mapped", "score")


SIGNS_SQL = " || ".join(f"CASE WHEN contains(name, '{s}') THEN '{s}' ELSE '' END" for s in text.SIGNS)


@query(f"""SELECT k, CAST(length(name) AS INTEGER) AS name_length, CAST(length(kind) AS INTEGER) AS type_length, {SIGNS_SQL} AS special_chars,
CASE WHEN regexp_full_match(name, '[0-9]+') THEN 'all_numerical' ELSE '' END AS only_numeric FROM ({POI})""")
def sanity_flags(spark, sf):
    poi = _sql(spark, sf, POI, "part")
    return poi.withColumns(text.sanity_columns(F.col("name"), F.col("kind"))).select("k", "name_length", "type_length", "special_chars", "only_numeric")


@query("""SELECT k, CAST(least(length(split_part(lat, '.', 2)), length(split_part(lon, '.', 2))) AS INTEGER) AS digits FROM
(SELECT c_custkey AS k, CAST(CAST(c_custkey AS DOUBLE) / 8 AS STRING) AS lat, CAST(CAST(c_custkey AS DOUBLE) / 32 AS STRING) AS lon FROM customer)""")
def digit_resolution(spark, sf):
    own = _read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), (F.col("c_custkey").cast("double") / 8).alias("lat"), (F.col("c_custkey").cast("double") / 32).alias("lon"))
    return own.select("k", text.decimal_digits(F.col("lat"), F.col("lon")).alias("digits"))


def _phonetic(code):
    def run(spark, sf):
        names = _read(spark, sf, "part").select("p_name").distinct()
        return names.select("p_name", phonetic.phonetic_column(F.col("p_name"), code).alias("code"))

    run.__name__ = f"phonetic_{code}"
    return run


for _code in ("soundex", *phonetic.CODES):
    query()(_phonetic(_code))


@query("SELECT o_orderkey, upper(substr(md5(concat_ws('_', coalesce(CAST(o_custkey AS STRING), 'nan'), coalesce(o_orderpriority, 'nan'))), 1, 10)) AS code FROM orders")
def key_uuid(spark, sf):
    return with_code(_read(spark, sf, "orders"), ["o_custkey", "o_orderpriority"], "code").select("o_orderkey", "code")


@query("""SELECT s_suppkey, 'moz' AS g3_iso, '20240101' AS g3_date, 'WHO' AS g3_source,
concat('WHO_', upper(substr(md5(concat('WHO|moz|', CAST(s_suppkey AS STRING))), 1, 10))) AS g3_id FROM supplier""")
def required_metadata(spark, sf):
    return with_required_fields(_read(spark, sf, "supplier"), "WHO", "moz", "s_suppkey", "20240101").select("s_suppkey", "g3_iso", "g3_date", "g3_source", "g3_id")


@query("SELECT o_orderkey, count(*) OVER (PARTITION BY o_custkey, o_orderstatus) AS n FROM orders")
def dup_count(spark, sf):
    return tables.with_group_size(_read(spark, sf, "orders"), ["o_custkey", "o_orderstatus"], "n").select("o_orderkey", "n")


@query("SELECT p_partkey, CAST(CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN 1 ELSE 0 END AS INTEGER) AS p_name_isUnique FROM part")
def dup_flag(spark, sf):
    return tables.with_duplicate_flag(_read(spark, sf, "part"), "p_name").select("p_partkey", "p_name_isUnique")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def not_in_anti(spark, sf):
    urgent = _read(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'")  # every customer has some order
    return tables.drop_where(_read(spark, sf, "customer"), urgent, "c_custkey", "o_custkey").select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)")
def in_semi(spark, sf):
    return tables.keep_where(_read(spark, sf, "customer"), _read(spark, sf, "orders"), "c_custkey", "o_custkey").select("c_custkey")


@query("SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def repeated_values(spark, sf):
    return tables.repeated_keys(_read(spark, sf, "orders"), "o_orderpriority")


@query("SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part")
def expand_split(spark, sf):
    return tables.expand(_read(spark, sf, "part"), "p_name", "word", " ").select("p_partkey", "word")


@query("""SELECT l_orderkey, string_agg(CAST(l_suppkey AS STRING), '/' ORDER BY first, CAST(l_suppkey AS STRING)) AS suppliers FROM
(SELECT l_orderkey, l_suppkey, min(l_linenumber) AS first FROM lineitem GROUP BY 1, 2) GROUP BY 1""")
def uuid_string_agg(spark, sf):
    return _read(spark, sf, "lineitem").groupBy("l_orderkey").agg(tables.joined_values(F.col("l_suppkey").cast("string"), F.col("l_linenumber")).alias("suppliers"))


@query("SELECT l_orderkey, l_linenumber, max(l_quantity) OVER (PARTITION BY l_partkey, l_returnflag) AS top FROM lineitem")
def group_max_broadcast(spark, sf):
    return tables.with_group_max(_read(spark, sf, "lineitem"), ["l_partkey", "l_returnflag"], "l_quantity", "top").select("l_orderkey", "l_linenumber", "top")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey, l_suppkey) = 1")
def keep_last(spark, sf):
    return tables.first_row(_read(spark, sf, "lineitem"), ["l_orderkey"], [F.desc("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) > 1 AS was_dupe FROM orders")
def second_occurrence(spark, sf):
    return tables.with_repeat_flag(_read(spark, sf, "orders"), "o_custkey", "o_orderkey").select("o_orderkey", "was_dupe")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 5")
def top5(spark, sf):
    return tables.top_rows(_read(spark, sf, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_nationkey, NULL FROM supplier")
def union_by_name(spark, sf):
    a = _read(spark, sf, "customer").selectExpr("c_name AS name", "c_nationkey AS nation", "c_mktsegment AS segment")
    return tables.union_all([a, _read(spark, sf, "supplier").selectExpr("s_nationkey AS nation", "s_name AS name")])


@query("SELECT row_number() OVER (ORDER BY s_name, s_suppkey) - 1 AS _rid, s_suppkey FROM supplier")
def row_numbers(spark, sf):
    return tables.with_row_id(_read(spark, sf, "supplier"), ["s_name", "s_suppkey"]).select("_rid", "s_suppkey")


@query("SELECT p_partkey, list_aggregate(list_filter(a, lambda x, i: NOT list_contains(b, x) AND list_position(a, x) = i), 'string_agg', ' ') AS diff FROM (SELECT p_partkey, string_split(upper(p_type), ' ') AS a, string_split(upper(concat(p_name, ' standard large')), ' ') AS b FROM part)")
def token_setdiff(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", tables.difference(F.col("p_type"), F.concat("p_name", F.lit(" standard large"))).alias("diff"))


@query("""SELECT l_orderkey, l_linenumber, CAST(len(list_intersect([CAST(l_suppkey AS STRING), l_returnflag, l_linestatus], [CAST(l_partkey AS STRING), 'A', 'F'])) AS INTEGER) AS shared FROM lineitem""")
def attr_overlap(spark, sf):
    lines = _read(spark, sf, "lineitem").withColumns({"x": F.lit("A"), "y": F.lit("F")})
    return lines.select("l_orderkey", "l_linenumber", tables.overlap(["l_suppkey", "l_returnflag", "l_linestatus"], ["l_partkey", "x", "y"]).alias("shared"))


@query("""WITH f AS (SELECT c_nationkey AS n, arg_min(c_name, c_custkey) AS first_name FROM customer GROUP BY 1)
SELECT s_suppkey, first_name FROM supplier LEFT JOIN f ON n = s_nationkey""")
def lookup_first(spark, sf):
    return tables.looked_up(_read(spark, sf, "supplier"), _read(spark, sf, "customer"), "s_nationkey", "c_nationkey", {"c_name": "first_name"}, "c_custkey").select("s_suppkey", "first_name")


@query("""SELECT o_orderkey, part, c_name AS c_name, c_mktsegment AS o_orderpriority_2 FROM (SELECT o_orderkey, unnest(string_split(concat(CAST(o_custkey AS STRING), '/', CAST(o_custkey + 1 AS STRING)), '/')) AS part FROM orders)
LEFT JOIN customer ON CAST(c_custkey AS STRING) = part""")
def column_transfer(spark, sf):
    own = _read(spark, sf, "orders").withColumn("uuid", F.concat_ws("/", F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string")))
    other = _read(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("u"), "c_name", F.col("c_mktsegment").alias("o_orderpriority"))
    wide = tables.transfer_columns(own, other, "uuid", "u", ["c_name", "o_orderpriority"])
    return wide.select("o_orderkey", F.col("match_uuid_expand").alias("part"), "c_name", "o_orderpriority_2")


# similarity: names against distorted copies, blocked by brand
DISTORT = "CASE p_partkey % 3 WHEN 0 THEN replace(p_name, 'e', 'a') WHEN 1 THEN concat(p_name, 's') ELSE concat('x', substr(p_name, 2)) END"
LEFT_NAMES = "SELECT DISTINCT p_brand AS block, p_name AS clean FROM part"
RIGHT_NAMES = f"SELECT p_brand AS block, {DISTORT} AS cand, min(p_partkey) AS pos FROM part GROUP BY 1, 2"


def _best_sql(score: str) -> str:
    return f"""SELECT block, clean, arg_max(cand, [s, -pos]) AS cand, max(s) AS score FROM (SELECT l.block, l.clean, r.cand, CAST(r.pos AS DOUBLE) AS pos, round({score}, 6) AS s
FROM ({LEFT_NAMES}) l JOIN ({RIGHT_NAMES}) r ON l.block = r.block) GROUP BY 1, 2"""


def _pairs(spark, sf) -> DataFrame:
    return _sql(spark, sf, LEFT_NAMES, "part").join(_sql(spark, sf, RIGHT_NAMES, "part"), "block")


def _best(pairs: DataFrame, score) -> DataFrame:
    scored = pairs.withColumn("s", F.round(score, 6))
    return scored.groupBy("block", "clean").agg(F.max_by("cand", F.struct("s", -F.col("pos"))).alias("cand"), F.max("s").alias("score"))


@query(_best_sql("1 - levenshtein(clean, cand) / greatest(length(clean), length(cand))"))
def lev_best(spark, sf):
    return _best(_pairs(spark, sf), similarity.levenshtein_similarity(F.col("clean"), F.col("cand")))


@query(_best_sql("jaro_similarity(clean, cand)"))
def jaro_best(spark, sf):
    return _best(_pairs(spark, sf), similarity.pair_measure("jaro")("clean", "cand") / 100)


@query(_best_sql("jaro_winkler_similarity(clean, cand)"))
def jw_best(spark, sf):
    return _best(_pairs(spark, sf), similarity.pair_measure("jaro_winkler")("clean", "cand") / 100)


def _measure(name):
    def run(spark, sf):
        return _pairs(spark, sf).select("block", "clean", "cand").distinct().withColumn("score", F.round(similarity.pair_measure(name)("clean", "cand"), 4))

    run.__name__ = f"measure_{name}"
    return run


for _name in similarity.PAIR_MEASURES:
    if _name not in ("jaro", "jaro_winkler"):
        query()(_measure(_name))
SQL["measure_lev_sim"] = f"""SELECT DISTINCT l.block, l.clean, r.cand, round(100 * (1 - levenshtein(clean, cand) / greatest(length(clean), length(cand))), 4) AS score
FROM ({LEFT_NAMES}) l JOIN ({RIGHT_NAMES}) r ON l.block = r.block"""


def lcs_sql(a: str, b: str) -> str:
    """Length of the longest common subsequence: a row of the table for each character of ``b``."""
    start, rest = f"list_transform(range(0, length({a}) + 1), lambda i: CAST(0 AS BIGINT))", f"list_transform(string_split({b}, ''), lambda c: [CAST(unicode(c) AS BIGINT)])"
    cell = f"CASE WHEN k = 1 THEN 0 ELSE greatest(r[k], r[k - 1] + CASE WHEN unicode({a}[k - 1]) = c[1] THEN 1 ELSE 0 END) END"
    row = f"list_transform(range(1, length({a}) + 2), lambda j: list_max(list_transform(range(1, j + 1), lambda k: {cell})))"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE list_reduce(list_prepend({start}, {rest}), lambda r, c: {row})[-1] END)"


def ratio_sql(a: str, b: str) -> str:
    return f"(CASE WHEN {a} = '' AND {b} = '' THEN 100 ELSE 200.0 * {lcs_sql(a, b)} / (length({a}) + length({b})) END)"


def _tokens_sql(words: str) -> str:
    return f"coalesce(list_aggregate(list_sort({words}), 'string_agg', ' '), '')"


def _windows_sql(a: str, b: str) -> str:
    """Stretches of ``b`` as long as ``a``, also those that hang over its ends."""
    return f"unnest(list_transform(range(1 - length({a}), length({b})), lambda i: substr({b}, greatest(i, 0) + 1, i + length({a}) - greatest(i, 0))))"


def measures_sql(pairs: str) -> str:
    """CTEs after which ``m`` has the measures of all distinct ``pairs(clean, cand)``. On the way: tokens in
    order, those that both have, those that one has, all of either set; windows for the partial ones."""
    windows = f"""SELECT a, b, sa, {_windows_sql('sa', 'sb')} AS win FROM o WHERE sa <> '' UNION ALL SELECT a, b, sb, {_windows_sql('sb', 'sa')} FROM o WHERE sa <> '' AND length(sa) = length(sb)"""
    return f"""pairs AS (SELECT DISTINCT clean, cand FROM ({pairs})),
w AS (SELECT *, list_filter(string_split(clean, ' '), lambda x: x <> '') AS x, list_filter(string_split(cand, ' '), lambda x: x <> '') AS y FROM pairs),
t AS (SELECT clean, cand, len(x) = 0 OR len(y) = 0 AS none, {_tokens_sql('x')} AS sx, {_tokens_sql('y')} AS sy, {_tokens_sql('list_distinct(list_filter(x, lambda z: list_contains(y, z)))')} AS shared,
  {_tokens_sql('list_distinct(list_filter(x, lambda z: NOT list_contains(y, z)))')} AS ox, {_tokens_sql('list_distinct(list_filter(y, lambda z: NOT list_contains(x, z)))')} AS oy FROM w),
u AS (SELECT *, trim(concat(shared, ' ', ox)) AS wx, trim(concat(shared, ' ', oy)) AS wy FROM t),
o AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS sa, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS sb FROM (SELECT clean AS a, cand AS b FROM t UNION SELECT sx, sy FROM t UNION SELECT ox, oy FROM t)),
v AS ({windows}),
d AS (SELECT sa, win, {ratio_sql('sa', 'win')} AS r FROM (SELECT DISTINCT sa, win FROM v)),
pr AS (SELECT a, b, max(r) AS pr FROM v JOIN d ON v.sa = d.sa AND v.win = d.win GROUP BY a, b UNION ALL SELECT a, b, CASE WHEN sb = '' THEN 100 ELSE 0 END FROM o WHERE sa = ''),
n AS (SELECT u.*, {ratio_sql('clean', 'cand')} AS indel_ratio, {ratio_sql('sx', 'sy')} AS token_sort_ratio, p.pr AS partial_ratio,
  CASE WHEN none THEN 0 WHEN shared <> '' AND (ox = '' OR oy = '') THEN 100
    WHEN shared = '' THEN {ratio_sql('wx', 'wy')} ELSE greatest({ratio_sql('wx', 'wy')}, 200.0 * length(shared) / (length(shared) + length(wx)), 200.0 * length(shared) / (length(shared) + length(wy))) END AS token_set_ratio,
  CASE WHEN none THEN 0 WHEN shared <> '' THEN 100 ELSE greatest(s.pr, o.pr) END AS partial_token_ratio
  FROM u JOIN pr p ON p.a = clean AND p.b = cand JOIN pr s ON s.a = sx AND s.b = sy JOIN pr o ON o.a = ox AND o.b = oy),
m AS (SELECT clean, cand, 100.0 * (1 - levenshtein(clean, cand) / greatest(length(clean), length(cand))) AS lev_sim, 100.0 * jaro_winkler_similarity(clean, cand) AS jaro_winkler,
  indel_ratio, token_sort_ratio, token_set_ratio, greatest(token_sort_ratio, token_set_ratio) AS token_ratio, partial_ratio, partial_token_ratio FROM n)"""


BRAND_PAIRS = f"SELECT l.block, l.clean, r.cand, r.pos FROM ({LEFT_NAMES}) l JOIN ({RIGHT_NAMES}) r ON l.block = r.block"
for _name in ("indel_ratio", "token_sort_ratio", "token_set_ratio", "token_ratio", "partial_ratio", "partial_token_ratio"):
    SQL[f"measure_{_name}"] = f"""WITH {measures_sql(BRAND_PAIRS)} SELECT DISTINCT c.block, c.clean, c.cand, CAST(round({_name}, 4) AS DOUBLE) AS score FROM ({BRAND_PAIRS}) c JOIN m ON m.clean = c.clean AND m.cand = c.cand"""


def cascade_sql(pairs: str) -> str:
    """The rapid cascade of ``pairs(block, clean, cand, pos)``, whose names are their own processed forms:
    (block, clean, name, score, method, result)."""
    early = ("lev_sim", "jaro_winkler", "indel_ratio", "token_ratio")
    best = ", ".join(f"max({x}) AS {x}, arg_max(cand, [round({x}, 9), -CAST(pos AS DOUBLE)]) AS {x}_c" for x in early)
    late = "".join(
        f""", {x}_5 AS (SELECT block, clean, max(indel_ratio) AS {x}_s, arg_max(cand, [round(indel_ratio, 9), -CAST(k AS DOUBLE)]) AS {x}_c FROM
  (SELECT *, row_number() OVER (PARTITION BY block, clean ORDER BY round({x}, 9) DESC, pos) AS k FROM c) WHERE k <= 5 AND {x} >= 85 GROUP BY 1, 2)"""
        for x in ("partial_ratio", "partial_token_ratio")
    )
    steps = [("lev_sim = 100", "lev_sim_c", "100", "identical"), ("(length(g.clean) <= 4 AND lev_sim >= 70) OR (length(g.clean) = 5 AND lev_sim >= 75) OR lev_sim >= 82", "lev_sim_c", "lev_sim", "levenshtein")]
    steps += [(f"{x} >= {least}", f"{x}_c", x, method) for x, least, method in (("jaro_winkler", 87, "jaro_winkler_similarity"), ("indel_ratio", 85, "fuzz_ratio"), ("token_ratio", 87, "token_ratio"))]
    steps += [(f"{x}_s >= 50", f"{x}_c", f"{x}_s", x) for x in ("partial_ratio", "partial_token_ratio")]
    case = lambda k, last: "CASE " + " ".join(f"WHEN {s[0]} THEN {s[k]}" for s in steps) + f" ELSE {last} END"
    steps = [(a, b, c, f"'{d}'", "'YES'") for a, b, c, d in steps]
    return f"""WITH q AS ({pairs}), {measures_sql('SELECT clean, cand FROM q')}, c AS (SELECT q.block, q.pos, m.* FROM q JOIN m ON m.clean = q.clean AND m.cand = q.cand),
g AS (SELECT block, clean, {best} FROM c GROUP BY 1, 2){late}
SELECT g.block, g.clean, {case(1, 'lev_sim_c')} AS name, CAST({case(2, 'lev_sim')} AS DOUBLE) AS score, {case(3, "'levenshtein'")} AS method, {case(4, "'NO'")} AS result FROM g
LEFT JOIN partial_ratio_5 p ON p.block = g.block AND p.clean = g.clean LEFT JOIN partial_token_ratio_5 t ON t.block = g.block AND t.clean = g.clean"""


@query("SELECT p_partkey, trim(regexp_replace(lower(concat(p_type, ' # ', p_brand, '!')), '[^a-z0-9]', ' ', 'g')) AS processed FROM part")
def processed_names(spark, sf):
    return _read(spark, sf, "part").select("p_partkey", similarity.processed_column(F.concat("p_type", F.lit(" # "), "p_brand", F.lit("!"))).alias("processed"))


def _cascade(kind):
    def run(spark, sf):
        names = _sql(spark, sf, LEFT_NAMES, "part")
        candidates = _sql(spark, sf, RIGHT_NAMES, "part").withColumnRenamed("cand", "clean")
        return linkage.best_in_blocks(names, candidates, kind).withColumn("score", F.round("score", 4))

    run.__name__ = f"cascade_{kind}"
    return run


for _kind in similarity.CASCADES:
    query()(_cascade(_kind))
SQL["cascade_rapid"] = f"SELECT block, clean, name, round(score, 4) AS score, method, result FROM ({cascade_sql(BRAND_PAIRS)})"


@query()
def measures_in_sql(spark, sf):
    similarity.register(spark)
    return _sql(spark, sf, "SELECT p_partkey, round(indel_ratio(p_name, p_type), 4) AS r, nysiis(p_name) AS code FROM part", "part")


# linkage: parts as match table, distorted parts as input
INPUT = f"SELECT p_partkey AS id, {DISTORT} AS poi, p_brand AS admin2, substr(p_brand, 1, 7) AS admin1, p_type AS kind, {_point('p_partkey')} FROM part"
TABLE = f"SELECT p_partkey AS pos, p_name AS mname, p_brand AS madmin2, substr(p_brand, 1, 7) AS madmin1, p_type AS mkind, {LAT.format(k='(p_partkey + 1)')} AS mlat, {LONG.format(k='(p_partkey + 1)')} AS mlon FROM part"


def block_match_sql(level: str, block: str, match_block: str, code: str) -> str:
    """The match columns of INPUT in blocks; ``code`` is the text that a record's code is made of."""
    records = f"(SELECT pos, {match_block} AS block, {preclean_sql('mname')} AS cand, madmin1, madmin2, mkind FROM ({TABLE}))"
    return f"""WITH i AS (SELECT id, {block} AS block, {preclean_sql('poi')} AS name FROM ({INPUT})), r AS (SELECT pos, block, cand, upper(substr(md5({code}), 1, 10)) AS code FROM {records} WHERE cand <> ''),
e AS (SELECT block, cand, min(pos) AS pos, string_agg(code, '/' ORDER BY first) AS codes FROM (SELECT block, cand, code, min(pos) AS first, min(pos) AS pos FROM r GROUP BY 1, 2, 3) GROUP BY 1, 2),
h AS ({cascade_sql("SELECT DISTINCT i.block, lower(i.name) AS clean, lower(e.cand) AS cand, e.pos FROM i JOIN e ON e.block = i.block")}),
j AS (SELECT i.*, e.cand, e.codes, h.score, h.method, coalesce(h.result, 'NO') AS found FROM i LEFT JOIN h ON h.block = i.block AND h.clean = lower(i.name) LEFT JOIN e ON e.block = h.block AND lower(e.cand) = h.name)
SELECT id, CASE WHEN found = 'YES' THEN cand ELSE name END AS poi_updated, cand AS poi_match_name, codes AS poi_match_uuid, found AS poi_match_result, round(score, 4) AS poi_match_score, concat('{level}', method) AS poi_match_type FROM j"""


def _rounded_match(df: DataFrame) -> DataFrame:
    return df.select("id", *[F.round(c, 4).alias(c) if c == "poi_match_score" else c for c in linkage.match_columns("poi")])


@query(block_match_sql("admin2/ ", "concat(admin1, '_', admin2)", "concat(madmin1, '_', madmin2)", "concat_ws('_', block, mkind, cand)"))
def block_match_admin2(spark, sf):
    found = linkage.block_match(_sql(spark, sf, INPUT, "part"), "poi", _sql(spark, sf, TABLE, "part"), "mname", "pos", "admin2", ["admin1", "admin2"], ["madmin1", "madmin2"], "mkind")
    return _rounded_match(found)


@query(block_match_sql("", "''", "''", "cand"))
def block_match_unblocked(spark, sf):
    found = linkage.block_match(_sql(spark, sf, INPUT, "part"), "poi", _sql(spark, sf, TABLE, "part"), "mname", "pos")
    return _rounded_match(found)


@query(f"""WITH i AS (SELECT id, {preclean_sql('poi')} AS clean, admin2 FROM ({INPUT})), m AS (SELECT DISTINCT {preclean_sql('mname')} AS clean, madmin2 FROM ({TABLE}))
SELECT id, CASE WHEN m.clean IS NULL THEN 0 ELSE 1 END AS equal FROM i LEFT JOIN m ON m.clean = i.clean AND madmin2 = admin2""")
def block_match_identical(spark, sf):
    found = linkage.block_match(_sql(spark, sf, INPUT, "part"), "poi", _sql(spark, sf, TABLE, "part"), "mname", "pos", "", ["admin2"], ["madmin2"])
    return found.select("id", F.when(F.col("poi_match_type") == "identical", 1).otherwise(0).alias("equal"))


@query()
def distance_match(spark, sf):
    found = linkage.distance_match(_sql(spark, sf, INPUT, "part"), "id", "poi", ("lon", "lat"), _sql(spark, sf, TABLE, "part"), "mname", ("mlon", "mlat"), "pos", ["madmin1", "madmin2", "mname", "mkind"], 250)
    return found.select("id", *linkage.match_columns("poi"))


HAVERSINE = "2 * 6371.0 * asin(sqrt(pow(sin((radians({b}) - radians({a})) / 2), 2) + cos(radians({a})) * cos(radians({b})) * pow(sin((radians({y}) - radians({x})) / 2), 2)))"
SC_KM = HAVERSINE.format(a="lat", b="slat", x="lon", y="slon")


@query(f"SELECT k, round_even(100 * {HAVERSINE.format(a='lat', b='0.1', x='lon', y='0.2')}, 0) / 100 AS km FROM ({CUSTOMER_POINTS})")
def haversine_pairs(spark, sf):
    return _sql(spark, sf, CUSTOMER_POINTS, "customer").select("k", geo.rounded_km(F.col("lon").cast("double"), F.col("lat").cast("double"), F.lit(0.2), F.lit(0.1)).alias("km"))


AZ_C = "acos(cos(radians(lat)) * cos(radians(lon)))"
AZ_K = f"CASE WHEN lat = 0 AND lon = 0 THEN 1 ELSE {AZ_C} / sin({AZ_C}) END"
CONIC_N = "((cos(radians(20)) - cos(radians(-23))) / (radians(-23) - radians(20)))"
CONIC_G = f"(cos(radians(20)) / {CONIC_N} + radians(20))"


@query(f"""SELECT k, round({AZ_K} * 6371000 * cos(radians(lat)) * sin(radians(lon)), 2) AS ax, round({AZ_K} * 6371000 * sin(radians(lat)), 2) AS ay,
round(6371000 * ({CONIC_G} - radians(lat)) * sin({CONIC_N} * radians(lon - 25)), 2) AS cx, round(6371000 * ({CONIC_G} - ({CONIC_G} - radians(lat)) * cos({CONIC_N} * radians(lon - 25))), 2) AS cy FROM ({CUSTOMER_POINTS})""")
def projections(spark, sf):
    c, _ = _points(spark, sf)
    (ax, ay), (cx, cy) = geo.azimuthal_equidistant(F.col("lon"), F.col("lat")), geo.equidistant_conic(F.col("lon"), F.col("lat"))
    return c.select("k", *[F.round(v, 2).alias(n) for n, v in (("ax", ax), ("ay", ay), ("cx", cx), ("cy", cy))])


def _points(spark, sf) -> tuple[DataFrame, DataFrame]:
    c = _sql(spark, sf, CUSTOMER_POINTS, "customer").withColumns({x: F.col(x).cast("double") for x in ("lat", "lon")})
    s = _sql(spark, sf, SUPPLIER_POINTS, "supplier").withColumns({x: F.col(x).cast("double") for x in ("slat", "slon")})
    return c, s


@query(f"SELECT k, s, round_even(100 * {SC_KM}, 0) / 100 AS km FROM ({CUSTOMER_POINTS}), ({SUPPLIER_POINTS}) WHERE 1000 * {SC_KM} <= 500")
def grid_distance_join(spark, sf):
    c, s = _points(spark, sf)
    return spatial.near_pairs(c, s, 500, ("lon", "lat"), ("slon", "slat"), "d").select("k", "s", (F.rint(F.col("d") * 100) / 100).alias("km"))


# boundaries: a box for each nation, on a 5 x 5 lattice
BOXES = "SELECT n_nationkey AS bid, n_name AS admin2, r_name AS admin1, (n_nationkey % 5) * 0.055 AS x0, (n_nationkey % 5) * 0.055 + 0.05 AS x1, floor(n_nationkey / 5) * 0.06 AS y0, floor(n_nationkey / 5) * 0.06 + 0.055 AS y1 FROM nation JOIN region ON n_regionkey = r_regionkey"


def _boxes(spark, sf) -> DataFrame:
    boxes = _sql(spark, sf, BOXES, "nation", "region").withColumns({c: F.col(c).cast("double") for c in ("x0", "x1", "y0", "y1")})
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return boxes.withColumn("ring", F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"))).drop("x0", "x1", "y0", "y1")


METRES = "6371.0 * 1000 * pi() / 180"
BOX_DIST = f"sqrt(pow(greatest(x0 - lon, 0, lon - x1) * cos(radians(lat)) * {METRES}, 2) + pow(greatest(y0 - lat, 0, lat - y1) * {METRES}, 2))"
NEAREST_SQL = f"""SELECT k, bid, admin1, admin2, d FROM (SELECT k, bid, admin1, admin2, {BOX_DIST} AS d, row_number() OVER (PARTITION BY k ORDER BY {BOX_DIST}, bid) AS r
FROM ({CUSTOMER_POINTS}), ({BOXES}) WHERE {BOX_DIST} <= 250) WHERE r = 1"""


@query(f"SELECT c.k, n.admin2, round(n.d, 2) AS metres FROM ({CUSTOMER_POINTS}) c LEFT JOIN ({NEAREST_SQL}) n ON n.k = c.k")
def nearest_join(spark, sf):
    c, _ = _points(spark, sf)
    return spatial.nearest_polygon(c, "k", "lon", "lat", _boxes(spark, sf), "ring", "bid", 250, "d").select("k", "admin2", F.round("d", 2).alias("metres"))


@query(f"SELECT c.k, CASE WHEN n.d IS NULL OR n.d >= 250 THEN 'Out of a settlement' ELSE n.admin1 END AS settlement_type FROM ({CUSTOMER_POINTS}) c LEFT JOIN ({NEAREST_SQL}) n ON n.k = c.k")
def settlement_check(spark, sf):
    c, _ = _points(spark, sf)
    return spatial.check_by_settlement(c, "k", "lon", "lat", _boxes(spark, sf), "ring", "bid", "admin1").select("k", "settlement_type")


@query()
def admin_check(spark, sf):
    c, _ = _points(spark, sf)
    named = c.withColumn("own", F.concat(F.lit("Nation "), (F.col("k") % 25).cast("string")))
    return spatial.check_by_admin(named, "k", "lon", "lat", "own", _boxes(spark, sf), "ring", "bid", "admin2", "admin2_bry").select("k", "admin2_bry_clean", "admin2_bryMatch", F.round("dist_to_admin2_bry", 2).alias("metres"))


CORNER_SQL = f"""WITH v AS (SELECT bid, unnest([x0, x1, x1, x0]) AS x, unnest([y0, y0, y1, y1]) AS y, unnest([1, 2, 3, 4]) AS i FROM ({BOXES})),
m AS (SELECT k, lat, lon, x, y, row_number() OVER (PARTITION BY k ORDER BY (x - lon) * (x - lon) + (y - lat) * (y - lat), i) AS r FROM ({CUSTOMER_POINTS}) JOIN v ON bid = k % 25 WHERE lat <> 0 AND lon <> 0)
SELECT c.k, round_even(100 * {HAVERSINE.format(a='m.lat', b='m.y', x='m.lon', y='m.x')}, 0) / 100 AS km FROM ({CUSTOMER_POINTS}) c LEFT JOIN m ON m.k = c.k AND r = 1"""


@query(CORNER_SQL)
def boundary_vertex_distance(spark, sf):
    c, _ = _points(spark, sf)
    boxes = _boxes(spark, sf).withColumn("nm", F.concat(F.lit("N"), F.col("bid").cast("string")))
    own = c.withColumn("own", text.preclean(F.concat(F.lit("N"), (F.col("k") % 25).cast("string"))))
    return spatial.border_distance(own, "lon", "lat", "own", F.lit(True), boxes, "ring", "bid", "nm", "km").select("k", "km")


@query(f"SELECT k, nullif(lat, 0) AS lat, CASE WHEN lat = 0 THEN NULL ELSE lon END AS lon, CASE WHEN lat = 0 THEN 'NA' ELSE 'x' END AS flag, CASE WHEN lat = 0 THEN -1.0 ELSE 1.5 END AS dist FROM (SELECT k, CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE lat END AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon FROM ({CUSTOMER_POINTS}))".replace("-1.0 ELSE 1.5 END", "CAST(-1 AS DOUBLE) ELSE CAST(1.5 AS DOUBLE) END"))
def no_location_mask(spark, sf):
    c, _ = _points(spark, sf)
    own = c.withColumns({"lat": F.when(F.col("k") % 7 == 0, 0.0).otherwise(F.col("lat")), "flag": F.lit("x"), "dist": F.lit(1.5)})
    return spatial.mask_without_location(own, "lon", "lat", (), ("flag",), ("dist",))


PAIR_KM = HAVERSINE.format(a="a.lat", b="b.lat", x="a.lon", y="b.lon")
CLUSTER_SQL = f"""WITH RECURSIVE p AS ({CUSTOMER_POINTS}), e AS (SELECT a.k AS u, b.k AS v FROM p a, p b WHERE a.k <> b.k AND 1000 * {PAIR_KM} <= 60),
reach AS (SELECT k, k AS r FROM p UNION SELECT reach.k, e.v FROM reach JOIN e ON e.u = reach.r),
root AS (SELECT k, min(r) AS root, count(*) AS n FROM reach GROUP BY k)
SELECT k, CAST(CASE WHEN n > 1 THEN dense_rank() OVER (PARTITION BY n > 1 ORDER BY root) ELSE -row_number() OVER (PARTITION BY n > 1 ORDER BY root) END AS BIGINT) AS cluster FROM root"""


@query(CLUSTER_SQL)
def dbscan_clusters(spark, sf):
    c, _ = _points(spark, sf)
    return spatial.clusters(c, "k", "lon", "lat", 60, "cluster").select("k", "cluster")


DENSE_SQL = f"""WITH RECURSIVE p AS ({CUSTOMER_POINTS}), e AS (SELECT a.k AS u, b.k AS v FROM p a, p b WHERE 1000 * {PAIR_KM} <= 150),
core AS (SELECT u AS k FROM e GROUP BY u HAVING count(*) >= 4), ce AS (SELECT u, v FROM e WHERE u IN (SELECT k FROM core) AND v IN (SELECT k FROM core)),
reach AS (SELECT k, k AS r FROM core UNION SELECT reach.k, ce.v FROM reach JOIN ce ON ce.u = reach.r),
root AS (SELECT k, min(r) AS root FROM reach GROUP BY k), num AS (SELECT k, dense_rank() OVER (ORDER BY root) AS c FROM root),
near AS (SELECT u AS k, min(c) AS c FROM e JOIN num ON num.k = e.v GROUP BY u)
SELECT p.k, CAST(coalesce(c, -row_number() OVER (PARTITION BY c IS NULL ORDER BY p.k)) AS BIGINT) AS cluster FROM p LEFT JOIN near ON near.k = p.k"""


@query(DENSE_SQL)
def dbscan_min_samples(spark, sf):
    c, _ = _points(spark, sf)
    return spatial.clusters(c, "k", "lon", "lat", 150, "cluster", 4).select("k", "cluster")


@query(f"""WITH c AS (SELECT x.k, x.cluster, n.c_mktsegment AS seg FROM ({CLUSTER_SQL}) x JOIN customer n ON c_custkey = x.k), m AS (SELECT cluster, count(DISTINCT seg) > 1 AS many FROM c WHERE cluster > 0 GROUP BY 1)
SELECT k, CASE WHEN many THEN 'YES' ELSE 'NO' END AS is_overlap FROM c LEFT JOIN m ON m.cluster = c.cluster""")
def overlap_flag(spark, sf):
    c, _ = _points(spark, sf)
    named = c.join(_read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment"), "k")
    return spatial.overlaps(named, "k", "c_mktsegment", "lon", "lat", 60).select("k", "is_overlap")


# resolvers: order lines as matches of an order (id) with parts (uuid)
MATCHES = """SELECT ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey AS row, l_orderkey % 400 AS id, CAST(l_partkey % 150 AS STRING) AS part, CASE l_linenumber % 3 WHEN 0 THEN 'admin2/ identical' WHEN 1 THEN 'admin2/ partial_ratio' ELSE 'admin2/ levenshtein' END AS kind,
CAST(70 + l_quantity % 30 AS DOUBLE) AS score, CASE WHEN l_returnflag = 'R' THEN 'NO' ELSE 'YES' END AS result, l_linestatus AS a, CAST(l_suppkey % 5 AS STRING) AS b, CAST(l_partkey % 150 AS STRING) AS uuid FROM lineitem"""
RECORDS = "SELECT p_partkey AS pos, CAST(p_partkey % 150 AS STRING) AS u, CASE WHEN p_size % 2 = 0 THEN 'O' ELSE 'F' END AS ma, CAST(p_size % 5 AS STRING) AS mb FROM part"
# a uuid that several records have stands for the first of them
FIRST_RECORDS = f"SELECT u, arg_min(ma, pos) AS ma, arg_min(mb, pos) AS mb FROM ({RECORDS}) GROUP BY u"


@query(f"""WITH m AS ({MATCHES}), a AS (SELECT *, max(score) OVER (PARTITION BY part, kind, result) AS mx FROM m),
b AS (SELECT row, id, part, kind, score, CASE WHEN score = mx THEN result ELSE 'NO' END AS result, CASE WHEN kind LIKE '%partial%' THEN 0 WHEN kind LIKE '%identical%' THEN 2 ELSE 1 END AS rk FROM a),
c AS (SELECT *, max(rk) OVER (PARTITION BY part, result) AS mr FROM b), d AS (SELECT row, id, CASE WHEN rk = mr THEN result ELSE 'NO' END AS result, row_number() OVER (PARTITION BY id ORDER BY row) AS rn FROM c)
SELECT row, id, result FROM d WHERE NOT (rn > 1 AND result = 'NO')""")
def best_match_resolve(spark, sf):
    return linkage.resolve_by_best_match(_sql(spark, sf, MATCHES, "lineitem"), "part", "id", "kind", "score", "result", "row").select("row", "id", "result")


@query(f"""WITH j AS (SELECT m.*, len(list_intersect([m.a, m.b], [r.ma, r.mb])) AS n FROM ({MATCHES}) m LEFT JOIN ({FIRST_RECORDS}) r ON r.u = m.part),
i AS (SELECT id FROM j WHERE result = 'YES' GROUP BY 1 HAVING count(*) > 1), x AS (SELECT id, max(n) AS mx FROM j WHERE id IN (SELECT id FROM i) GROUP BY 1),
k AS (SELECT j.*, x.mx FROM j LEFT JOIN x ON x.id = j.id WHERE mx IS NULL OR n = mx),
f AS (SELECT id, part, min(row) AS o FROM k WHERE mx IS NOT NULL GROUP BY 1, 2), l AS (SELECT id, string_agg(part, '/' ORDER BY o) AS list FROM f GROUP BY 1),
o AS (SELECT k.row, k.id, k.part, k.result, k.n, coalesce(l.list, k.uuid) AS uuid FROM k LEFT JOIN l ON l.id = k.id),
d AS (SELECT part FROM o WHERE result = 'YES' GROUP BY 1 HAVING count(*) > 1), h AS (SELECT part, id, max(n) AS n FROM o WHERE part IN (SELECT part FROM d) GROUP BY 1, 2),
y AS (SELECT *, max(n) OVER (PARTITION BY part) AS mx FROM h), s AS (SELECT part FROM y WHERE n = mx GROUP BY 1 HAVING count(*) = 1), z AS (SELECT DISTINCT id FROM y WHERE n < mx AND part IN (SELECT part FROM s))
SELECT row, id, uuid, CASE WHEN id IN (SELECT id FROM z) THEN 'NO' ELSE result END AS result FROM o""")
def attr_resolve(spark, sf):
    found = linkage.resolve_by_attribute(_sql(spark, sf, MATCHES, "lineitem"), "id", "uuid", "part", "result", ["a", "b"], _sql(spark, sf, RECORDS, "part"), "u", ["ma", "mb"], "pos", "row")
    return found.select("row", "id", "uuid", "result")


SEVERAL = f"SELECT row, a, b, CASE WHEN row % 4 = 0 THEN part ELSE concat(part, '/', CAST(CAST(uuid AS INT) * 7 % 160 AS STRING), '/', CAST(CAST(uuid AS INT) * 11 % 150 AS STRING)) END AS uuid FROM ({MATCHES})"


@query(f"""WITH m AS (SELECT *, row_number() OVER () AS rid FROM ({SEVERAL})), p AS (SELECT rid, row, uuid, a, b, unnest(string_split(uuid, '/')) AS part, generate_subscripts(string_split(uuid, '/'), 1) AS i FROM m),
n AS (SELECT p.*, len(list_intersect([p.a, p.b], [r.ma, r.mb])) AS n FROM p LEFT JOIN ({FIRST_RECORDS}) r ON r.u = p.part), x AS (SELECT *, max(n) OVER (PARTITION BY rid) AS mx FROM n)
SELECT row, CASE WHEN contains(any_value(uuid), '/') THEN string_agg(part, '/' ORDER BY i) FILTER (n = mx) ELSE any_value(uuid) END AS uuid FROM x GROUP BY rid, row""")
def attr_best_parts(spark, sf):
    found = linkage.best_parts_by_attribute(_sql(spark, sf, SEVERAL, "lineitem"), "row", "uuid", ["a", "b"], _sql(spark, sf, RECORDS, "part"), "u", ["ma", "mb"], "pos")
    return found.select("row", "uuid")


PLACED = f"SELECT row, id, part, result, {LAT.format(k='id')} AS lat, {LONG.format(k='id')} AS lon FROM ({MATCHES})"
PLACES = f"SELECT p_partkey AS pos, CAST(p_partkey % 150 AS STRING) AS u, {LAT.format(k='p_partkey')} AS plat, {LONG.format(k='p_partkey')} AS plon FROM part"
FIRST_PLACES = f"SELECT u, arg_min(plat, pos) AS plat, arg_min(plon, pos) AS plon FROM ({PLACES}) GROUP BY u"
PLACE_KM = HAVERSINE.format(a="lat", b="plat", x="lon", y="plon")


@query(f"""WITH m AS (SELECT m.*, round_even(100 * {PLACE_KM}, 0) / 100 AS d FROM ({PLACED}) m LEFT JOIN ({FIRST_PLACES}) r ON r.u = m.part),
i AS (SELECT id, count(*) AS c, arg_min(part, [d, row]) AS keep, min(d) AS md FROM m WHERE result = 'YES' GROUP BY 1 HAVING count(*) > 1),
o AS (SELECT m.* FROM m LEFT JOIN i ON i.id = m.id AND md * 1000 <= 5000 WHERE keep IS NULL OR part = keep),
p AS (SELECT part, arg_min(id, [d, row]) AS win, min(d) AS md FROM o WHERE result = 'YES' GROUP BY 1 HAVING count(*) > 1)
SELECT o.row, o.id, CASE WHEN win IS NOT NULL AND o.id <> win THEN 'NO' ELSE result END AS result FROM o LEFT JOIN p ON p.part = o.part AND p.md * 1000 <= 5000""")
def dist_resolve(spark, sf):
    placed = _sql(spark, sf, PLACED, "lineitem").withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    places = _sql(spark, sf, PLACES, "part").withColumns({c: F.col(c).cast("double") for c in ("plat", "plon")})
    return linkage.resolve_by_distance(placed, "id", "part", "result", ("lon", "lat"), places, "u", ("plon", "plat"), "pos", "row", 5000).select("row", "id", "result")


@query(f"""SELECT row, round_even(100 * {PLACE_KM}, 0) / 100 AS km FROM ({PLACED}) m LEFT JOIN ({FIRST_PLACES}) r ON r.u = m.part""")
def match_distance(spark, sf):
    placed = _sql(spark, sf, PLACED, "lineitem").withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    places = _sql(spark, sf, PLACES, "part").withColumns({c: F.col(c).cast("double") for c in ("plat", "plon")})
    return linkage.match_distance(placed, "part", ("lon", "lat"), places, "u", ("plon", "plat"), "pos", "km").select("row", "km")


COMPOSITE = f"SELECT row, id, result, CASE WHEN row % 4 = 0 THEN part ELSE concat(part, '/', CAST(CAST(part AS INT) * 7 % 160 AS STRING), '/', CAST(CAST(part AS INT) * 11 % 150 AS STRING)) END AS uuid, lat, lon FROM ({PLACED})"


@query(f"""WITH m AS ({COMPOSITE}), g AS (SELECT uuid, arg_min(lat, row) AS lat, arg_min(lon, row) AS lon FROM m WHERE result = 'YES' AND contains(uuid, '/') GROUP BY 1),
p AS (SELECT uuid, lat, lon, unnest(string_split(uuid, '/')) AS part, generate_subscripts(string_split(uuid, '/'), 1) AS i FROM g),
d AS (SELECT uuid, part, round_even(100 * {PLACE_KM}, 0) / 100 AS d, i FROM p LEFT JOIN ({FIRST_PLACES}) r ON r.u = p.part),
b AS (SELECT uuid, part, d, row_number() OVER (PARTITION BY uuid ORDER BY d NULLS LAST, i) AS n FROM d)
SELECT row, CASE WHEN b.uuid IS NULL THEN m.uuid WHEN d * 1000 <= 20000 THEN b.part END AS uuid, CASE WHEN b.uuid IS NOT NULL AND NOT coalesce(d * 1000 <= 20000, false) THEN 'NO' ELSE result END AS result
FROM m LEFT JOIN b ON b.uuid = m.uuid AND n = 1 AND m.result = 'YES'""")
def composite_by_distance(spark, sf):
    placed = _sql(spark, sf, COMPOSITE, "lineitem").withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    places = _sql(spark, sf, PLACES, "part").withColumns({c: F.col(c).cast("double") for c in ("plat", "plon")})
    return linkage.resolve_composite_by_distance(placed, "uuid", "result", ("lon", "lat"), places, "u", ("plon", "plat"), "pos", "row", 20_000).select("row", "uuid", "result")


@query(f"""WITH m AS ({MATCHES}) SELECT pos, CASE WHEN u IN (SELECT part FROM m WHERE result = 'YES' AND score >= 99) THEN 'YES' ELSE 'NO' END AS ismatch FROM ({RECORDS})""")
def ismatch_flag(spark, sf):
    hits = _sql(spark, sf, MATCHES, "lineitem").filter("score >= 99")
    return linkage.with_is_match(_sql(spark, sf, RECORDS, "part"), "u", hits, "part", "result").select("pos", "ismatch")


@query(f"""WITH m AS (SELECT row, id, result, CAST(CASE WHEN row % 5 = 0 THEN NULL WHEN row % 5 = 1 THEN -1 ELSE score END AS DOUBLE) AS dist FROM ({MATCHES})),
d AS (SELECT row, id, result, CASE WHEN dist IS NULL OR dist = -1 THEN 0 ELSE dist END AS dist FROM m)
SELECT row, id, CASE WHEN dist = min(dist) OVER (PARTITION BY id, result) THEN result ELSE 'NO' END AS result FROM d""")
def border_resolve(spark, sf):
    own = _sql(spark, sf, f"SELECT row, id, result, CAST(CASE WHEN row % 5 = 0 THEN NULL WHEN row % 5 = 1 THEN -1 ELSE score END AS DOUBLE) AS dist FROM ({MATCHES})", "lineitem")
    return linkage.resolve_by_border_distance(own, "id", "dist", "result").select("row", "id", "result")


@query(f"SELECT kind AS match_type, result AS match_result, count(*) AS n, round(avg(score), 2) AS avg_score FROM ({MATCHES}) GROUP BY 1, 2")
def match_report(spark, sf):
    return tables.match_report(_sql(spark, sf, MATCHES, "lineitem"), "kind", "result", "score")


@query("SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1 HAVING count(*) >= 10")
def word_frequency(spark, sf):
    return tables.word_frequency(_read(spark, sf, "documents"), "text")


@query("""WITH w AS (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(concat(p_name, ' ', p_type), ' ')) AS word FROM part UNION ALL SELECT unnest(string_split(concat(replace(p_name, 'e', 'a'), ' ', replace(p_name, 'l', '')), ' ')) FROM part) WHERE length(word) >= 4 GROUP BY 1)
SELECT a.word AS word, b.word AS misspelling FROM w a JOIN w b ON a.word <> b.word AND levenshtein(lower(a.word), lower(b.word)) <= 1 AND (a.n > b.n OR (a.n = b.n AND a.word < b.word))""")
def spelling_candidates(spark, sf):
    part = _read(spark, sf, "part")
    names = part.select(F.concat_ws(" ", "p_name", "p_type").alias("t")).unionAll(part.select(F.concat_ws(" ", F.replace("p_name", F.lit("e"), F.lit("a")), F.replace("p_name", F.lit("l"), F.lit("")))))
    return tables.spelling_candidates(tables.word_frequency(names, "t", 1))


@query("SELECT word, n FROM (SELECT word, count(*) AS n FROM (SELECT unnest(string_split(p_type, ' ')) AS word FROM part) GROUP BY 1) WHERE word IN ('ECONOMY', 'LARGE', 'SMALL') AND n >= 10")
def type_word_candidates(spark, sf):
    return tables.type_candidates(tables.word_frequency(_read(spark, sf, "part"), "p_type"), ["ECONOMY", "LARGE", "SMALL"])


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_acctbal AS DOUBLE) END AS v FROM customer")
def coordinate_check(spark, sf):
    raw = _read(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 3 == 0, F.when(F.col("c_custkey") % 2 == 0, "<Null>").otherwise(" ")).otherwise(F.col("c_acctbal").cast("string")).alias("v"))
    return with_coordinate(raw, "v")


@query("SELECT CAST(p_partkey AS STRING) AS p_partkey, p_name, nullif(p_brand, 'Brand#13') AS p_brand FROM part")
def csv_round_trip(spark, sf):
    path = save_table(_read(spark, sf, "part").select("p_partkey", "p_name", F.when(F.col("p_brand") == "Brand#13", "<NULL>").otherwise(F.col("p_brand")).alias("p_brand ")), f"{_shared(spark)}/part.csv")
    return load_table(spark, path)


def _shared(spark: SparkSession) -> str:
    """A new folder that driver and executors both see."""
    import uuid

    from atlasweave.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}"


@query("""WITH t(iso, lvl, label) AS (VALUES ('moz', 1, 'g3_prov'), ('moz', 2, 'g3_dist'), ('moz', 3, 'g3_posto'), ('cod', 2, 'g3_ant'), ('cod', 4, 'g3_as'), ('nga', 3, 'g3_ward')),
n AS (SELECT n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN 'moz' WHEN 1 THEN 'cod' ELSE 'nga' END AS iso, CAST(n_regionkey % 4 + 1 AS INT) AS lvl FROM nation)
SELECT k, n.iso, n.lvl, label FROM n JOIN t ON t.iso = n.iso AND t.lvl = n.lvl""")
def admin_labels(spark, sf):
    """Labels of the countries and levels that nations ask for."""
    asked = _sql(spark, sf, "SELECT n_nationkey AS k, CASE n_nationkey % 3 WHEN 0 THEN 'moz' WHEN 1 THEN 'cod' ELSE 'nga' END AS iso, CAST(n_regionkey % 4 + 1 AS INT) AS lvl FROM nation", "nation")
    known = [(i, n, dictionaries.admin_label(i.upper(), n)) for i, n in (("moz", 1), ("moz", 2), ("moz", 3), ("cod", 2), ("cod", 4), ("nga", 3))]
    return asked.join(F.broadcast(spark.createDataFrame(known, "iso string, lvl int, label string")), ["iso", "lvl"]).select("k", "iso", "lvl", "label")


@query()
def config_pipeline(spark, sf):
    """clean and match from configuration mappings, through files."""
    from atlasweave.plans.run import run_clean, run_match

    path = _shared(spark)
    save_table(_sql(spark, sf, POI, "part").select("name", "kind", "brand"), f"{path}/in/poi.csv")
    save_table(_sql(spark, sf, TABLE, "part").select("mname", "madmin1", "madmin2", "mkind"), f"{path}/in/table.csv")
    general = {"data_source": "WHO", "poi_input_dir": f"{path}/in", "poi_input_filename": "poi.csv", "poi_output_dir": path, "country_ISO": "moz", "poi_name_field": "name", "poi_type_field": "kind", "boundary1": "brand"}
    run_clean(spark, {"about_POI_table": general, "preprocessing1": {"poi_output_extension_type": ".csv"}})
    inputs = {"it_input_dir": path, "it_input_filename": "poi_preprocessing1.csv", "it_output_dir": path, "it_output_filename": "matched.csv", "it_poi_name": "g3_hltfac", "it_admin2": "g3_prov", "it_id": "None"}
    inputs |= {"mt_input_dir": f"{path}/in", "mt_input_filename": "table.csv", "mt_output_dir": path, "mt_output_filename": "table_matched.csv", "mt_poi_name": "mname", "mt_admin2": "madmin2", "match_by_distance": "False"}
    return load_table(spark, run_match(spark, {"inputs": inputs})[0])


@query()
def pipeline_clean(spark, sf):
    config = CleanConfig("name", "moz", "WHO", "k", type="kind", boundaries={1: "brand"}, language="French", date="20240101")
    return clean(_sql(spark, sf, POI, "part"), config, DICTIONARY)


@query()
def pipeline_assess(spark, sf):
    boxes = _boxes(spark, sf)
    poi = _sql(spark, sf, f"SELECT c_custkey AS k, concat('Clinic ', c_mktsegment) AS name, c_mktsegment AS kind, concat('NATION_', CAST(c_nationkey AS STRING)) AS admin2, r_name AS admin1, {_point('c_custkey')} FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey", "customer", "nation", "region")
    poi = poi.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")})
    config = AssessConfig("k", "name", "kind", "health_facility", "admin1", "admin2", "lat", "lon", "b_admin1", "b_admin2", settlement_type="stype")
    boundary = boxes.select("bid", "ring", F.col("admin1").alias("b_admin1"), F.col("admin2").alias("b_admin2"))
    settlements = boxes.select(F.col("bid").alias("sid"), "ring", F.col("admin1").alias("stype"))
    return assess(poi, boundary, settlements, config)


def _match_config(by_distance: bool) -> MatchConfig:
    return MatchConfig("poi", "id", "mname", "pos", "admin1", "admin2", "kind", "madmin1", "madmin2", "mkind", by_distance, 500.0, ("lon", "lat"), ("mlon", "mlat"))


def _match_inputs(spark, sf) -> tuple[DataFrame, DataFrame]:
    df, other = _sql(spark, sf, INPUT, "part"), _sql(spark, sf, TABLE, "part")
    return df.withColumns({c: F.col(c).cast("double") for c in ("lat", "lon")}), other.withColumns({c: F.col(c).cast("double") for c in ("mlat", "mlon")})


@query()
def pipeline_match(spark, sf):
    return match(*_match_inputs(spark, sf), _match_config(False))[0]


@query()
def pipeline_match_distance(spark, sf):
    return match(*_match_inputs(spark, sf), _match_config(True))[0]


@query(block_match_sql("", "admin2", "madmin2", "concat_ws('_', block, cand)"))
def stream_match(spark, sf):
    path = _shared(spark)
    _sql(spark, sf, INPUT, "part").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{path}/in").schema).parquet(f"{path}/in")
    match_stream(stream, "poi", _sql(spark, sf, TABLE, "part"), "mname", "pos", ["admin2"], ["madmin2"], f"{path}/out", f"{path}/state").awaitTermination()
    return _rounded_match(spark.read.parquet(f"{path}/out"))
