"""Fuzzy joins in blocks or by distance, and the resolution of duplicate matches."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlasweave.functions import geo
from atlasweave.functions.candidates import Candidates, match, match_part
from atlasweave.functions.ids import code_of, fresh_names, unique_key
from atlasweave.functions.similarity import cascade, match_merged
from atlasweave.functions.text import preclean
from atlasweave.operators.skew import joined_by_key
from atlasweave.operators.spatial import keyed_pairs
from atlasweave.operators.tables import joined_values, overlap
from atlasweave.session import spread, stored

#: Most names and most candidates that one task compares at a time.
GROUP = 2000
#: Pairs of spots that one task of a distance match measures: each brings the records of a spot.
SPOT_PAIRS = 1_000_000
MATCH = "struct<name:string,score:double,method:string,result:string>"
#: Methods of each cascade from the first to the last.
STAGES = {
    "rapid": ["identical", "levenshtein", "jaro_winkler_similarity", "fuzz_ratio", "token_ratio", "partial_ratio", "partial_token_ratio"],
    "sequence": ["identical", "fuzz_ratio", "fuzz_token_ratio", "partial_ratio"],
}


def _in_groups(names: DataFrame, size: int, mine: str, others: DataFrame) -> DataFrame:
    """Rows of a block dealt into groups of about ``size`` by hash, each copied to every group of the
    other side; ``others`` has how many those are."""
    counts = names.groupBy("block").agg(F.ceil(F.count("*") / size).alias("__n"))
    dealt = names.join(counts, "block").withColumn(mine, F.pmod(F.xxhash64("clean"), F.col("__n")).cast("int")).drop("__n")
    return dealt.join(others, "block")


def best_in_blocks(names: DataFrame, candidates: DataFrame, kind: str = "rapid", group: int = GROUP) -> DataFrame:
    """(block, clean, name, score, method, result) for each distinct ``names(block, clean)``: the best
    of ``candidates(block, clean, pos)``, ties to the least pos. Names whose block has none are left out.

    Blocks are cut into groups on both sides, so that no block, however large, meets in one task.
    A pair of groups runs the cascade up to the partial stages; of a name's groups the earliest
    stage wins, then the score, then the position. Within a pair of groups a name is scored against those
    candidates alone whose bounds, worked out for all of them at once, say that they could win. Groups that find none return their five best of
    each partial stage, which are merged to the five best of the block before the second ratio is
    taken. So this is the cascade over the whole block, however it is cut.
    """
    n_candidates = candidates.groupBy("block").agg(F.sequence(F.lit(0), F.ceil(F.count("*") / group).cast("int") - 1).alias("__g"))
    n_names = names.groupBy("block").agg(F.sequence(F.lit(0), F.ceil(F.count("*") / group).cast("int") - 1).alias("__g"))
    left = _in_groups(names.select("block", "clean"), group, "a", n_candidates).select("block", "clean", "a", F.explode("__g").alias("b"))
    right = _in_groups(candidates.select("block", "clean", "pos"), group, "b", n_names).select("block", "clean", "pos", "b", F.explode("__g").alias("a"))
    order = {m: i for i, m in enumerate(STAGES[kind])}
    left = left.join(n_candidates.select("block", (F.size("__g") > 1).alias("cut")), "block")

    def run(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        theirs = theirs.sort_values(["pos", "clean"])
        position = dict(zip(theirs["clean"], theirs["pos"], strict=True))
        listed, rows = Candidates(theirs["clean"].tolist()), []
        for block, clean, cut in zip(mine["block"], mine["clean"], mine["cut"], strict=True) if len(listed) else ():
            (name, score, method, result), top = match_part(clean, listed, kind) if cut else (match(clean, listed, kind), [])
            stage = order[method] if result == "YES" else len(order)
            rows.append((block, clean, name, score, method, result, stage, position[name]))
            # candidates for a partial stage: rows without result
            rows += [(block, clean, c, s, None, None, partial, position[c]) for partial, s, c in top]
        return pd.DataFrame(rows, columns=["block", "clean", "name", "score", "method", "result", "stage", "pos"])

    @F.pandas_udf(MATCH)
    def merged(names: pd.Series, stages: pd.Series, scores: pd.Series, places: pd.Series, listed: pd.Series) -> pd.DataFrame:
        rows = [match_merged(n, list(zip(*top, strict=True)), kind) or (None,) * 4 for n, *top in zip(names, stages, scores, places, listed, strict=True)]
        return pd.DataFrame(rows, columns=["name", "score", "method", "result"])

    schema = "block string, clean string, name string, score double, method string, result string, stage int, pos long"
    met = left.groupBy("block", "a", "b").cogroup(right.groupBy("block", "a", "b")).applyInPandas(run, schema)
    final, entry = F.col("result").isNotNull(), F.struct("stage", "score", "pos", "name")
    best = met.groupBy("block", "clean").agg(
        F.min_by(F.struct("name", "score", "method", "result"), F.when(final, F.struct("stage", -F.col("score"), "pos", "name"))).alias("m"), F.collect_list(F.when(~final, entry)).alias("t")
    )
    parts = [F.col(f"t.{f}") for f in ("stage", "score", "pos", "name")]
    late = best.withColumn("p", merged("clean", *parts))
    # a match before the partial stages, or what the partial stages of all groups find, or the best NO
    return late.select("block", "clean", F.when((F.col("m.result") == "YES") | F.col("p.result").isNull(), F.col("m")).otherwise(F.col("p")).alias("m")).select("block", "clean", "m.*")


def with_clean_values(df: DataFrame, column: str, out: str) -> DataFrame:
    """``df`` with the clean form of ``column`` as ``out``: each value is cleaned once, not each row."""
    mine, theirs, made, n = fresh_names([*df.columns, out], 4)
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    values = spread(df.groupBy(value.alias(theirs)).agg(F.count("*").alias(n)))
    joined = joined_by_key(df.withColumn(mine, value), stored(values.withColumn(made, preclean(F.col(theirs)))), {mine: theirs}, n)
    return joined.withColumn(out, F.col(made)).drop(mine, theirs, made)


def with_match_code(match: DataFrame, name: str, levels: Sequence[str], kind: str | None, cleaned: bool = False) -> DataFrame:
    """``match`` with ``<name>_cleaned``, unless that was made before, and, if missing, ``<name>_uuid`` from block, type and
    clean name."""
    out = match if cleaned else match.withColumn(f"{name}_cleaned", preclean(F.col(name)))
    if f"{name}_uuid" in out.columns:
        return out
    parts = [unique_key(levels)] if levels else []
    after = [F.col(kind), F.col(f"{name}_cleaned")] if kind and levels else [F.col(f"{name}_cleaned"), F.col(kind)] if kind else [F.col(f"{name}_cleaned")]
    text = [F.coalesce(c.cast("string"), F.lit("nan")) for c in (*parts, *after)]
    return out.withColumn(f"{name}_uuid", code_of(F.concat_ws("_", *text)))


def match_columns(name: str) -> list[str]:
    return [f"{name}_{x}" for x in ("updated", "match_name", "match_uuid", "match_result", "match_score", "match_type")]


def match_index(match: DataFrame, match_name: str, match_order: str, match_levels: Sequence[str] = (), kind: str | None = None) -> DataFrame:
    """(block, clean, uuid, pos): what a match table is to the tables that are matched with it, one row for each clean name of
    a block. Whoever matches more than one table with it should store this and use :func:`matched_with`."""
    coded = f"{match_name}_uuid" in match.columns
    keys = list(dict.fromkeys([*match_levels, match_name, *([f"{match_name}_uuid"] if coded else [kind] if kind else [])]))
    # names are cleaned after records that are alike are one
    (first,) = fresh_names(match.columns, 1)
    alike = match.groupBy(*keys).agg(F.min(F.col(match_order).cast("long")).alias(first))
    # stored, lest the filter below be asked of every record
    table = stored(with_match_code(spread(alike), match_name, match_levels, kind))
    theirs = table.select(
        (unique_key(match_levels).cast("string") if match_levels else F.lit("")).alias("block"), F.col(f"{match_name}_cleaned").alias("clean"), F.col(f"{match_name}_uuid").alias("uuid"), F.col(first).alias("pos")
    ).filter("clean <> '' and block is not null")
    # one row a uuid before they are gathered: a name that many records have is one entry
    single = theirs.groupBy("block", "clean", "uuid").agg(F.min("pos").alias("pos"))
    return single.groupBy("block", "clean").agg(joined_values(F.col("uuid"), F.col("pos")).alias("uuid"), F.min("pos").alias("pos"))


def block_match(
    df: DataFrame, name: str, match: DataFrame, match_name: str, match_order: str, level: str = "", levels: Sequence[str] = (), match_levels: Sequence[str] = (), kind: str | None = None, measure: str = "rapid"
) -> DataFrame:
    """``df`` with the six match columns of ``name``, matched within equal ``levels``.

    ``match`` needs ``match_order``, a column that orders its rows. Distinct clean names are matched
    once a block. Exactly equal names are found by a native join; only the others are scored. Rows
    whose block has no candidate get result NO with no name. Empty candidates aren't matched.
    """
    return matched_with(df, name, stored(match_index(match, match_name, match_order, match_levels, kind)), level, levels, measure)


def _asked(own: DataFrame) -> DataFrame:
    """(__fb, __fr, __n, __clean): each ``__block`` and ``__raw`` name of ``own``, in how many rows, and the clean name."""
    asked = own.groupBy(F.col("__block").alias("__fb"), F.col("__raw").alias("__fr")).agg(F.count("*").alias("__n"))
    return stored(spread(asked).withColumn("__clean", preclean(F.col("__fr"))))


def _told(own: DataFrame, asked: DataFrame, coded: DataFrame) -> DataFrame:
    """``own`` with its clean names and what was found for them in their blocks (__cb, __cc, ...)."""
    told = asked.join(coded, (F.col("__fb") == F.col("__cb")) & (F.col("__clean") == F.col("__cc")), "left").drop("__cb", "__cc")
    return joined_by_key(own, stored(told), {"__block": "__fb", "__raw": "__fr"}, "__n")


def matched_with(df: DataFrame, name: str, uuids: DataFrame, level: str = "", levels: Sequence[str] = (), measure: str = "rapid") -> DataFrame:
    """:func:`block_match` with a stored :func:`match_index`."""
    df = df.drop(*match_columns(name))
    # rows are known by what they have, each of which is cleaned once; a null block is unlike any
    block = F.coalesce(F.concat(F.lit("="), unique_key(levels).cast("string")), F.lit("")) if levels else F.lit("=")
    own = df.withColumns({"__block": block, "__raw": F.coalesce(F.col(name).cast("string"), F.lit(""))})
    asked = _asked(own)
    names = stored(asked.filter("__fb <> ''").select(F.expr("substr(__fb, 2)").alias("block"), F.col("__clean").alias("clean")).distinct())
    equal = names.join(uuids.select("block", "clean"), ["block", "clean"], "left_semi")
    same = equal.select("block", "clean", F.col("clean").alias("name"), F.lit(100.0).alias("score"), F.lit("identical").alias("method"), F.lit("YES").alias("result"))
    others = names.join(equal, ["block", "clean"], "left_anti")
    found = same.unionByName(best_in_blocks(others, uuids, measure))
    coded = found.join(uuids.select("block", F.col("clean").alias("name"), "uuid"), ["block", "name"], "left")
    coded = coded.select(F.concat(F.lit("="), "block").alias("__cb"), F.col("clean").alias("__cc"), *[F.col(c).alias(f"__{c}") for c in ("name", "score", "method", "result", "uuid")])
    joined = _told(own, asked, coded)
    label = F.concat(F.lit(f"{level}/ " if level else ""), F.col("__method"))
    result = F.coalesce(F.col("__result"), F.lit("NO"))
    columns = (F.when(result == "YES", F.col("__name")).otherwise(F.col("__clean")), F.col("__name"), F.col("__uuid"), result, F.col("__score"), label)
    made = joined.withColumns(dict(zip(match_columns(name), columns, strict=True)))
    return made.drop("__clean", "__block", "__raw", "__fb", "__fr", "__name", "__score", "__method", "__result", "__uuid")


def distance_match(
    df: DataFrame, row_id: str, name: str, point: tuple[str, str], match: DataFrame, match_name: str, match_point: tuple[str, str], match_order: str, code_columns: Sequence[str], metres: float = 250.0, measure: str = "sequence"
) -> DataFrame:
    """``df`` with the six match columns of ``name``, matched with the names within ``metres`` of each
    row; (long, lat) columns on both sides. One row a row; no candidate is NO with nothing else.

    Rows and records at one spot are folded: spots are paired, each spot with a row is a block whose
    candidates are the distinct names around it, and a name is matched once a spot. Pairs are grouped in the tasks
    that make them, so what is shuffled are spots with their records, not pairs.
    """
    df, match = spread(df).drop(*match_columns(name)), spread(match)
    table = with_clean_values(match, match_name, f"{match_name}_cleaned")
    if f"{match_name}_uuid" not in table.columns:
        table = table.withColumn(f"{match_name}_uuid", code_of(unique_key(code_columns)))
    theirs = table.select(F.col(f"{match_name}_cleaned").alias("clean"), F.col(f"{match_name}_uuid").alias("uuid"), F.col(match_order).cast("long").alias("pos"), F.col(match_point[0]).alias("__mlon"), F.col(match_point[1]).alias("__mlat")).filter("clean <> ''")
    theirs = stored(theirs.groupBy("__mlon", "__mlat", "clean", "uuid").agg(F.min("pos").alias("pos")))
    lon, lat = F.col(point[0]), F.col(point[1])
    spot = F.when(lon.isNotNull() & lat.isNotNull(), F.concat_ws(" ", lon.cast("string"), lat.cast("string")))
    own = df.withColumns({"__block": F.coalesce(spot, F.lit("")), "__raw": F.coalesce(F.col(name).cast("string"), F.lit(""))})
    asked = own.groupBy(F.col("__block").alias("__fb"), F.col("__raw").alias("__fr")).agg(F.count("*").alias("__n"), F.first(lon).alias("__lon"), F.first(lat).alias("__lat"))
    asked = stored(spread(asked).withColumn("__clean", preclean(F.col("__fr"))))
    names = stored(asked.filter("__fb <> ''").groupBy(F.col("__fb").alias("__block"), "__clean").agg(F.first("__lon").alias("__lon"), F.first("__lat").alias("__lat")))
    spots = names.groupBy("__block").agg(F.first("__lon").alias("__lon"), F.first("__lat").alias("__lat"))
    # the records of a spot travel as one list, and are told apart where the pairs are made
    places = theirs.groupBy("__mlon", "__mlat").agg(F.collect_list(F.struct("clean", "uuid", "pos")).alias("__l"))
    around, cut = keyed_pairs(spots, places, metres, ("__lon", "__lat"), ("__mlon", "__mlat"), most_pairs=SPOT_PAIRS)
    single = around.select(*cut, F.col("__block").alias("block"), F.explode("__l").alias("r")).groupBy(*cut, "block", "r.clean").agg(F.min("r.pos").alias("pos"))
    candidates = stored(single.select("block", "clean", "pos"))
    wished = names.select(F.col("__block").alias("block"), F.col("__clean").alias("clean"))
    # the few names around most spots are one list; where they are more than a group, blocks are cut
    counts = candidates.groupBy("block").agg(F.count("*").alias("n"))
    crowded = counts.filter(F.col("n") > GROUP).select("block")
    few = candidates.join(counts.filter(F.col("n") <= GROUP).select("block"), "block", "left_semi")
    listed = few.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("pos", "clean"))).alias("l"))
    # scores take long for few bytes
    matched = spread(wished.join(listed, "block")).withColumn("m", cascade(measure)(F.col("clean"), F.transform("l", lambda x: x["clean"])))
    found = matched.select("block", "clean", "m.name", "m.score", "m.method", "m.result")
    if not crowded.isEmpty():
        found = found.unionByName(best_in_blocks(wished.join(crowded, "block", "left_semi"), candidates.join(crowded, "block", "left_semi"), measure))
    found = stored(found)
    # codes are gathered for the names that were found, not for all candidates: asked around the spots once more
    wanted = found.filter("name is not null").groupBy("block").agg(F.collect_set("name").alias("__names")).join(spots, F.col("block") == F.col("__block")).select("__block", "__names", "__lon", "__lat")
    around, cut = keyed_pairs(wanted, places, metres, ("__lon", "__lat"), ("__mlon", "__mlat"), most_pairs=SPOT_PAIRS)
    records = around.select(*cut, F.col("__block").alias("block"), F.explode(F.filter("__l", lambda x: F.array_contains("__names", x["clean"]))).alias("r"))
    codes = records.groupBy(*cut, "block", "r.clean", "r.uuid").agg(F.min("r.pos").alias("pos")).groupBy(*cut, "block", "clean").agg(joined_values(F.col("uuid"), F.col("pos")).alias("uuid"))
    coded = found.join(codes.select("block", F.col("clean").alias("name"), "uuid"), ["block", "name"], "left")
    coded = coded.select(F.col("block").alias("__cb"), F.col("clean").alias("__cc"), *[F.col(c).alias(f"__{c}") for c in ("name", "score", "method", "result", "uuid")])
    joined = _told(own, asked.drop("__lon", "__lat"), coded)
    result = F.coalesce(F.col("__result"), F.lit("NO"))
    radius = int(metres) if float(metres).is_integer() else metres
    # matched or not, the name is the best candidate's
    columns = (F.col("__name"), F.col("__name"), F.col("__uuid"), result, F.col("__score"), F.concat(F.col("__method"), F.lit(f" in {radius} distance")))
    made = joined.withColumns(dict(zip(match_columns(name), columns, strict=True)))
    return made.drop("__block", "__raw", "__clean", "__fb", "__fr", "__name", "__score", "__method", "__result", "__uuid")


def resolve_by_best_match(df: DataFrame, uuid: str, row_id: str, kind: str, score: str, result: str, order: str) -> DataFrame:
    """Leaves YES only on each uuid's best rows: the best score of each method, then identical before
    others before partial ones. Rows of an id after its first that are NO are dropped.

    Maxima are aggregated before they are joined back, so a uuid with many rows is no hot group.
    """
    top = df.filter(F.col(uuid).isNotNull() & F.col(kind).isNotNull()).groupBy(F.col(uuid).alias("__u"), F.col(kind).alias("__k"), F.col(result).alias("__r")).agg(F.max(score).alias("__max"))
    one = df.join(top, (F.col(uuid) == F.col("__u")) & (F.col(kind) == F.col("__k")) & (F.col(result) == F.col("__r")), "left")
    one = one.withColumn(result, F.when(F.col(score).eqNullSafe(F.col("__max")) & F.col("__max").isNotNull(), F.col(result)).otherwise("NO")).drop("__u", "__k", "__r", "__max")
    rank = F.when(F.contains(F.col(kind), F.lit("partial")), 0).when(F.contains(F.col(kind), F.lit("identical")), 2).otherwise(1)
    ranked = stored(one.withColumn("__rank", F.coalesce(rank, F.lit(1))))
    best = ranked.filter(F.col(uuid).isNotNull()).groupBy(F.col(uuid).alias("__u"), F.col(result).alias("__r")).agg(F.max("__rank").alias("__max"))
    two = ranked.join(best, (F.col(uuid) == F.col("__u")) & (F.col(result) == F.col("__r")), "left")
    two = two.withColumn(result, F.when(F.col("__rank") == F.col("__max"), F.col(result)).otherwise("NO")).drop("__u", "__r", "__max", "__rank")
    later = F.row_number().over(Window.partitionBy(row_id).orderBy(order)) > 1
    return two.withColumn("__later", later).filter(~(F.col("__later") & (F.col(result) == "NO"))).drop("__later")


def resolve_by_attribute(df: DataFrame, row_id: str, uuid: str, part: str, result: str, columns: Sequence[str], match: DataFrame, match_uuid: str, match_columns_: Sequence[str], match_order: str, order: str) -> DataFrame:
    """First, of ids with more than one YES row only the parts that share most attributes stay, and
    ``uuid`` becomes those parts joined. Then, of parts with more than one YES row a single id that
    shares most leaves all rows of the other ids NO.

    Tables that several steps read are stored, so that nothing is worked out twice."""
    names = [f"__m{i}" for i in range(len(match_columns_))]
    first = match.groupBy(F.col(match_uuid).alias("__u")).agg(F.min_by(F.struct(*[F.col(c).alias(n) for c, n in zip(match_columns_, names, strict=True)]), match_order).alias("__s"))
    joined = joined_by_key(df, first.select("__u", "__s.*"), {part: "__u"})
    scored = stored(joined.withColumn("__n", overlap(columns, names)).drop("__u", *names))
    ids = scored.filter(F.col(result) == "YES").groupBy(F.col(row_id).alias("__i")).agg(F.count("*").alias("c")).filter("c > 1 and __i is not null").select("__i")
    top = scored.join(ids, F.col(row_id) == F.col("__i"), "left_semi").groupBy(F.col(row_id).alias("__i")).agg(F.max("__n").alias("__max"))
    marked = scored.join(top, F.col(row_id) == F.col("__i"), "left")
    kept = stored(marked.filter(F.col("__max").isNull() | (F.col("__n") == F.col("__max"))))
    single = kept.filter(F.col("__max").isNotNull()).groupBy(F.col("__i").alias("__j"), F.col(part).alias("__part")).agg(F.min(order).alias("__first"))
    lists = single.groupBy("__j").agg(joined_values(F.col("__part"), F.col("__first")).alias("__list"))
    one = kept.join(lists, F.col("__i") == F.col("__j"), "left").withColumn(uuid, F.coalesce("__list", uuid)).drop("__i", "__max", "__j", "__list")
    one = stored(one)
    parts = one.filter((F.col(result) == "YES") & F.col(part).isNotNull() & (F.col(part) != " ")).groupBy(F.col(part).alias("__p")).agg(F.count("*").alias("c")).filter("c > 1").select("__p")
    held = one.join(parts, F.col(part) == F.col("__p"), "left_semi").groupBy(F.col(part).alias("__p"), F.col(row_id).alias("__i")).agg(F.max("__n").alias("__n"))
    best = held.groupBy("__p").agg(F.max("__n").alias("__max"))
    level = held.join(best, "__p")
    single = level.filter("__n = __max").groupBy("__p").agg(F.count("*").alias("c")).filter("c = 1").select("__p")
    losers = level.filter("__n < __max").join(single, "__p", "left_semi").select(F.col("__i").alias("__l")).distinct()
    flagged = one.join(losers.withColumn("__lost", F.lit(True)), F.col(row_id) == F.col("__l"), "left")
    return flagged.withColumn(result, F.when(F.col("__lost"), "NO").otherwise(F.col(result))).drop("__n", "__l", "__lost")


def best_parts_by_attribute(df: DataFrame, row_id: str, uuid: str, columns: Sequence[str], match: DataFrame, match_uuid: str, match_columns_: Sequence[str], match_order: str) -> DataFrame:
    """``df`` with ``uuid``, several joined by "/", cut down to those whose first record shares most
    attributes with the row, in their order; one alone, null and unknown ones stay as they are. Rows
    with one id are taken to be alike."""
    names = [f"__m{i}" for i in range(len(match_columns_))]
    first = match.groupBy(F.col(match_uuid).alias("__u")).agg(F.min_by(F.struct(*[F.col(c).alias(n) for c, n in zip(match_columns_, names, strict=True)]), match_order).alias("__s"))
    parts = df.filter(F.contains(F.col(uuid), F.lit("/"))).select(F.col(row_id).alias("__i"), *columns, F.posexplode(F.split(uuid, "/")).alias("__at", "__part"))
    scored = parts.join(first.select("__u", "__s.*"), F.col("__part") == F.col("__u"), "left").withColumn("__n", overlap(columns, names))
    # of one row's own parts
    listed = scored.groupBy("__i").agg(F.array_sort(F.collect_set(F.struct((-F.col("__n")).alias("n"), F.col("__at").alias("at"), F.col("__part").alias("part")))).alias("__l"))
    kept = listed.select("__i", F.array_join(F.transform(F.filter("__l", lambda x: x["n"] == F.col("__l")[0]["n"]), lambda x: x["part"]), "/").alias("__best"))
    return df.join(kept, F.col(row_id) == F.col("__i"), "left").withColumn(uuid, F.coalesce("__best", uuid)).drop("__i", "__best")


def match_points(match: DataFrame, match_uuid: str, point: tuple[str, str], order: str) -> DataFrame:
    """(__u, __mlon, __mlat): the point of the first row of each uuid."""
    return match.groupBy(F.col(match_uuid).alias("__u")).agg(F.min_by(F.struct(F.col(point[0]).alias("__mlon"), F.col(point[1]).alias("__mlat")), order).alias("s")).select("__u", "s.*")


def _with_distance(df: DataFrame, part: str, point: tuple[str, str], points: DataFrame, out: str) -> DataFrame:
    joined = joined_by_key(df, points, {part: "__u"})
    return joined.withColumn(out, geo.rounded_km(F.col(point[0]), F.col(point[1]), F.col("__mlon"), F.col("__mlat"))).drop("__u", "__mlon", "__mlat")


def match_distance(df: DataFrame, part: str, point: tuple[str, str], match: DataFrame, match_uuid: str, match_point: tuple[str, str], order: str, out: str = "dist_to_match_km") -> DataFrame:
    """Km between each row and the record it is matched with."""
    return _with_distance(df, part, point, match_points(match, match_uuid, match_point, order), out)


def resolve_composite_by_distance(df: DataFrame, uuid: str, result: str, point: tuple[str, str], match: DataFrame, match_uuid: str, match_point: tuple[str, str], match_order: str, order: str, metres: float = 500.0) -> DataFrame:
    """YES rows with several uuids keep the nearest one within ``metres``, from the point of the first
    row that has the same uuids; with none near enough they become NO without uuid."""
    several = (F.col(result) == "YES") & F.contains(F.col(uuid), F.lit("/"))
    groups = df.filter(several).groupBy(F.col(uuid).alias("__g")).agg(F.min_by(F.struct(F.col(point[0]).alias("lon"), F.col(point[1]).alias("lat")), order).alias("s"))
    members = groups.select("__g", F.col("s.lon").alias("__lon"), F.col("s.lat").alias("__lat"), F.posexplode(F.split("__g", "/")).alias("__at", "__part"))
    measured = _with_distance(members, "__part", ("__lon", "__lat"), match_points(match, match_uuid, match_point, match_order), "__d")
    best = measured.groupBy("__g").agg(F.min_by(F.struct("__d", "__part"), F.struct(F.col("__d").isNull(), "__d", "__at")).alias("b"))
    joined = df.join(best, several & (F.col(uuid) == F.col("__g")), "left")
    near = F.col("b.__d") * 1000 <= metres
    return joined.withColumns({result: F.when(F.col("__g").isNotNull() & ~F.coalesce(near, F.lit(False)), "NO").otherwise(F.col(result)), uuid: F.when(F.col("__g").isNull(), F.col(uuid)).when(near, F.col("b.__part"))}).drop("__g", "b")


def resolve_by_distance(df: DataFrame, row_id: str, part: str, result: str, point: tuple[str, str], match: DataFrame, match_uuid: str, match_point: tuple[str, str], match_order: str, order: str, metres: float = 500.0) -> DataFrame:
    """First, ids with more than one YES row keep their nearest part if it is within ``metres``, and
    lose the rows of the others. Then, parts with more than one YES row keep their nearest id, if
    near enough, as YES; the other rows become NO."""
    measured = stored(match_distance(df, part, point, match, match_uuid, match_point, match_order, "__d"))
    yes = F.col(result) == "YES"
    ids = measured.filter(yes).groupBy(F.col(row_id).alias("__i")).agg(F.count("*").alias("c"), F.min_by(F.struct("__d", F.col(part).alias("p")), F.struct(F.col("__d").isNull(), "__d", order)).alias("b")).filter("c > 1")
    near = ids.filter(F.col("b.__d") * 1000 <= metres).select("__i", F.col("b.p").alias("__keep"))
    one = measured.join(near, F.col(row_id) == F.col("__i"), "left").filter(F.col("__keep").isNull() | (F.col(part) == F.col("__keep"))).drop("__i", "__keep")
    one = stored(one)
    parts = one.filter(yes & (F.col(part) != " ")).groupBy(F.col(part).alias("__p")).agg(F.count("*").alias("c"), F.min_by(F.struct("__d", F.col(row_id).alias("i")), F.struct(F.col("__d").isNull(), "__d", order)).alias("b")).filter("c > 1")
    won = parts.filter(F.col("b.__d") * 1000 <= metres).select("__p", F.col("b.i").alias("__win"))
    two = one.join(won, F.col(part) == F.col("__p"), "left")
    return two.withColumn(result, F.when(F.col("__win").isNotNull() & (F.col(row_id) != F.col("__win")), "NO").otherwise(F.col(result))).drop("__p", "__win", "__d")


def resolve_by_border_distance(df: DataFrame, row_id: str, distance: str, result: str) -> DataFrame:
    """Of an id's rows with one result, those not nearest to the border become NO; null and -1 count as 0."""
    text = F.coalesce(F.col(distance).cast("string"), F.lit("0"))
    value = df.withColumn("__d", F.when(text.isin("-1", "-1.0"), F.lit(0.0)).otherwise(text.try_cast("double")))
    least = value.groupBy(F.col(row_id).alias("__i"), F.col(result).alias("__r")).agg(F.min("__d").alias("__min"))
    joined = value.join(least, (F.col(row_id) == F.col("__i")) & (F.col(result) == F.col("__r")), "left")
    return joined.withColumn(result, F.when(F.col("__d") == F.col("__min"), F.col(result)).otherwise("NO")).withColumn(distance, F.col("__d")).drop("__d", "__i", "__r", "__min")


def with_is_match(match: DataFrame, match_uuid: str, matched: DataFrame, part: str, result: str) -> DataFrame:
    """``match`` with ismatch: YES on rows whose uuid some YES row has."""
    hits = matched.filter(F.col(result) == "YES").select(F.col(part).alias("__u")).filter("__u is not null").distinct().withColumn("__hit", F.lit(True))
    return match.join(hits, F.col(match_uuid) == F.col("__u"), "left").withColumn("ismatch", F.when(F.col("__hit"), "YES").otherwise("NO")).drop("__u", "__hit")


def excluded(match: DataFrame, match_uuid: str, matched: DataFrame, uuid: str, score: Column) -> DataFrame:
    """``match`` without the records that rows with ``score`` are matched with, composite ones taken apart."""
    used = matched.filter(score).select(F.explode(F.split(F.col(uuid), "/")).alias("__u")).distinct()
    return match.join(used, F.col(match_uuid) == F.col("__u"), "left_anti")
