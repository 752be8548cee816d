"""Personal data by weak supervision, in SQL expressions only.

Candidates come from strict patterns, one for each kind, and from looser ones. Labelers vote on
each: strict pattern, gazetteer (known endings, issuers, calling codes), context (cue words before
it), shape (digit counts, checksums) and boundary. The votes of all candidates are counted by
pattern, of which there are at most 2^5 a kind; expectation-maximisation on those counts estimates
how reliable each labeler is for each kind, and its posteriors train the final classifier, a
logistic regression on the votes and on what the span itself looks like, which no labeler sees.
Strict candidates stay as they are; the classifier adds looser ones.

Spans are found by a regular expression that puts marks around its matches; the text between the
marks tells the offsets. Patterns are possessive, so texts of any length match without recursion.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import checkpointed, fresh_names, read_table, written

KINDS = ("email", "ip", "card", "phone")
OPEN, CLOSE, OTHER = "\u0001", "\u0002", "\u0003"
FOUND = "array<struct<start:int,end:int,value:string>>"
CANDIDATES = "array<struct<kind:string,start:int,end:int,strict:boolean,votes:string,looks:string>>"

#: Strict patterns. A match starts where a run of its first characters does; the lookbehind says so
#: (\G where the match before ended inside the run), which keeps long runs from being tried at
#: every position.
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Looser patterns; card also takes the strict pattern's matches of 13 to 15 digits.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\[]at[)\]] ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-]*[0-9])",
}
#: Gazetteers: what a value of the kind is known to begin or end with (fixed values).
GAZETTEER = {
    "email": r"(?i)(?:\.|dot[)\]] ?)(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|it|nl|eu|ch|at|be|pt|br|mx|ar|ca|us|au|jp)$",
    "ip": r"^(?!0|127\.|22[4-9]\.|23[0-9]\.|24[0-9]\.|25[0-5]\.)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[4-7]|6(?:011|4|5))",
    "phone": r"^(?:\+(?:1|7|2[0-9]|3[0-69]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])|\(?[2-9][0-9]{2})",
}
#: Words before a value that speak for the kind (fixed values).
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address|reach)\b[^\n]{0,24}$",
    "ip": r"(?i)\b(?:ip|host|server|address|from|login)\b[^\n]{0,24}$",
    "card": r"(?i)\b(?:card|visa|credit|debit|payment|account|number)\b[^\n]{0,24}$",
    "phone": r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|contact|number)\b[^\n]{0,24}$",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
IP_PARTS = rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"
LABELERS = ("strict", "gazetteer", "context", "shape", "boundary")
#: What a span looks like, a pattern each: length, signs inside, order of letters and digits.
LOOKS = (r"^.{12}", r"^.{17}", r"^.{25}", " ", r"[0-9]-[0-9]", r"[0-9]\.[0-9]", r"[()\[\]]", "[A-Z]", "^[+(]", r"[0-9]{6}", r"(?i)^[a-z]+[ @(\[]", "^0")


def plain(text: Column) -> Column:
    """The text with the marks' characters replaced one by one; no pattern tells them apart."""
    return F.translate(F.coalesce(text, F.lit("")), OPEN + CLOSE, OTHER + OTHER)


def matches(text: Column, pattern: str, possible: Column) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` (FOUND), by code points."""
    marked = F.when(possible, F.regexp_replace(text, pattern, OPEN + "$0" + CLOSE))

    def step(acc: Column, part: Column) -> Column:
        size = F.instr(part, CLOSE)  # 0 in the part before the first match
        span = F.struct(acc["at"].alias("start"), (acc["at"] + size - 1).cast("int").alias("end"), F.substr(part, F.lit(1), size - 1).alias("value"))
        return F.when(size == 0, F.struct((acc["at"] + F.length(part)).cast("int").alias("at"), acc["found"].alias("found"))).otherwise(
            F.struct((acc["at"] + F.length(part) - 1).cast("int").alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))
        )

    empty = F.array().cast(FOUND)
    return F.coalesce(F.aggregate(F.split(marked, OPEN), F.struct(F.lit(0).alias("at"), empty.alias("found")), step, lambda acc: acc["found"]), empty)


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(number, F.length(number) - i + 1, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def _strict(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        return F.length(digits(value)).between(16, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(8, 15)
    return F.lit(True)


def _shape(kind: str, value: Column) -> Column:
    if kind == "card":
        return F.when(F.length(digits(value)).between(13, 19), luhn(digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    if kind == "ip":
        return value.rlike(IP_PARTS)
    return ~value.rlike(r"\.\.|^[.-]")


def _candidates(text: Column, kind: str, found: Column, strict: bool) -> Column:
    """Candidates of one kind with their votes, a character a labeler."""

    def bit(c: Column) -> Column:
        return F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0")

    def vote(x: Column) -> Column:
        value = x["value"]
        before = F.substr(text, F.greatest(x["start"] - 39, F.lit(1)), F.least(x["start"], F.lit(40)))
        around = F.concat(F.substr(text, F.greatest(x["start"], F.lit(1)), F.least(x["start"], F.lit(1))), F.lit("|"), F.substr(text, x["end"] + 1, F.lit(1)))
        hard = _strict(kind, value) if strict else F.lit(False)
        votes = F.concat(bit(hard), bit(value.rlike(GAZETTEER[kind])), bit(before.rlike(CONTEXT[kind])), bit(_shape(kind, value)), bit(~around.rlike(r"[\p{L}\p{N}_]")))
        looks = F.concat(*[bit(value.rlike(pattern)) for pattern in LOOKS])
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), hard.alias("strict"), votes.alias("votes"), looks.alias("looks"))

    return F.transform(found, vote)


def candidate_spans(text: Column) -> Column:
    """All candidates of a (plain) text, by kind as in KINDS, strict ones first, then by start."""
    digit = text.rlike("[0-9]")
    possible = {"email": F.contains(text, F.lit("@")), "ip": digit & F.contains(text, F.lit(".")), "card": digit, "phone": F.contains(text, F.lit("+"))}
    loose = {"email": text.rlike(r"[(\[]at[)\]]"), "phone": digit}
    out = []
    for kind in KINDS:
        every = _candidates(text, kind, matches(text, STRICT[kind], possible[kind]), True)
        if kind == "card":  # one pass over the matches: those that fail may still be looser candidates
            every = F.filter(every, lambda c: c["strict"] | ((c["end"] - c["start"] >= 13) & (F.substr(c["votes"], F.lit(4), F.lit(1)) == "1")))
        else:
            every = F.filter(every, lambda c: c["strict"])
        out.append(every)
        if kind in LOOSE:
            out.append(_candidates(text, kind, matches(text, LOOSE[kind], loose[kind]), False))
    return F.concat(*out)


def estimate(counts: dict[tuple[str, str], int], rounds: int = 50) -> dict[tuple[str, str], float]:
    """Posterior of each (kind, votes) by expectation-maximisation, labelers taken as independent
    given the truth. Each kind has its own rate and its labelers' hit and false alarm rates, with a
    few pseudo-counts that say labelers are better than chance."""
    out = {}
    for kind in sorted({k for k, _ in counts}):
        own = {v: n for (k, v), n in counts.items() if k == kind}
        belief = {v: 0.5 + 0.45 * (v.count("1") / len(v) * 2 - 1) for v in own}
        for _ in range(rounds):
            yes = sum(n * belief[v] for v, n in own.items())
            no = sum(n * (1 - belief[v]) for v, n in own.items())
            rate = (yes + 1) / (yes + no + 2)
            hit = [(sum(n * belief[v] for v, n in own.items() if v[j] == "1") + 8) / (yes + 10) for j in range(len(LABELERS))]
            alarm = [(sum(n * (1 - belief[v]) for v, n in own.items() if v[j] == "1") + 2) / (no + 10) for j in range(len(LABELERS))]
            for v in own:
                odds = math.log(rate / (1 - rate)) + sum(math.log(h / a) if b == "1" else math.log((1 - h) / (1 - a)) for b, h, a in zip(v, hit, alarm, strict=True))
                belief[v] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        out |= {(kind, v): p for v, p in belief.items()}
    return out


def _features(kind: str, votes: str, looks: str) -> list[float]:
    return [1.0, *(1.0 if kind == k else 0.0 for k in KINDS), *(float(b) for b in votes + looks)]


def classifier(counts: dict[tuple[str, str, str], int], rounds: int = 400, step: float = 0.5) -> list[float]:
    """Weights of a logistic regression on kind, votes and looks, trained on the posteriors: every
    pattern in proportion to its count, by gradient descent."""
    by_votes: dict[tuple[str, str], int] = {}
    for (kind, votes, _), n in counts.items():
        by_votes[kind, votes] = by_votes.get((kind, votes), 0) + n
    belief, total = estimate(by_votes), sum(counts.values())
    weights = np.zeros(1 + len(KINDS) + len(LABELERS) + len(LOOKS))
    rows = sorted(counts.items())
    x = np.array([_features(*k) for k, _ in rows]).reshape(len(rows), len(weights))
    y, share = np.array([belief[k[:2]] for k, _ in rows]), np.array([n / total for _, n in rows])
    for _ in range(rounds if rows else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -40, 40)))
        weights -= step * ((share * (p - y)) @ x + 1e-4 * weights)
    return weights.tolist()


def vote_counts(candidates: DataFrame, column: str = "candidates") -> dict[tuple[str, str, str], int]:
    """How often each (kind, votes, looks) occurs: a table bounded by the patterns there are, 2^17 a
    kind, of which few hundred occur."""
    rows = candidates.select(F.explode(column).alias("c")).groupBy("c.kind", "c.votes", "c.looks").count().collect()
    return {(r["kind"], r["votes"], r["looks"]): r["count"] for r in rows}


def accepted(candidates: Column, weights: list[float], threshold: float = 0.5) -> Column:
    """Strict candidates and those that the classifier gives ``threshold`` or more, less looser
    ones that overlap a strict one of their kind."""
    strict = F.filter(candidates, lambda c: c["strict"])

    def good(c: Column) -> Column:
        score = F.lit(weights[0])
        for k, w in zip(KINDS, weights[1 : 1 + len(KINDS)], strict=True):
            score = score + F.when(c["kind"] == k, F.lit(w)).otherwise(0.0)
        bits = F.concat(c["votes"], c["looks"])
        for j, w in enumerate(weights[1 + len(KINDS) :]):
            score = score + F.substr(bits, F.lit(j + 1), F.lit(1)).cast("double") * w
        apart = ~F.exists(strict, lambda s: (s["kind"] == c["kind"]) & (s["start"] < c["end"]) & (c["start"] < s["end"]))
        return c["strict"] | (apart & (score >= math.log(threshold / (1 - threshold))))

    return F.filter(candidates, good)


def _listed(spans: Column) -> Column:
    """kind:start:end of every span, by kind as in KINDS and by start, comma-joined."""
    ranked = F.transform(spans, lambda c: F.struct(F.array_position(F.array(*map(F.lit, KINDS)), c["kind"]).alias("k"), c["start"], c["end"], c["kind"]))
    return F.array_join(F.transform(F.array_sort(ranked), lambda c: F.concat_ws(":", c["kind"], c["start"], c["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are taken from
    left to right, what is left of a later one counts as a span of its own."""
    ordered = F.array_sort(F.transform(spans, lambda c: F.struct(c["start"], c["end"], c["kind"])))

    def step(acc: Column, c: Column) -> Column:
        start = F.greatest(c["start"], acc["at"])
        out = F.concat(acc["out"], F.substr(text, acc["at"] + 1, start - acc["at"]), F.lit("["), F.upper(c["kind"]), F.lit("]"))
        return F.when(c["end"] > acc["at"], F.struct(out.alias("out"), c["end"].alias("at"))).otherwise(acc)

    rest = lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, rest))


def find_personal_data(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, candidates, found): the candidates of every whole text and those accepted.

    Null and empty texts have none; repeated rows stay; other columns are ignored; an empty table
    gives an empty result. Candidates are kept in the checkpoint folder between counting the votes
    and deciding, so texts are read once.
    """
    (clean,) = fresh_names([key], 1)
    got = checkpointed(docs.select(F.col(key), plain(F.col(text)).alias(clean)).select(key, candidate_spans(F.col(clean)).alias("candidates")))
    counts = vote_counts(got)
    return got.withColumn("found", accepted(F.col("candidates"), classifier(counts)))


def redact_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by its kind in brackets; all other columns,
    rows (repeated ones too) and null texts stay as they are; an empty table gives an empty one;
    columns may have any names.

    Candidates are found once: they are written with the documents to the checkpoint folder, by
    columns, so that counting the votes reads them alone.
    """
    clean, candidates, spans = fresh_names(docs.columns, 3)
    # each step is a column of its own, so that no expression is worked out more than once a row
    seen = written(docs.withColumn(clean, plain(F.col(text))).withColumn(candidates, candidate_spans(F.col(clean))).drop(clean))
    weights = classifier(vote_counts(seen, candidates))
    made = seen.withColumn(spans, accepted(F.col(candidates), weights)).drop(candidates)
    return made.withColumn(text, F.when(F.col(text).isNotNull(), redacted(F.col(text), F.col(spans)))).drop(spans)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find_personal_data(read_table(spark, sf_dir, "documents"))
    base = got.withColumn("base", F.filter("found", lambda c: c["strict"]))
    of = lambda kind: F.size(F.filter("base", lambda c: c["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return base.select("doc_id", *map(of, KINDS), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))
