import hashlib
import random
import re

from pyspark.sql import functions as F

from atlasweave.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TRICKY = [
    "mail a@b.com_c@d.org, x@y, foo@bar_baz@site.co.uk. z..z@q-r.de-", "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 1.2.3", "\x01a@b.cd\x02 \x03 4111 1111 1111 1111 5  67",
    "4111-1111-1111-1111, 41111111111111112 4929348385146306", "+1 (017) 555-7713 +49 30 1234567) +1( +12 +123456789012345678", "é😀 +49 170 1234567 ß a@b.cd", "5500 0000 0000 0004 x4111111111111111y",
    "9" * 30_000, "1 " * 30_000, "a" * 30_000 + "@b.c", "a.b" * 10_000, "+" + "1 " * 20_000, "call (826) 555-4081 now", "write to joe (at) site (dot) com",
]


def listed(df):
    found = pii.find_personal_data(df).withColumn("b", F.filter("found", lambda c: c["strict"]))
    return [(r[0], r[1], r[2]) for r in found.select("doc_id", pii._listed(F.col("b")), pii._listed(F.col("found"))).collect()]


def test_base_spans(spark, odd, none):
    r = random.Random(9)
    noise = ["".join(r.choice("0123456789.+-@ ()ab_") for _ in range(60)) for _ in range(400)]
    docs = list(enumerate([*TRICKY, *noise]))
    text = dict(docs)
    for i, strict, every in listed(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)):
        assert strict == ",".join(base(text[i])), text[i][:100]
        assert set(base(text[i])) <= set(every.split(",")) | {""}
    assert sorted((str(i), s) for i, s, _ in listed(odd)) == sorted((str(r["doc_id"]), ",".join(base(r["text"]))) for r in odd.collect())
    assert listed(none) == []


def test_looser_spans_and_redaction(spark, odd):
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004"]
    docs = [(i, f"call me: +1 (017) 555-{1000 + i} or phone (826) 555-{2000 + i}, mail a{i}@b.com, card {cards[i % 2]}") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for i, strict, every in listed(df):
        assert set(strict.split(",")) < set(every.split(","))
        start = docs[i][1].index("(826)")
        assert f"phone:{start}:{start + 14}" in every.split(",")
    got = {r["doc_id"]: r["text"] for r in pii.redact_personal_data(df).collect()}
    assert got[3] == "call me: [PHONE] or phone [PHONE], mail [EMAIL], card [CARD]"
    same = pii.redact_personal_data(odd)
    assert same.columns == odd.columns
    assert sorted(map(str, same.collect())) == sorted(map(str, odd.collect()))


def test_estimation():
    counts = {("phone", "11111"): 900, ("phone", "01011"): 60, ("phone", "00000"): 40, ("email", "11001"): 5}
    belief = pii.estimate(counts)
    assert belief[("phone", "11111")] > 0.9 > 0.5 > belief[("phone", "00000")]
    looks = "0" * len(pii.LOOKS)
    weights = pii.classifier({(*k, looks): n for k, n in counts.items()})
    score = lambda k, v, x=looks: sum(w * f for w, f in zip(weights, pii._features(k, v, x), strict=True))
    assert score("phone", "11111") > 0 > score("phone", "00000")
    assert set(pii.classifier({})) == {0.0}
    # what spans look like counts as well: the same votes, another look
    long = "1" + looks[1:]
    taught = pii.classifier({("phone", "11111", looks): 500, ("phone", "00010", long): 500, ("phone", "01011", looks): 20, ("phone", "01011", long): 20})
    odds = lambda x: sum(w * f for w, f in zip(taught, pii._features("phone", "01011", x), strict=True))
    assert odds(looks) > odds(long)


def test_added_spans_precision_and_recall(spark):
    """Looser phones and mail addresses among numbers and phrases that only look alike."""
    r = random.Random(3)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    docs, wanted = [], set()
    for i in range(300):
        strict = f"call +1 (0{n(2)}) 555-{n(4)} or mail u{i}@site.com; "
        if i % 3 == 0:
            span = f"{r.randint(2, 9)}{n(2)}-555-{n(4)}"
            lead = strict + "my phone is "
        elif i % 3 == 1:
            span = f"joe{i} (at) mail (dot) com"
            lead = strict + "contact me at "
        else:
            span, lead = "", strict + f"sum 1{n(2)} 0{n(2)} {n(4)} and lot x1{n(2)} {n(3)} {n(4)}y "
        docs.append((i, lead + span + " end"))
        if span:
            wanted.add((i, len(lead), len(lead) + len(span)))
    added = set()
    for i, strict, every in listed(spark.createDataFrame(docs, "doc_id long, text string")):
        for x in set(every.split(",")) - set(strict.split(",")):
            added.add((i, *map(int, x.split(":")[1:])))
    right = len(added & wanted)
    assert right >= 0.95 * len(added)
    assert right >= 0.95 * len(wanted)


def test_names_that_clash(spark):
    df = spark.createDataFrame([(1, "mail a@b.com", "t", "s"), (1, None, None, None)], "doc_id long, text string, __x0 string, __X1 string")
    assert sorted(map(str, pii.redact_personal_data(df).collect())) == sorted(["Row(doc_id=1, text='mail [EMAIL]', __x0='t', __X1='s')", "Row(doc_id=1, text=None, __x0=None, __X1=None)"])


def test_no_spans_digest(spark):
    assert hashlib.sha256(b"").hexdigest() == spark.range(1).select(F.sha2(pii._listed(F.array().cast(pii.CANDIDATES)), 256)).first()[0]
