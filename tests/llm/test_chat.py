import hashlib
import random

from atlasweave.llm.chat import BracketTemplate, Incremental, digests, format_conversations

TEMPLATE = BracketTemplate()


def results(turns):
    return {r["conv_id"]: r for r in digests(format_conversations(turns, TEMPLATE, lookback=3), TEMPLATE).collect()}


def test_round_trip(spark):
    r = random.Random(5)
    pieces = ["</s>", "[INST]", "[/INST]", "\\", "<", "]", "\n", "ok", " ", "", "é😀", ""]
    rows = [(c, t, r.choice(["user", "assistant", "system", "odd] role"]), "".join(r.choice(pieces) for _ in range(6))) for c in range(30) for t in range(r.randint(1, 9))]
    rows += [(99, t, "user" if t % 2 else "assistant", f"turn {t}") for t in range(500)]
    got = results(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4))
    for c in {x[0] for x in rows}:
        own = sorted(x for x in rows if x[0] == c)
        turns = "".join(f"{role}\n{text}\n" for _, _, role, text in own)
        loss = "".join(text for _, _, role, text in own if role == "assistant")
        assert got[c]["n_turns"] == len(own)
        assert got[c]["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[c]["formatted_chars"] == len(TEMPLATE([(role, text) for _, _, role, text in own]))
        assert not got[c]["rewrites"]


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (1, 0, "user", None), (None, 1, "assistant", "alone"), (2, 1, "assistant", "a" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' AS piece", "1 AS n")
    got = results(df)
    assert {k: v["n_turns"] for k, v in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"\nx\nuser\n\nuser\n\n").hexdigest()
    assert got[2]["loss_chars"] == 100_000
    assert results(df.limit(0)) == {}


def test_rewriting_templates_are_noticed():
    def only_last_thought(turns):
        return "".join(f"{r}:{t if i == len(turns) - 1 else t.split('|')[-1]};" for i, (r, t) in enumerate(turns))

    state = Incremental(only_last_thought)
    assert state.add("a", "think|say") == ("a:think|say;", 2, 11, False)
    assert state.add("b", "x")[3]
    dropping = Incremental(lambda turns: "".join("-" if r == "tool" else t for r, t in turns))
    assert dropping.add("tool", "secret") == ("-", 0, 0, False)
