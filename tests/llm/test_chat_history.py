"""Templates that depend on more history than the lookback."""

import pytest

from atlasweave.llm.chat import BracketTemplate, Incremental, format_conversations

TURNS = [("assistant" if i % 2 else "user", f"text {i}") for i in range(40)]


def numbered(turns):
    return "".join(f"{i} {role}: {text}\n" for i, (role, text) in enumerate(turns))


def alternating(turns):
    if any(a[0] == b[0] for a, b in zip(turns, turns[1:], strict=False)):
        raise ValueError("roles don't alternate")
    return numbered(turns)


def shortened(turns):
    return "".join(text if len(turns) <= 25 or i else "..." for i, (_, text) in enumerate(turns))


@pytest.mark.parametrize("template", [numbered, alternating])
def test_pieces_are_the_formatted_text(template):
    state = Incremental(template)
    pieces = [state.add(*t) for t in TURNS]
    assert "".join(p[0] for p in pieces) == template(TURNS)
    assert [p[0][p[1] : p[2]] for p in pieces] == [text for _, text in TURNS]
    assert not any(p[3] for p in pieces)


def test_late_rewrites_are_noticed():
    state = Incremental(shortened)
    assert [i for i, t in enumerate(TURNS) if state.add(*t)[3]] == [25]


def test_only_a_declared_template_gets_a_window(spark):
    assert Incremental(BracketTemplate(), 16).tail.maxlen == 16
    assert Incremental(numbered, 16).tail.maxlen is None
    # workers can't import this module
    own = lambda turns: "".join(f"{i} {role}: {text}\n" for i, (role, text) in enumerate(turns))
    df = spark.createDataFrame([(1, i, *t) for i, t in enumerate(TURNS)], "conv_id long, turn long, role string, text string")
    assert "".join(r["piece"] for r in format_conversations(df, own).orderBy("n").collect()) == numbered(TURNS)


def test_probe_characters_in_roles_and_texts():
    turns = [("user", "a  b"), ("assistant", ""), ("", ""), ("assistant", "")]
    state, plain = Incremental(BracketTemplate()), BracketTemplate()
    for turn in turns:
        piece, start, end, rewrites = state.add(*turn)
        assert (plain.unescape(piece[start:end]), rewrites) == (turn[1], False)
    repeating = lambda turns: "".join(f"<{r}|{t}|{turns[0][1]}>" for r, t in turns)
    state = Incremental(repeating)
    state.add(*turns[0])
    piece, start, end, _ = state.add(*turns[1])
    assert piece[start:end] == ""
