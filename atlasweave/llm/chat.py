"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Successive prefixes of a conversation are rendered
and consecutive outputs compared: what the longer one adds is the turn's span. An output that
doesn't begin with the one before shows a template that rewrites history. A second rendering, with
a probe for the turn's text, tells the turn's own text from what the template puts around it, which
gives the loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlasweave.llm.common import read_table

Turn = tuple[str, str]
#: One of these, private-use characters, stands for a turn's text while its surroundings are looked for.
PROBES = [*map(chr, range(0xE000, 0xF900)), *map(chr, range(0xF0000, 0xFFFFE))]


class BracketTemplate:
    """User turns in [INST] ... [/INST], assistant turns in <s> ... </s>, others with their role.

    A backslash goes before every backslash, "[", "]" and "<" of a text, so none of the control
    strings can stand inside one, and taking it away again gives the text back.
    """

    #: each turn is formatted by itself, whatever stands before it
    turn_local = True

    _escape = re.compile(r"[\\\[\]<]")
    _unescape = re.compile(r"\\(.)", re.DOTALL)
    _body = r"((?:[^\\\[\]<]|\\.)*+)"
    _turn = re.compile(rf"\[INST\]{_body}\[/INST\]|<s>{_body}</s>|\[ROLE {_body}\]{_body}\[/ROLE\]", re.DOTALL)

    def escape(self, text: str) -> str:
        return self._escape.sub(lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return self._unescape.sub(r"\1", text)

    def __call__(self, turns: Iterable[Turn]) -> str:
        out = []
        for role, text in turns:
            body = self.escape(text)
            if role == "user":
                out.append(f"[INST]{body}[/INST]")
            elif role == "assistant":
                out.append(f"<s>{body}</s>")
            else:
                out.append(f"[ROLE {self.escape(role)}]{body}[/ROLE]")
        return "".join(out)

    def read_back(self, formatted: str) -> list[Turn]:
        """The turns of a formatted text."""
        out, at = [], 0
        while at < len(formatted):
            m = self._turn.match(formatted, at)
            if not m:
                raise ValueError(f"no turn at {at}")
            at = m.end()
            if m[1] is not None:
                out.append(("user", self.unescape(m[1])))
            elif m[2] is not None:
                out.append(("assistant", self.unescape(m[2])))
            else:
                out.append((self.unescape(m[3]), self.unescape(m[4])))
        return out


def common_prefix(a: str, b: str) -> int:
    if b.startswith(a):
        return len(a)
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


class Incremental:
    """The spans of one conversation's turns, one turn at a time.

    Renders the whole prefix, exact for any template: memory in proportion to the conversation and
    time to its square. A template that declares itself ``turn_local`` (an attribute: its output for
    a turn depends on the first turn and on no more than ``lookback`` turns before it) gets the first
    turn and the last ``lookback`` ones from the turn on that has more before it, so a conversation
    of any length takes bounded memory and time in proportion to its turns.
    """

    def __init__(self, render: Callable[[list[Turn]], str], lookback: int = 16):
        self.render, self.lookback = render, lookback if getattr(render, "turn_local", False) else None
        self.head: list[Turn] = []
        self.tail: deque[Turn] = deque(maxlen=self.lookback)
        self.before: str | None = ""

    def add(self, role: str, text: str) -> tuple[str, int, int, bool]:
        """(what the turn adds, where its text begins and ends in that, whether history changed)."""
        prefix = self.head + list(self.tail)
        before = self.render(prefix) if self.before is None else self.before
        after = self.render([*prefix, (role, text)])
        kept = common_prefix(before, after)
        piece = after[kept:]
        mark = next(c for c in PROBES if c not in role and c not in after and c not in before)
        probed = self.render([*prefix, (role, mark)])
        probe = probed[common_prefix(before, probed) :]
        at = probe.find(mark)
        lead, trail = (at, len(probe) - at - 1) if at >= 0 else (0, 0)
        if at < 0 or lead + trail > len(piece):
            lead, trail = 0, len(piece)  # the template leaves the text out: nothing to train on
        full = len(self.tail) == self.lookback
        if not self.head:
            self.head = [(role, text)]
        else:
            self.tail.append((role, text))
        self.before = None if full else after
        return piece, lead, len(piece) - trail, kept < len(before)


PIECE = "conv_id long, n long, role string, piece string, start long, text_start int, text_end int, loss boolean, rewrites boolean"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000, chars: int = 8 << 20, text: int | None = None) -> Iterator[pa.RecordBatch]:
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += len(row[text]) if text is not None else 0
        if len(held) >= size or total >= chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_PIECES = pa.schema([("conv_id", pa.int64()), ("n", pa.int64()), ("role", pa.string()), ("piece", pa.string()), ("start", pa.int64()), ("text_start", pa.int32()), ("text_end", pa.int32()), ("loss", pa.bool_()), ("rewrites", pa.bool_())])


def format_conversations(turns: DataFrame, render: Callable[[list[Turn]], str], learned: tuple[str, ...] = ("assistant",), lookback: int = 16) -> DataFrame:
    """One row a turn, in order within each partition and conversation: ``piece`` is what the turn
    adds to the formatted text, ``start`` where, ``text_start`` and ``text_end`` where the turn's
    own (escaped) text stands in the piece, ``loss`` whether that text is trained on, ``rewrites``
    whether the template changed earlier output. The pieces of a conversation, one after another,
    are the formatted text.

    Turns are ordered by turn, then role, then text, nulls first; repeated rows are turns each; null
    roles and texts count as empty; rows with a null conversation form one of their own; other
    columns are ignored; an empty table gives an empty result. Turns are sorted by Spark (which spills)
    and read one by one; of a conversation only ``lookback`` turns are held if the template is
    ``turn_local``, else the turns so far. What is rendered depends on the turns before, so one
    conversation is one task's work, however long.
    """

    def run(batches):
        def rows():
            now, state, n, at = object(), None, 0, 0
            for conv, _, role, text in _turns(batches):
                if conv != now:
                    now, state, n, at = conv, Incremental(render, lookback), 0, 0
                role, text = role or "", text or ""
                piece, lead, end, rewrites = state.add(role, text)
                yield conv, n, role, piece, at, lead, end, role in learned, rewrites
                n, at = n + 1, at + len(piece)

        yield from _batched(rows(), _PIECES, text=3)

    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(run, PIECE)


_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("rewrites", pa.bool_())])


def digests(pieces: DataFrame, template: BracketTemplate) -> DataFrame:
    """One row a conversation, read back from the pieces of :func:`format_conversations`, which come
    in order within each partition: no shuffle stands between."""

    def run(batches):
        def rows():
            now, held = object(), None
            for conv, _, _, piece, _, lead, end, loss, rewrites in _turns(batches):
                if conv != now or held is None:
                    if held is not None:
                        yield done(now, held)
                    now, held = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for role, text in template.read_back(piece):
                    held[0] += 1
                    held[1].update(f"{role}\n{text}\n".encode())
                if loss:
                    text = template.unescape(piece[lead:end])
                    held[2] += len(text)
                    held[3].update(text.encode())
                held[4] += len(piece)
                held[5] |= rewrites
            if held is not None:
                yield done(now, held)

        def done(conv, held):
            return conv, held[0], held[1].hexdigest(), held[2], held[3].hexdigest(), held[4], held[5]

        yield from _batched(rows(), _DIGESTS)

    return pieces.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean")


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are made of control strings."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    tricky = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    template = BracketTemplate()
    return digests(format_conversations(turns.unionAll(tricky), template), template).drop("rewrites")
