"""Chat formatting with a grammar round trip.

Grammar of a formatted conversation, read by one deterministic parser::

    conversation = turn*
    turn         = "### " role ":" LF body "</turn>" LF
    role         = any characters but ":", LF and "\\", those escaped by "\\"
    body         = any characters; "\\" before "\\" or "<" escapes it

A turn is rendered as it is, parsed again and compared with its source. While
they differ, the content that conflicts is escaped further: first the closing
control string ``</turn>``, then what reads as an escape (and a final backslash). Each step keeps
the earlier ones, and the last is always reversible. A turn's text is parsed from
its own start to its own end, so turns that follow each other parse into the
same turns, and every turn is checked alone.

The loss mask covers the bodies of assistant turns. Spans are offsets in code
points within the turn's text.

Turns are rendered where they lie; a conversation of any length is
never held whole. Digests of a conversation are made over its sorted turns as a stream.

Defined results: null role or text reads as empty; turns with equal numbers
follow in order of role, then text, and null numbers come first; repeated rows are
turns of their own; an empty table gives no rows. A null conv_id is a conversation like others.
Only the four named columns are read.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinelake.llm.tables import map_batches, prepare, staged

OPEN, CLOSE = "### ", "</turn>"
_ROLE_ESCAPE = re.compile(r"[\\:\n]")
_BODY_STOP = re.compile(r"\\[\\<]|</turn>")


def _body(text: str, step: int) -> str:
    """The text with 0: nothing escaped, 1: closing strings, 2: also what reads as an escape."""
    if step == 0:
        return text
    if step == 1:
        return text.replace(CLOSE, "\\" + CLOSE)
    out = re.sub(r"\\+(?=<|\Z)|\\{2,}", lambda m: "\\\\" * len(m[0]), text)
    return out.replace(CLOSE, "\\" + CLOSE)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn's text, and the start and end of its body."""
    head = OPEN + _ROLE_ESCAPE.sub(lambda m: "\\" + m[0], role) + ":\n"
    for step in range(3):
        body = _body(text, step)
        turn = head + body + CLOSE + "\n"
        if parse(turn) == [(role, text)]:
            return turn, len(head), len(head) + len(body)
    raise AssertionError("the last step is reversible")


def parse(formatted: str) -> list[tuple[str, str]] | None:
    """(role, text) of every turn; None if the text is no conversation."""
    turns, at, end = [], 0, len(formatted)
    while at < end:
        if not formatted.startswith(OPEN, at):
            return None
        role, at = [], at + len(OPEN)
        while at < end and formatted[at] not in ":\n":
            if formatted[at] == "\\":
                at += 1
            role.append(formatted[at:at + 1])
            at += 1
        if not formatted.startswith(":\n", at):
            return None
        body, at = [], at + 2
        while True:
            stop = _BODY_STOP.search(formatted, at)
            if stop is None:
                return None
            body.append(formatted[at:stop.start()])
            at = stop.end()
            if stop[0] == CLOSE:
                break
            body.append(stop[0][1])
        if formatted[at:at + 1] != "\n":
            return None
        at += 1
        turns.append(("".join(role), "".join(body)))
    return turns


FORMATTED = ("conv_id long, turn long, role string, formatted string, loss_start int, loss_end int, "
             "body_start int, source string")


def format_turns(conversations: DataFrame) -> DataFrame:
    """Every turn's formatted text, loss span (-1 where there is none), the start of its body
    and, where that is escaped, the source text. The texts of a conversation's turns in order are its formatted text."""
    prepare(conversations.sparkSession)
    c = conversations
    rows = c.select(c["conv_id"].cast("long").alias("conv_id"), c["turn"].cast("long").alias("turn"),
                    F.coalesce(c["role"].cast("string"), F.lit("")).alias("role"),
                    F.coalesce(c["text"].cast("string"), F.lit("")).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        roles = batch.column(2).to_pylist()
        made = [render(r, t) for r, t in zip(roles, batch.column(3).to_pylist())]
        given = batch.column(3).to_pylist()
        escaped = [t if m[0][m[1]:m[2]] != t else None for t, m in zip(given, made)]
        spans = [(a, b) if r == "assistant" else (-1, -1) for r, (_, a, b) in zip(roles, made)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array([m[0] for m in made], pa.string()),
             pa.array([s[0] for s in spans], pa.int32()), pa.array([s[1] for s in spans], pa.int32()),
             pa.array([m[1] for m in made], pa.int32()), pa.array(escaped, pa.string())],
            ["conv_id", "turn", "role", "formatted", "loss_start", "loss_end", "body_start", "source"])

    return map_batches(rows, run, FORMATTED)


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        self.chars += len(formatted)
        for role, text in parse(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        if start >= 0:
            masked = parse(OPEN + ":\n" + formatted[start:end] + CLOSE + "\n")[0][1]
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted turns: turns, loss text and lengths of every conversation.

    A digest of a whole conversation is sequential by its nature, so the turns of
    one conversation pass one task as a sorted stream; it holds one batch and two hash states.
    """
    plain = F.expr(f"substring(formatted, body_start + 1, length(formatted) - body_start - {len(CLOSE) + 1})")
    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.coalesce("source", plain))

    def run(batches):
        now, done = None, []
        for batch in batches:
            for conv, text, start, end in zip(*(batch.column(k).to_pylist() for k in (0, 3, 4, 5))):
                if now is None or conv != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(text, start, end)
            if len(done) >= 1000:
                yield _rows(done)
                done = []
        if now is not None:
            yield _rows([*done, now.row()])

    return rows.mapInArrow(run, DIGESTS)


def _rows(done: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)],
                                      ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256",
                                       "formatted_chars"])


def round_trip(conversations: DataFrame) -> DataFrame:
    """Format, write to the shared folder, read the output back."""
    return read_back(staged(format_turns(conversations), "formatted-chat"))


#: The probe conversation: its texts hold control strings and an escape.
PROBE = "\\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    """The conversations and conversation -7, whose texts conflict with the template."""
    probe = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)
