"""Chat formatting with a grammar round trip.

Grammar of the output (one conversation is the concatenation of its turns)::

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"

A turn is rendered plainly first and read back by the parser; if role or text
differ from the source, control strings and backslash forms inside them are
escaped and the turn is rendered again. The parser always unescapes, so a
source text that merely looks escaped is caught by the same comparison. Turns
are rendered where their rows lie, in parallel; reading back follows each
conversation turn by turn over sorted rows with constant memory, so a
conversation with a third of all rows needs no more memory than any other.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

START, END = "<|im_start|>", "<|im_end|>"
TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
#: "<", any backslashes, "|": one more backslash hides it, one less shows it again.
HIDE, SHOW = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
ROLE_SHOW = re.compile(r"\\(.)")
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return HIDE.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return SHOW.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on one line: backslash and line feed are written as two characters."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return ROLE_SHOW.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(rendered: str) -> list[tuple[str, str, int, int]] | None:
    """Turns as (role, text, first and last + 1 position of the raw text); None if it isn't in the grammar."""
    turns, at = [], 0
    while at < len(rendered):
        m = TURN.match(rendered, at)
        if not m or START in m[2] or END in m[1] or START in m[1]:
            return None
        turns.append((unescape_role(m[1]), unescape(m[2]), m.start(2), m.end(2)))
        at = m.end()
    return turns


def format_turn(role: str, text: str) -> str:
    """The first rendering that reads back to exactly this turn."""
    for rendered in (render(role, text), render(role, escape(text)), render(escape_role(role), escape(text))):
        back = parse(rendered)
        if back is not None and [(r, t) for r, t, _, _ in back] == [(role, text)]:
            return rendered
    raise ValueError("a turn doesn't survive the round trip")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) rows plus ``rendered`` and the loss span inside it.

    ``loss_start``/``loss_end`` are code point positions within ``rendered``
    (null unless the role is assistant). Null role and null text count as
    empty; equal rows stay separate turns; other columns are left out; an
    empty table gives an empty result.
    """
    def work(batches):
        for batch in batches:
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            out = [format_turn(r, t) for r, t in zip(roles, texts)]
            spans = [parse(x)[0] if r == LOSS_ROLE else None for r, x in zip(roles, out)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), batch.column("role"), batch.column("text"),
                 pa.array(out, pa.string()), pa.array([s and s[2] for s in spans], pa.int64()),
                 pa.array([s and s[3] for s in spans], pa.int64())],
                names=["conv_id", "turn", "role", "text", "rendered", "loss_start", "loss_end"])

    small_batches(turns.sparkSession)
    plain = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                         F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                         F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return plain.mapInArrow(work, "conv_id long, turn long, role string, text string, rendered string, "
                                  "loss_start long, loss_end long")


class _Reader:
    """Reads a conversation's rendered turns one after the other, keeping digests only."""

    def __init__(self, conv_id):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def read(self, rendered: str) -> None:
        self.chars += len(rendered)
        for role, text, _, _ in parse(rendered):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
            if role == LOSS_ROLE:
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self):
        return (self.conv_id, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation, from the rendered text alone: turn count, digests of turns and loss text, sizes.

    Turns follow ``turn`` (null first), ties by role, then text. A null
    conv_id is one conversation.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def work(batches):
        current = None
        for batch in batches:
            done = []
            for conv, rendered in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if current is None or current.conv_id != conv:
                    if current is not None:
                        done.append(current.row())
                    current = _Reader(conv)
                current.read(rendered)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names=names)
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(current.row(), kinds)], names=names)

    parts = max(1, int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = (formatted.repartition(parts, "conv_id")
               .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
               .select("conv_id", "rendered"))
    return ordered.mapInArrow(work, schema)
