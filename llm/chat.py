"""Conversations as template text in segments, each with a loss flag; a state machine over roles checks the order of turns."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import scratch_path

BROKEN = "broken"


@dataclass(frozen=True)
class Template:
    """What surrounds a turn, whose text counts for the loss, and which role may follow in which state.

    Marks must begin with `<|`: inside roles and texts one backslash is put between `<` and `|`, one more where some stand
    already, so no mark appears there and unescaping gives the text back.
    """

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_text: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system",
            ("start", "user"): "user",
            ("system", "user"): "user",
            ("user", "assistant"): "assistant",
            ("assistant", "user"): "user",
        }
    )
    final: tuple[str, ...] = ("assistant",)

    def move(self, state: str, role: str) -> str:
        return self.moves.get((state, role), BROKEN)


CHAT = Template()
_mark = re.compile(r"<(\\*)\|")
_escaped = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _mark.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _escaped.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


_SEGMENTS = "conv_id long, pos long, part int, segment string, loss boolean, state string"
_KINDS = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("part", pa.int32()), ("segment", pa.string()), ("loss", pa.bool_()), ("state", pa.string())])
_ABSENT = object()


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, pos, state = _ABSENT, 0, template.start
        for batch in batches:
            out = []
            for ident, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if ident != conv:
                    conv, pos, state = ident, 0, template.start
                role = role or ""
                state = template.move(state, role)
                out.append((ident, pos, 0, template.before_role + escape_role(role) + template.after_role, False, state))
                out.append((ident, pos, 1, escape(text or ""), role in template.loss_roles, state))
                out.append((ident, pos, 2, template.after_text, False, state))
                pos += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS.types)], schema=_KINDS)

    return run


def format_chat(rows: DataFrame, template: Template = CHAT, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, part, segment, loss, state): three segments for each turn, in order of (conv_id, pos, part).

    `state` is the machine's state after the turn, `broken` from the first turn out of order on; such conversations are formatted all
    the same. A null role or text is empty. Rows are taken by turn, a null turn first, equal turns by role and text; a repeated row
    is a turn of its own. Rows without a conversation id form one conversation. Only the four named columns are read, and a task holds one batch of
    turns, however long a conversation is.
    """
    turns = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    turns = turns.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "text").mapInArrow(_format(template), _SEGMENTS)


_DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, first_broken long"
_DIGEST_TYPES = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64())


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.loss, self.all = conv, 0, 0, 0
        self.turns_hash, self.loss_hash = hashlib.sha256(), hashlib.sha256()
        self.state, self.broken = "", None

    def add(self, template: Template, part: int, segment: str, loss: bool, state: str) -> None:
        self.all += len(segment)
        if part == 0:
            role = unescape_role(segment[len(template.before_role) : len(segment) - len(template.after_role)])
            self.turns_hash.update(f"{role}\n".encode("utf-8", "surrogatepass"))
            self.state = state
            if state == BROKEN and self.broken is None:
                self.broken = self.turns
        elif part == 1:
            text = unescape(segment)
            self.turns_hash.update(f"{text}\n".encode("utf-8", "surrogatepass"))
            self.turns += 1
            if loss:
                self.loss += len(text)
                self.loss_hash.update(text.encode("utf-8", "surrogatepass"))

    def row(self, template: Template) -> tuple:
        valid = self.broken is None and self.state in template.final
        return self.conv, self.turns, self.turns_hash.hexdigest(), self.loss, self.loss_hash.hexdigest(), self.all, valid, self.broken


def _digests(template: Template):
    def made(rows: list[tuple]) -> pa.RecordBatch:
        names = [x.split()[0] for x in _DIGESTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _DIGEST_TYPES)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        for batch in batches:
            for conv, part, segment, loss, state in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "segment", "loss", "state"))):
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.row(template))
                    now = _Digest(conv)
                now.add(template, part, segment, loss, state)
            if done:
                yield made(done)
                done = []
        if now is not None:
            yield made([now.row(template)])

    return run


def chat_digests(segments: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row for each conversation, from its segments alone: roles and texts unescaped, hashed in order.

    `valid` tells whether the machine ended in a final state without a turn out of order, `first_broken` the first such turn's position.
    """
    rows = segments.repartition(F.col("conv_id")).sortWithinPartitions("conv_id", "pos", "part")
    return rows.select("conv_id", "part", "segment", "loss", "state").mapInArrow(_digests(template), _DIGESTS)


def write_chat(segments: DataFrame, path: str | None = None) -> DataFrame:
    """Write segments as Parquet and read them back."""
    path = path or scratch_path(segments.sparkSession, "chat")
    segments.write.parquet(path)
    return segments.sparkSession.read.schema(segments.schema).parquet(path)
