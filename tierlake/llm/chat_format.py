r"""Chat formatting: a finite-state machine over roles and a declarative template.

A ``Template`` lists the segments of a turn (control strings, literals, the
role, the text), which roles' segments carry loss, and the transitions of the
role machine. ``format_turns`` streams the sorted rows of each conversation
through the machine and gives one row per turn with its text segments, a loss
flag each, and the machine's error, if the role may not follow. ``read_back``
parses such rows by the template alone and digests each conversation.

Escapes. Every control string starts with ``opener``. In texts and roles one
backslash is put before the last character of each opener (and of each opener
that already holds backslashes there), so no text contains an opener and taking
the backslash away restores it. In roles, backslashes and line feeds are escaped
before that, so that a role stays on its line.

Scale. One shuffle by conversation; a partition is sorted (Spark spills it) and
streamed, and a task holds one batch of turns whatever a conversation's length.
The digests of a conversation are sequential by definition, so a conversation
is read by one task; conversations are small against a partition.

Edge cases. A null text is empty and a null role is the empty role, which no
transition allows. Rows are ordered by turn (null first), then role and text,
so ties and repeated rows each stay as a turn and have a defined order. A null
conv_id is one conversation. A role that may not follow leaves an error; the
machine goes on from that role if it knows it. Extra columns are ignored. No
rows give no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.common import prepare

START = ""  # the machine's state before the first turn


@dataclass(frozen=True)
class Segment:
    """``kind`` is control, literal, role or text; ``loss`` names the roles whose turns train on it."""

    kind: str
    value: str = ""
    loss: frozenset = frozenset()


@dataclass(frozen=True)
class Template:
    segments: tuple[Segment, ...]
    follows: dict[str, tuple[str, ...]] = field(hash=False)  # role (or START) -> roles that may come next
    opener: str = "<|"

    def __post_init__(self):
        if any(s.kind == "control" and not s.value.startswith(self.opener) for s in self.segments):
            raise ValueError(f"a control string does not start with {self.opener!r}")
        if sorted(s.kind for s in self.segments if s.kind in ("role", "text")) != ["role", "text"]:
            raise ValueError("a turn needs one role and one text")

    def escape(self, text: str) -> str:
        head, last = map(re.escape, (self.opener[:-1], self.opener[-1]))
        return re.sub(rf"({head}\\*)({last})", r"\1\\\2", text)

    def unescape(self, text: str) -> str:
        head, last = map(re.escape, (self.opener[:-1], self.opener[-1]))
        return re.sub(rf"({head}\\*)\\({last})", r"\1\2", text)

    def escape_role(self, role: str) -> str:
        return self.escape(role.replace("\\", "\\\\").replace("\n", "\\n"))

    def unescape_role(self, text: str) -> str:
        return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], self.unescape(text))

    def turn(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn's segments: (text, loss)."""
        own = {"role": self.escape_role(role), "text": self.escape(text)}
        return [(own.get(s.kind, s.value), role in s.loss) for s in self.segments]

    def parser(self) -> re.Pattern:
        own = {"role": r"(?P<role>[^\n]*)", "text": r"(?P<text>.*?)"}
        return re.compile("".join(own.get(s.kind) or re.escape(s.value) for s in self.segments), re.DOTALL)

    def step(self, state: str, role: str) -> tuple[str, str | None]:
        """The next state, and the error if ``role`` may not come after ``state``."""
        error = None
        if role not in self.follows.get(state, ()):
            error = f"{role!r} after {state!r}" if state != START else f"{role!r} as first turn"
        return (role if role in self.follows and role != START else state), error


CHATML = Template(
    segments=(
        Segment("control", "<|im_start|>"), Segment("role"), Segment("literal", "\n"),
        Segment("text", loss=frozenset({"assistant"})),
        Segment("control", "<|im_end|>"), Segment("literal", "\n"),
    ),
    follows={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
)

SEGMENTS = "array<struct<segment: string, loss: boolean>>"
_SEGMENTS = pa.list_(pa.struct([("segment", pa.string()), ("loss", pa.bool_())]))


def _format(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, turn, role, text) sorted by conversation and turn."""
    conv, state, place = None, START, 0
    for batch in batches:
        ids, roles, texts = (batch.column(c).to_pylist() for c in (0, 2, 3))
        segments, places, errors = [], [], []
        for this, role, text in zip(ids, roles, texts):
            if (this,) != conv:
                conv, state, place = (this,), START, 0
            state, error = template.step(state, role or "")
            segments.append([{"segment": s, "loss": loss} for s, loss in template.turn(role or "", text or "")])
            places.append(place)
            errors.append(error)
            place += 1
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(places, pa.int64()), pa.array(segments, _SEGMENTS), pa.array(errors, pa.string())],
            ["conv_id", "place", "segments", "error"])


def format_turns(conversations: DataFrame, template: Template = CHATML) -> DataFrame:
    """conv_id, place (from 0), segments (segment, loss), error: one row per row of ``conversations``
    (conv_id, turn, role, text). The turns of a conversation are neighbours, in order, in one partition."""
    prepare(conversations.sparkSession)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    return (conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(partial(_format, template=template), f"conv_id {kind}, place long, segments {SEGMENTS}, error string"))


class _Digest:
    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars, self.errors, self.first = conv, 0, 0, 0, 0, None
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return (self.conv[0], self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars,
                self.errors, self.first)


def _read(batches: Iterator[pa.RecordBatch], template: Template, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    parser, digest = template.parser(), None
    for batch in batches:
        done = []
        for conv, segments, error in zip(*(batch.column(c).to_pylist() for c in (0, 2, 3))):
            if digest is None or digest.conv != (conv,):
                if digest is not None:
                    done.append(digest.row())
                digest = _Digest((conv,))
            formatted = "".join(s["segment"] for s in segments)
            turn = parser.fullmatch(formatted)
            if turn is None:
                raise ValueError(f"not a turn of the template: {formatted[:200]!r}")
            role, text = template.unescape_role(turn["role"]), template.unescape(turn["text"])
            trained = "".join(template.unescape(s["segment"]) for s in segments if s["loss"])
            digest.turns += 1
            digest.all.update(f"{role}\n{text}\n".encode())
            digest.loss.update(trained.encode())
            digest.loss_chars += len(trained)
            digest.chars += len(formatted)
            digest.errors += error is not None
            digest.first = digest.first or error
        yield _digests(done, schema)
    if digest is not None:
        yield _digests([digest.row()], schema)


def _digests(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def read_back(formatted: DataFrame, template: Template = CHATML) -> DataFrame:
    """One row per conversation of ``format_turns``' rows, as they come from it: conv_id, n_turns, turns_sha256
    (of role, line feed, text, line feed per turn), loss_chars, loss_sha256 (of the unescaped segments under the
    loss mask), formatted_chars, n_errors, first_error."""
    names = [("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
             ("formatted_chars", pa.int64()), ("n_errors", pa.int64()), ("first_error", pa.string())]
    from pyspark.sql.pandas.types import to_arrow_type

    kind = formatted.schema["conv_id"].dataType
    schema = pa.schema([("conv_id", to_arrow_type(kind)), *names])
    return formatted.mapInArrow(
        partial(_read, template=template, schema=schema),
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_errors long, first_error string")
