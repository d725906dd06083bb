"""Operator 3: chat formatting by a finite-state machine over roles.

A :class:`Template` is declarative: per role an opening, a closing and whether
its text is trained on, plus the allowed role after each role.  The machine
walks a conversation's turns in order; a turn that the current state does not
allow marks the conversation ``valid = false`` from there on but is formatted
all the same.  Each turn gives text segments, each with its loss flag.

Texts may contain the template's own control strings.  ``escape`` puts the
template's escape character after the first character of each control string (and
doubles the escape character), ``unescape`` undoes it, so the formatted text
parses back in one way only.  In role names a newline becomes the escape character and
``n``, undone in the same pass.

Rows are dealt out by conversation, sorted by turn and streamed: a task holds
one batch and one conversation's state, however many turns it has.  Segments
stay one row per turn; no conversation is built as one string.

Defined results: null text is empty; a null role is the role ``unknown``, which like any
role the template does not list gets the template's generic marks and no
loss; equal turns are ordered by role, then text; a conversation id of null is
one conversation of its own; an empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``{role}`` in an opening stands for the role's (escaped) name."""

    open: str = "<|im_start|>{role}\n"
    close: str = "<|im_end|>\n"
    trained: tuple[str, ...] = ("assistant",)
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "</s>", "<s>", "[INST]", "[/INST]")
    escape_char: str = "\\"
    start: str = "start"
    #: state (the last role) -> roles that may follow
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})

    def __post_init__(self):
        for c in self.controls:
            if len(c) < 2 or self.escape_char in c or c[1] == "n" or any(c[:k] == c[-k:] for k in range(1, len(c))):
                raise ValueError(f"control string {c!r} can't be told apart once escaped")

    def escape(self, text: str) -> str:
        e = self.escape_char
        return _starts(self.controls).sub(lambda m: m[0] + e, text.replace(e, e + e))

    def unescape(self, text: str) -> str:
        e = re.escape(self.escape_char)
        return re.sub(f"{e}({e}?)", lambda m: m[1], text)

    def escape_name(self, role: str) -> str:
        return self.escape(role).replace("\n", self.escape_char + "n")

    def unescape_name(self, name: str) -> str:
        e = re.escape(self.escape_char)
        return re.sub(f"{e}({e}|n|)", lambda m: "\n" if m[1] == "n" else m[1], name)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """The turn's text segments with their loss flags."""
        return [(self.open.replace("{role}", self.escape_name(role)), False),
                (self.escape(text), role in self.trained), (self.close, False)]

    def step(self, state: str, role: str) -> tuple[str, bool]:
        """Next state, and whether the move is allowed."""
        return role, role in self.moves.get(state, ())


_PATTERNS: dict[tuple[str, ...], re.Pattern] = {}


def _starts(controls: tuple[str, ...]) -> re.Pattern:
    """First characters of control strings, overlapping ones too."""
    if controls not in _PATTERNS:
        _PATTERNS[controls] = re.compile("|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in controls))
    return _PATTERNS[controls]


SEGMENTS = "conv_id long, turn_no long, segments array<struct<text: string, loss: boolean>>, valid boolean"
_SEGMENTS = pa.schema([("conv_id", pa.int64()), ("turn_no", pa.int64()),
                       ("segments", pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))), ("valid", pa.bool_())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def format_chat(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """``conv_id, turn_no`` (0-based), ``segments, valid`` of each turn; ``valid`` says
    whether the machine has accepted the conversation up to this turn.  Rows of
    a conversation lie together, in order, in one partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, number, valid = object(), template.start, 0, True
        for b in batches:
            out = []
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if c != conv:
                    conv, state, number, valid = c, template.start, 0, True
                state, allowed = template.step(state, role)
                valid = valid and allowed
                out.append((c, number, [{"text": t, "loss": x} for t, x in template.segments(role, text)], valid))
                number += 1
            yield _batch(out, _SEGMENTS)

    ordered = (turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                            F.coalesce("role", F.lit("unknown")).alias("role"),
                            F.coalesce("text", F.lit("")).alias("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.mapInArrow(run, SEGMENTS)


def parse_turns(stream: str, template: Template) -> tuple[list[tuple[str, str]], str]:
    """Whole turns ``(role, text)`` read from formatted text, and the rest."""
    head, tail = template.open.split("{role}")
    turns, at = [], 0
    while stream.startswith(head, at):
        name_end = stream.find(tail, at + len(head))
        end = stream.find(template.close, name_end + len(tail))
        if name_end < 0 or end < 0:
            break
        role = template.unescape_name(stream[at + len(head):name_end])
        turns.append((role, template.unescape(stream[name_end + len(tail):end])))
        at = end + len(template.close)
    return turns, stream[at:]


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean")


def chat_digests(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """What the formatted text of each conversation reads back as.  Takes
    :func:`format_chat`'s rows where they lie (nothing moves again)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, s = object(), None

        def row():
            if s["rest"]:
                raise ValueError(f"conversation {conv}: formatted text does not parse")
            return (conv, s["n"], s["turns"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["all"], s["valid"])

        for b in batches:
            out = []
            for c, segs, valid in zip(*(b.column(x).to_pylist() for x in ("conv_id", "segments", "valid"))):
                if c != conv:
                    if s is not None:
                        out.append(row())
                    conv, s = c, {"n": 0, "turns": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(),
                                  "all": 0, "valid": True, "rest": ""}
                piece = "".join(x["text"] for x in segs)
                s["all"] += len(piece)
                s["valid"] = valid
                got, s["rest"] = parse_turns(s["rest"] + piece, template)
                for role, text in got:
                    s["n"] += 1
                    s["turns"].update(f"{role}\n{text}\n".encode())
                for x in segs:
                    if x["loss"]:
                        plain = template.unescape(x["text"])
                        s["chars"] += len(plain)
                        s["loss"].update(plain.encode())
            yield _batch(out, _DIGESTS)
        if s is not None:
            yield _batch([row()], _DIGESTS)

    return segments.mapInArrow(run, DIGESTS)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
_DIGESTS = pa.schema([(name, _ARROW[kind]) for name, kind in (x.split() for x in DIGESTS.split(", "))])
