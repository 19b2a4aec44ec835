"""Chat formatting: a finite-state machine over roles, and segments with loss flags from a template.

Turns are dealt by conversation and sorted there; the machine then reads them as a stream with one state,
so memory does not grow with a conversation's length.  (A digest of a whole conversation needs its
turns in order, so one conversation is one task's stream however long it is.)

Each turn gives three segments: header, body, end.  Only bodies of the template's loss roles are under the loss
mask.  Control strings inside texts are escaped by a backslash after their ``<``, which ``unescape`` takes out again.
Conversations that break the turn order are formatted as well and flagged: ``valid`` is false from the
offending turn on, and in the last turn if the conversation may not end there.

Null text or role: empty.  Turns sort by turn (null first), role, text; repeated rows are repeated turns.
A null conv_id is a conversation of its own.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carepulse.llm import common as C


@dataclass(frozen=True)
class Template:
    """What stands around a turn, which roles are under the loss mask, and the machine over roles."""
    start: str = "<|im_start|>"
    after_role: str = "\n"
    end: str = "<|im_end|>"
    after_end: str = "\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    #: state -> role -> next state
    turns: dict = field(default_factory=lambda: {"begin": {"system": "told", "user": "asked"}, "told": {"user": "asked"}, "asked": {"assistant": "answered"}, "answered": {"user": "asked"}})
    may_end: tuple[str, ...] = ("answered",)

    def step(self, state: str, role: str) -> str:
        return self.turns.get(state, {}).get(role, "broken")


_CONTROL, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


SEGMENT = "conv_id long, turn_no long, part int, text string, loss boolean, valid boolean, last boolean"


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of every conversation, in order within their partition (conv_id, turn_no, part)."""
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    arrow = C.to_arrow(_schema(SEGMENT))

    def run(batches):
        conv, n, state, held = object(), 0, "begin", None
        for batch in batches:
            out = []
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if c != conv or n == 0:
                    if held is not None:
                        out += _turn(template, *held, True)
                    conv, n, state = c, 0, "begin"
                elif held is not None:
                    out += _turn(template, *held, False)
                state = template.step(state, role)
                held = (c, n, role, text, state)
                n += 1
            if out:
                yield _batch(out, arrow)
        if held is not None:
            yield _batch(_turn(template, *held, True), arrow)

    return C.map_arrow(rows, run, SEGMENT)


def _turn(t: Template, conv, n: int, role: str, text: str, state: str, last: bool) -> list[tuple]:
    valid = state != "broken" and (not last or state in t.may_end)
    return [(conv, n, 0, t.start + escape_role(role) + t.after_role, False, valid, False), (conv, n, 1, escape(text), role in t.loss_roles, valid, False), (conv, n, 2, t.end + t.after_end, False, valid, last)]


def _schema(ddl: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"


def digests(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """A row per conversation, parsed from the formatted text and its loss mask.

    Reads ``format_conversations``' rows in their order, as a stream; a turn's text is all it holds."""
    arrow = C.to_arrow(_schema(DIGEST))
    turn = re.compile(re.escape(template.start) + "(.*?)" + re.escape(template.after_role) + "(.*)" + re.escape(template.end) + re.escape(template.after_end), re.S)

    def run(batches):
        n = chars = loss_chars = 0
        turns, loss, text, valid = hashlib.sha256(), hashlib.sha256(), "", True
        for batch in batches:
            out = []
            for conv, part, piece, masked, ok, last in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6)), strict=True):
                text += piece
                chars += len(piece)
                valid &= ok
                if masked:
                    own = unescape(piece)
                    loss_chars += len(own)
                    loss.update(own.encode())
                if part == 2:
                    role, body = turn.fullmatch(text).groups()
                    turns.update(f"{unescape_role(role)}\n{unescape(body)}\n".encode())
                    n, text = n + 1, ""
                if last:
                    out.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, valid))
                    n = chars = loss_chars = 0
                    turns, loss, valid = hashlib.sha256(), hashlib.sha256(), True
            if out:
                yield _batch(out, arrow)

    return C.map_arrow(segments, run, DIGEST)
