"""Chat formatting: conversations to text segments with loss flags.

A :class:`Template` declares, as data, the control strings around the turns
of each role, which roles are trained on, and the allowed turn order as a
finite-state machine over roles. Control strings inside a text are broken by
an escape character, so the formatted text reads back to exactly the turns it
was made from (:func:`read_back`).

Rows of one conversation are brought together by one shuffle and streamed in
turn order: a task holds one Arrow batch and the machine's state, never a
whole conversation.

Defined results: null text formats as empty; a null role reads as the empty
role name; roles outside the template use its ``other`` markers, keep their
name and are never accepted by the machine; a null turn number sorts first;
turns with equal numbers are ordered by role and text; repeated rows are
repeated turns; null conversation ids form one conversation; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import prepare

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """Markers around the text of a role, and whether the text is trained on."""

    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn]
    other: tuple[str, str, str]  # open, between role name and text, close
    order: dict[str, tuple[str, ...]]  # state -> roles that may follow; a role is its own state
    accept: tuple[str, ...]
    start: str = "start"

    def __post_init__(self):
        marks = self.marks
        if len(set(marks)) != len(marks) or not all(marks) or any(ESCAPE in m for m in marks):
            raise ValueError("control strings must be distinct, non-empty and without the escape")
        for a in marks:
            for b in marks:
                if any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) + (a != b))):
                    raise ValueError(f"control strings {a!r} and {b!r} overlap")
            if len(a) < 2:
                raise ValueError("a control string needs two characters or more")

    @property
    def marks(self) -> list[str]:
        return [m for t in self.roles.values() for m in (t.open, t.close)] + list(self.other)

    @cached_property
    def _found(self) -> re.Pattern:
        by_length = sorted(self.marks, key=len, reverse=True)
        return re.compile("|".join(map(re.escape, by_length)))

    @cached_property
    def _to_break(self) -> re.Pattern:
        return re.compile(re.escape(ESCAPE) + "|" + self._found.pattern)

    def escape(self, text: str) -> str:
        """Double every escape character and put one after the first character
        of every control string."""
        return self._to_break.sub(
            lambda m: ESCAPE * 2 if m[0] == ESCAPE else m[0][0] + ESCAPE + m[0][1:], text
        )

    @staticmethod
    def unescape(text: str) -> str:
        return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)

    def allows(self, state: str, role: str) -> bool:
        return role in self.roles and role in self.order.get(state, ())

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) segments of one turn."""
        body = self.escape(text)
        if (t := self.roles.get(role)) is not None:
            return [(t.open, False), (body, t.loss), (t.close, False)]
        a, b, c = self.other
        return [(a + self.escape(role) + b, False), (body, False), (c, False)]

    def parse(self, formatted: str) -> Iterator[tuple[str, str]]:
        """(role, text) turns of a formatted text, from its markers alone."""
        opens = {t.open: (r, t.close) for r, t in self.roles.items()}
        a, b, c = self.other
        at = 0
        while at < len(formatted):
            if not (m := self._found.match(formatted, at)):
                raise ValueError("text outside a turn")
            if m[0] == a:
                mid = self._next(formatted, m.end(), b)
                role, body, close = self.unescape(formatted[m.end():mid]), mid + len(b), c
            elif m[0] in opens:
                (role, close), body = opens[m[0]], m.end()
            else:
                raise ValueError(f"unexpected {m[0]!r}")
            end = self._next(formatted, body, close)
            yield role, self.unescape(formatted[body:end])
            at = end + len(close)

    def _next(self, formatted: str, at: int, want: str) -> int:
        m = self._found.search(formatted, at)
        if not m or m[0] != want:
            raise ValueError(f"{want!r} expected")
        return m.start()


INSTRUCT = Template(
    roles={
        "system": Turn("<<SYS>>", "<</SYS>>"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    other=("[ROLE]", "[/ROLE]", "[/OTHER]"),
    order={
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
    accept=("assistant",),
)

_SEGMENTS = pa.list_(pa.struct([("text", pa.string()), ("loss", pa.bool_())]))
FORMATTED = (
    "conv_id bigint, turn_no bigint, segments array<struct<text:string,loss:boolean>>, "
    "in_order boolean, may_end boolean"
)


def format_chats(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: conv_id, turn_no (from 0 in turn order), its text
    ``segments`` with loss flags, whether the machine allows the turn here,
    and whether it may be the last. Concatenating the segments of a
    conversation by turn_no gives its formatted text. Partitions hold whole
    conversations, ordered by conv_id and turn_no.
    """
    prepare(conversations.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
        role.alias("role"), text.alias("text"),
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, turn_no = object(), template.start, 0
        for batch in batches:
            ids, numbers, parts, allowed, may_end = [], [], [], [], []
            for c, r, t in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if c != conv:
                    conv, state, turn_no = c, template.start, 0
                ids.append(c)
                numbers.append(turn_no)
                parts.append([{"text": s, "loss": loss} for s, loss in template.segments(r, t)])
                allowed.append(template.allows(state, r))
                may_end.append(r in template.accept)
                state, turn_no = r, turn_no + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()),
                 pa.array(parts, _SEGMENTS), pa.array(allowed, pa.bool_()),
                 pa.array(may_end, pa.bool_())],
                names=["conv_id", "turn_no", "segments", "in_order", "may_end"],
            )

    return ordered.mapInArrow(run, FORMATTED)


class _Digest:
    def __init__(self, conv):
        self.conv = conv
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.valid, self.may_end = True, False

    def add(self, template: Template, segments: list[dict], in_order: bool, may_end: bool):
        formatted = "".join(s["text"] for s in segments)
        self.formatted_chars += len(formatted)
        for role, text in template.parse(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for s in segments:
            if s["loss"]:
                text = template.unescape(s["text"])
                self.loss_chars += len(text)
                self.loss.update(text.encode())
        self.valid &= in_order
        self.may_end = may_end

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.formatted_chars, self.valid and self.may_end)


DIGEST = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
    ("valid_order", pa.bool_()),
])


def read_back(formatted: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Per conversation, what its formatted text and loss flags say: number
    and digest of the turns parsed from the markers, length and digest of the
    text under the loss mask, formatted length, and whether the turn order
    was valid. Takes the rows as :func:`format_chats` orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None

        def out(rows):
            columns = list(zip(*rows)) or [[] for _ in DIGEST]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, DIGEST)], schema=DIGEST
            )

        for batch in batches:
            done = []
            for c, segments, in_order, may_end in zip(
                *(batch.column(i).to_pylist() for i in (0, 2, 3, 4))
            ):
                if now is None or c != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(c)
                now.add(template, segments, in_order, may_end)
            if done:
                yield out(done)
        if now is not None:
            yield out([now.row()])

    return formatted.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, valid_order boolean",
    )
