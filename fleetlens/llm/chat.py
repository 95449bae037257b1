"""Chat formatting: a finite-state machine over roles and a declarative template, giving text segments with loss flags.

Method. The template says how each role's header looks, what ends a turn, and which roles bear loss. Every turn gives three
segments: header, text, end; only the text of a role that bears loss is under the mask. Inside texts the control strings and the
escape character get the escape character before them, which is undone when reading. The machine starts in `start` and follows the
role of each turn; a conversation is valid as long as every step is allowed.

Rows are dealt by conversation and sorted by turn inside a partition; both steps read them as a stream and hold one turn at a time,
so a conversation of any length takes bounded memory. (A digest of a conversation runs through its turns one after the other, so a
single conversation is never divided.)

Defined cases. NULL texts and roles are empty. Unknown roles are written with their name and make the conversation invalid. Equal
turn numbers are ordered by role, then text; NULL turns come first. NULL conversation ids are one conversation. Repeated rows stay.
Only the four columns are read.
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
    headers: dict[str, str] = field(default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: str = "### Role %s: "
    end: str = " </turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>")
    loss: tuple[str, ...] = ("assistant",)
    # state -> roles that may follow, each being the next state
    steps: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )

    @property
    def special(self) -> tuple[str, ...]:
        """What the escape character is put before: itself, the control strings, and the colon that ends a role's name."""
        return ("\\", *self.controls, ":")

    def escape(self, text: str, also: tuple[str, ...] = ()) -> str:
        return re.sub("|".join(map(re.escape, ("\\", *self.controls, *also))), lambda m: "\\" + m[0], text)

    def unescape(self, text: str) -> str:
        return re.sub(r"\\(" + "|".join(map(re.escape, self.special)) + ")", lambda m: m[1], text)

    def header(self, role: str) -> str:
        return self.headers.get(role) or self.other % self.escape(role, (":",))

    def bare(self, text: str, mark: str) -> int:
        """Where `mark` first stands in `text` without an escape character before it; -1 if nowhere."""
        for m in re.finditer(r"\\(?:" + "|".join(map(re.escape, self.special)) + ")|" + re.escape(mark), text):
            if m[0] == mark:
                return m.start()
        return -1

    def read_turn(self, turn: str) -> tuple[str, str]:
        """(role, text) of the formatted text of a turn, without its end."""
        for role, header in self.headers.items():
            if turn.startswith(header):
                return role, self.unescape(turn[len(header) :])
        before, after = self.other.split("%s")
        end = self.bare(turn, after)
        return self.unescape(turn[len(before) : end]), self.unescape(turn[end + len(after) :])


def segments(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turn_number, kind, text, loss, state_ok) in order: header, text and end of each turn."""
    ordered = (
        conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, number, ok = object(), "start", 0, True
        for batch in batches:
            out: list[list[object]] = [[] for _ in range(6)]
            for conv, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if conv != now:
                    now, state, number, ok = conv, "start", 0, True
                ok = ok and role in template.steps.get(state, ())
                state = role
                for kind, piece in (("header", template.header(role)), ("text", template.escape(text)), ("end", template.end)):
                    for column, value in zip(out, (conv, number, kind, piece, kind == "text" and role in template.loss, ok), strict=True):
                        column.append(value)
                number += 1
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["conv_id", "turn_number", "kind", "text", "loss", "state_ok"])

    return ordered.mapInArrow(run, "conv_id bigint, turn_number bigint, kind string, text string, loss boolean, state_ok boolean")


def digests(made: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, what its formatted text says when read back.

    The segments of a conversation come in order, in one partition. Only their text, joined, and their loss flags are read: turns
    are found by the control strings of the template that stand without an escape character. One turn is held at a time.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list[object]] = [[] for _ in names]

        def ready() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)
            for column in out:
                column.clear()
            return made

        def close() -> None:
            if open_:
                for column, value in zip(out, (now, turns, every.hexdigest(), chars, masked.hexdigest(), size, good), strict=True):
                    column.append(value)

        now, open_ = None, False
        for batch in batches:
            for conv, text, loss, ok in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "state_ok")), strict=True):
                if not open_ or conv != now:
                    close()
                    now, open_, pending, turns, every, masked, chars, size, good = conv, True, "", 0, hashlib.sha256(), hashlib.sha256(), 0, 0, True
                size += len(text)
                good = good and ok
                if loss:
                    plain = template.unescape(text)
                    chars += len(plain)
                    masked.update(plain.encode())
                pending += text
                while template.end in pending and (end := template.bare(pending, template.end)) >= 0:
                    role, told = template.read_turn(pending[:end])
                    every.update(f"{role}\n{told}\n".encode())
                    turns += 1
                    pending = pending[end + len(template.end) :]
            yield ready()
        close()
        yield ready()

    return made.select("conv_id", "text", "loss", "state_ok").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, valid boolean"
    )
