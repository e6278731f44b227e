"""Conversations written as training text by a template, and read back from it.

A finite-state machine over roles says whether the turns of a conversation come in an allowed order. Each turn
becomes three segments (opener, text, closer), each with a flag that says whether the loss counts there.
Escaped texts hold no control string at all, so an opener or a closer in the output is always the template's.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmill.llm.common import text_or_empty

#: A part of a conversation is closed after the turn that brings it to so many characters.
PART_CHARS = 1_000_000


@dataclass(frozen=True)
class ChatTemplate:
    """How turns are written, which of them are learned, and which role may follow in which state.

    A turn reads ``opening`` + name + ``":\\n"`` + text + ``closing``. The control strings ``opening.strip()`` and
    ``closing.strip()`` are kept out of texts by a backslash and a letter for their first characters.
    A role without a name is written after ``other``. ``moves`` maps a state and a role to the next state; a role that is not
    listed there leads to ``failed`` for good.
    """

    names: Mapping[str, str] = field(
        default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"}
    )
    other: str = "Role "
    opening: str = "### "
    closing: str = "</turn>\n"
    learned: frozenset[str] = frozenset({"assistant"})
    begin: str = "begin"
    moves: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "begin": {"system": "told", "user": "asked"},
            "told": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked"},
        }
    )
    ends: frozenset[str] = frozenset({"answered"})
    failed: str = "failed"

    def __post_init__(self) -> None:
        first = [s[0] for s in self.controls]
        if len(set(first)) < 2 or any(c in "\\hln" for c in first) or self.failed in self.moves:
            raise ValueError("control strings begin with two different signs; no move leads out of the failed state")
        if self.closing.find(first[1], 1) > 0 or any(c in n for n in [*self.names.values(), self.other] for c in "\\\n" + "".join(first)):
            raise ValueError("the closing string's first sign occurs in it once; names hold no control sign")
        if any(n.startswith(self.other) for n in self.names.values()):
            raise ValueError("no name begins as those of other roles do")

    @property
    def controls(self) -> tuple[str, str]:
        return self.opening.strip(), self.closing.strip()

    def _signs(self) -> list[tuple[str, str]]:
        """Pattern of a sign that begins a control string, and the letter that stands for it."""
        return [(f"{re.escape(c[0])}(?={re.escape(c[1:])})", x) for c, x in zip(self.controls, "hl", strict=True)]

    def escaped(self, text: Column) -> Column:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        for pattern, letter in self._signs():
            out = F.regexp_replace(out, pattern, "\\\\" + letter)
        return out

    def unescape(self, text: str) -> str:
        if "\\" not in text:
            return text
        signs = {"h": self.controls[0][0], "l": self.controls[1][0], "n": "\n", "\\": "\\"}
        return re.sub(r"\\(.)", lambda m: signs[m[1]], text, flags=re.DOTALL)

    def opener(self, role: Column) -> Column:
        """The opener of a turn; other roles stand in it escaped, on one line."""
        name = F.concat(F.lit(self.other), F.replace(self.escaped(role), F.lit("\n"), F.lit("\\n")))
        for known, label in self.names.items():
            name = F.when(role == known, F.lit(label)).otherwise(name)
        return F.concat(F.lit(self.opening), name, F.lit(":\n"))

    def role_of(self, opener: str) -> str:
        """The role of an opener, given without its last line end."""
        name = opener.removeprefix(self.opening).removesuffix(":")
        known = {label: role for role, label in self.names.items()}
        return known[name] if name in known else self.unescape(name.removeprefix(self.other))

    def turns(self, formatted: str) -> Iterator[tuple[str, str]]:
        """Role and text of each turn, read from formatted text alone."""
        for turn in formatted.split(self.closing)[:-1]:
            opener, _, text = turn.partition("\n")
            yield self.role_of(opener), self.unescape(text)

    def step(self, state: str, role: str) -> str:
        return self.moves.get(state, {}).get(role, self.failed)


DEFAULT = ChatTemplate()


def segments(
    conversations: DataFrame,
    template: ChatTemplate = DEFAULT,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per turn: conv_id, turn, role, segments (array of text and loss), which is done row by row.

    A null role is the empty one, a null text is empty.
    """
    role, text = text_or_empty(role_col), text_or_empty(text_col)
    parts = [
        (template.opener(role), F.lit(False)),
        (template.escaped(text), role.isin(*template.learned)),
        (F.lit(template.closing), F.lit(False)),
    ]
    made = F.array(*[F.struct(t.alias("text"), loss.alias("loss")) for t, loss in parts])
    return conversations.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"), made.alias("segments")
    )


def format_conversations(
    conversations: DataFrame, template: ChatTemplate = DEFAULT, part_chars: int = PART_CHARS, **columns: str
) -> DataFrame:
    """Conversations as text: conv_id, part, formatted, spans, n_turns, last, valid, bad_turn.

    Turns are put in order (those of one number by role and text, those without a number first). A conversation longer
    than ``part_chars`` goes on in further parts, each of whole turns, so that no row and no task's memory grows with it.
    ``spans`` has begin, end and loss of the part's segments, in code points of the part. The last part says whether the
    machine accepts the conversation and, if it failed, at which turn (from 0). Order is not mended and no turn is left out.

    Rows without an id form one conversation, repeated rows are turns of their own, an empty table gives
    no row, and further columns are ignored. Turns are escaped where they are read. The machine and
    the order of one conversation are followed by one task, which holds one part at a time.
    """
    made = segments(conversations, template, **columns)
    id_type = made.schema["conv_id"].dataType.simpleString()
    rows = made.select("conv_id", "turn", "role", "segments.text", "segments.loss")
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", F.col("text")[1])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, now, out = pa.null(), None, _Rows()
        for batch in batches:
            kind = batch.schema.field(0).type
            ids, roles = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, role in enumerate(roles):
                if now is None or now.id != ids[i]:
                    if now is not None:
                        out.add(now.closed(template, True))
                    now = _Open(ids[i], template.begin)
                elif now.chars >= part_chars:
                    out.add(now.closed(template, False))
                now.add(batch.column(3)[i].as_py(), batch.column(4)[i].as_py(), role, template)
                if out.chars >= part_chars:
                    yield out.taken(kind)
        if now is not None:
            out.add(now.closed(template, True))
        if out.rows:
            yield out.taken(kind)

    shape = (
        f"conv_id {id_type}, part int, formatted string, spans array<struct<begin: int, end: int, loss: boolean>>, "
        "n_turns int, last boolean, valid boolean, bad_turn long"
    )
    return dealt.mapInArrow(write, shape)


def read_back(formatted: DataFrame, template: ChatTemplate = DEFAULT, arranged: bool = False) -> DataFrame:
    """What formatted conversations say: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Turns are found by the control strings alone, learned text by the spans alone. ``arranged`` says that the
    parts of each conversation stand together and in order, as :func:`format_conversations` leaves them; else they are
    sorted first. Digests need the parts one after the other, so one task reads a conversation, part by part.
    """
    id_type = formatted.schema["conv_id"].dataType.simpleString()
    rows = formatted.select("conv_id", "part", "formatted", "spans.begin", "spans.end", "spans.loss")
    if not arranged:
        rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, now, done = pa.null(), None, []
        for batch in batches:
            kind = batch.schema.field(0).type
            ids, first = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, part in enumerate(first):
                if part == 0:
                    done += [now.row()] if now else []
                    now = _Digest(ids[i])
                now.add(*(batch.column(c)[i].as_py() for c in range(2, 6)), template)
            if done:
                yield _read_rows(done, kind)
                done = []
        if now:
            yield _read_rows([now.row()], kind)

    shape = f"conv_id {id_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return rows.mapInArrow(read, shape)


class _Open:
    """The part of a conversation that is being written."""

    def __init__(self, id: object, state: str) -> None:
        self.id, self.state, self.part, self.turn, self.bad = id, state, 0, 0, None
        self._fresh()

    def _fresh(self) -> None:
        self.texts, self.spans, self.chars, self.n_turns = [], [], 0, 0

    def add(self, texts: list[str], losses: list[bool], role: str, template: ChatTemplate) -> None:
        for text, loss in zip(texts, losses, strict=True):
            self.spans.append((self.chars, self.chars + len(text), loss))
            self.chars += len(text)
        self.texts += texts
        self.state = template.step(self.state, role)
        if self.state == template.failed and self.bad is None:
            self.bad = self.turn
        self.turn, self.n_turns = self.turn + 1, self.n_turns + 1

    def closed(self, template: ChatTemplate, last: bool) -> tuple:
        valid = self.state in template.ends if last else None
        row = (self.id, self.part, "".join(self.texts), self.spans, self.n_turns, last, valid, self.bad)
        self.part += 1
        self._fresh()
        return row


class _Rows:
    """Finished parts on their way out."""

    def __init__(self) -> None:
        self.rows, self.chars = [], 0

    def add(self, row: tuple) -> None:
        self.rows.append(row)
        self.chars += len(row[2])

    def taken(self, kind: pa.DataType) -> pa.RecordBatch:
        ids, part, formatted, spans, n_turns, last, valid, bad = zip(*self.rows, strict=True)
        span = pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("loss", pa.bool_())])
        lists = [[{"begin": b, "end": e, "loss": x} for b, e, x in s] for s in spans]
        columns = {
            "conv_id": pa.array(ids, kind), "part": pa.array(part, pa.int32()), "formatted": pa.array(formatted, pa.string()),
            "spans": pa.array(lists, pa.list_(span)), "n_turns": pa.array(n_turns, pa.int32()), "last": pa.array(last, pa.bool_()),
            "valid": pa.array(valid, pa.bool_()), "bad_turn": pa.array(bad, pa.int64()),
        }
        self.rows, self.chars = [], 0
        return pa.RecordBatch.from_pydict(columns)


class _Digest:
    """Running digests of a conversation that is read back."""

    def __init__(self, id: object) -> None:
        self.id, self.n_turns, self.loss_chars, self.chars = id, 0, 0, 0
        self.turns, self.loss = sha256(), sha256()

    def add(self, formatted: str, begin: list[int], end: list[int], loss: list[bool], template: ChatTemplate) -> None:
        self.chars += len(formatted)
        for role, text in template.turns(formatted):
            self.n_turns += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        for b, e, counts in zip(begin, end, loss, strict=True):
            if counts:
                text = template.unescape(formatted[b:e])
                self.loss_chars += len(text)
                self.loss.update(text.encode())

    def row(self) -> tuple:
        return self.id, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def _read_rows(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
