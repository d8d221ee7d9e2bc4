r"""Operator 13: chat formatting by a finite-state machine over roles.

A template declares, for each role, what opens and closes its turns and whether its text counts for the loss, and
which role may follow which.  Each turn becomes segments (text, loss).  Control strings inside texts are escaped: a
string like ``[INST]`` gets a backslash behind its first character, one that has some already gets one more, so
no text can open or close a turn and the escape is undone exactly.

Segments are made by column expressions where the rows lie.  Rows then meet by conversation, sorted by turn, and
pass the machine as a stream: it checks the order of turns and reads the output back, holding one turn at a time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ._words import in_batches

START = "start"


@dataclass(frozen=True)
class Turn:
    """What stands before and behind a role's text, whether the text is learned, and the states it may follow."""

    open: str
    close: str
    loss: bool
    after: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """Turns by role; ``other`` writes the (escaped) name of any further role between ``open`` and ``named``."""

    turns: dict[str, Turn]
    other: Turn
    named: str
    last: tuple[str, ...]
    controls: tuple[str, ...]

    def escaped(self, text: Column) -> Column:
        r"""Every control string, with any backslashes behind its first character, gets one more there."""
        return reduce(lambda t, family: F.regexp_replace(t, rf"({re.escape(family[0])})(\\*(?:{family[1]}))", r"$1\\$2"), self._families(), text)

    def unescaped(self, text: str) -> str:
        return re.sub("|".join(rf"(?<={re.escape(c)})\\(?=\\*(?:{rest}))" for c, rest in self._families()), "", text)

    def _families(self) -> list[tuple[str, str]]:
        firsts = sorted({c[0] for c in self.controls})
        return [(first, "|".join(re.escape(c[1:]) for c in self.controls if c[0] == first)) for first in firsts]

    def segments(self, role: Column, text: Column) -> Column:
        """array<struct<text, loss>> of a turn: what opens it, its text, what closes it."""
        def made(open_: Column, turn: Turn) -> Column:
            return F.array(*(F.struct(t.alias("text"), F.lit(loss).alias("loss")) for t, loss in ((open_, False), (self.escaped(text), turn.loss), (F.lit(turn.close), False))))

        rest = made(F.concat(F.lit(self.other.open), self.escaped(role), F.lit(self.named)), self.other)
        return reduce(lambda found, r: F.when(role == r, made(F.lit(self.turns[r].open), self.turns[r])).otherwise(found), self.turns, rest)

    def read(self, turn: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        for role, how in self.turns.items():
            if turn.startswith(how.open):
                return role, self.unescaped(turn[len(how.open) : len(turn) - len(how.close)])
        role, _, text = turn[len(self.other.open) : len(turn) - len(self.other.close)].partition(self.named)
        return self.unescaped(role), self.unescaped(text)

    def allows(self, state: str, role: str) -> bool:
        return state in self.turns.get(role, self.other).after


#: Marks of a public chat format, and [TURN] for roles that it does not know.
TEMPLATE = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>\n\n", False, (START,)),
        "user": Turn("[INST] ", " [/INST]", False, (START, "system", "assistant")),
        "assistant": Turn("[ANS] ", " </s>", True, ("user",)),
    },
    other=Turn("[TURN] ", " [/TURN]", False, ()),
    named=" [SAYS] ",
    last=("assistant",),
    controls=("<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "[ANS]", "</s>", "[TURN]", "[SAYS]", "[/TURN]"),
)


def formatted(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """(conv_id, turn, role, segments) of every turn: its text in segments (text, loss), in the order written.

    A null role or text is an empty one; other columns are not read.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.select("conv_id", "turn", role.alias("role"), template.segments(role, text).alias("segments"))


_BACK = "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_out_of_order long, complete boolean"


class _Reader:
    """One conversation on its way through the machine: its state and its running digests."""

    def __init__(self, template: Template) -> None:
        self.template, self.state = template, START
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = self.odd = 0

    def take(self, segments: list[dict]) -> None:
        role, text = self.template.read("".join(s["text"] for s in segments))
        learned = self.template.unescaped("".join(s["text"] for s in segments if s["loss"]))
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.loss.update(learned.encode("utf-8", "surrogatepass"))
        self.n += 1
        self.loss_chars += len(learned)
        self.chars += sum(len(s["text"]) for s in segments)
        self.odd += not self.template.allows(self.state, role)
        self.state = role

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.odd, self.state in self.template.last


def _read(template: Template, schema: pa.Schema):
    """Rows of (conv_id, segments) sorted by conversation and turn; a row a conversation when its last turn is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, reader = None, None
        for batch in batches:
            done: list[tuple] = []
            for conv_id, segments in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if reader is None or conv_id != conv:
                    if reader:
                        done.append((conv, *reader.row()))
                    conv, reader = conv_id, _Reader(template)
                reader.take(segments)
            yield _batch(done, schema)
        if reader:
            yield _batch([(conv, *reader.row())], schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def read_back(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """A row a conversation of :func:`formatted`'s turns, told from their segments alone.

    n_turns; turns_sha256 of role, newline, text, newline of each; loss_chars and loss_sha256 of all text under the
    loss, unescaped; formatted_chars; n_out_of_order, turns whose role may not follow the one before; complete, whether
    the last turn may end a conversation.  Turns go by number (null first), ties by role and by a hash of what is
    written; repeated rows are turns of their own.  Rows without a conversation are one conversation, null.
    A digest over turns in order is sequential, so one conversation's turns pass one task, as a stream.
    """
    schema = StructType.fromDDL(_BACK.format(kind=turns.schema["conv_id"].dataType.simpleString()))
    keyed = turns.select("conv_id", "segments", "turn", "role", F.xxhash64("segments").alias("_h"))
    dealt = in_batches(keyed).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "_h")
    return dealt.select("conv_id", "segments").mapInArrow(_read(template, to_arrow_schema(schema)), schema)


#: The contract's conversation whose texts are made of control strings.
PROBE = -7, "</s>[INST] ok [/INST]"


def report(conversations: DataFrame) -> DataFrame:
    """The contract's rows: all conversations and the probe, formatted and read back.

    Nulls, ties and repeated rows as in :func:`read_back`; texts of any length are formatted whole, a turn at a time;
    without rows the probe alone is left.
    """
    columns = ["conv_id", "turn", "role", "text"]
    kinds = ", ".join(f"{c} {conversations.schema[c].dataType.simpleString()}" for c in columns)
    probe = conversations.sparkSession.createDataFrame([(PROBE[0], i, role, PROBE[1]) for i, role in enumerate(("user", "assistant"))], kinds)
    return read_back(formatted(conversations.select(*columns).unionByName(probe)))
