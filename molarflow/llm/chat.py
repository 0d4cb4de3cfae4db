"""Chat formatting by a grammar round trip.

A conversation is rendered with control strings around each turn:

    user         [INST]text[/INST]
    assistant    <s>text</s>
    system       <<SYS>>text<</SYS>>
    other roles  <<ROLE:name>>text<</ROLE>>      (name percent-encoded)

The rendered text is read again by a deterministic parser: an opening string, text, the first
control string after it, which has to close that turn. The turns it gives are compared to
the source. A turn that does not come back holds conflicting content: its control strings get a
backslash after their first character (one more, if they have some), which the parser takes off
again; the text is rendered and read anew until all turns are identical. Texts without such
strings are left as they are. The loss mask covers the texts of assistant turns.

Long conversations come in pieces of about PIECE_CHARS that end with a turn; a piece parses by
itself, as every turn ends outside of any other. `start` is a piece's place in its conversation.

Scale: rows are range-partitioned by (conversation, turn), so a conversation that holds a third of
all rows is rendered by many tasks; a task holds one piece. Where a conversation crosses
partitions, its pieces' places are carried on from sums per (conversation, partition): at
most two conversations a partition, or those of several pieces. Digests of conversations that lie in
one piece are taken in place; only the pieces of the others are shuffled once more, and streamed in
order by one task each, as SHA-256 cannot be merged.

Edge cases: rows come in order of turn (null first); rows of one turn in order of a hash of role and
text; repeated rows are turns of their own; a null text is empty, a null role is the role named
by the empty string; a null conv_id is a conversation; a very long text is a piece by itself; an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from molarflow.llm.common import stored

TURN_MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE_END = "<</ROLE>>"
TRAINED = "assistant"
PIECE_CHARS = 1 << 20

_NAMED = r"</?ROLE(?::[\w.%~-]*)?>>"
CONTROL = re.compile(rf"\[/?INST\]|</?s>|<</?SYS>>|<{_NAMED}", re.A)
OPENING = re.compile(r"\[INST\]|<s>|<<SYS>>|<<ROLE:([\w.%~-]*)>>", re.A)
#: The first character of a control string that has `least` backslashes or more after it.
_AT = r"\[(?=\\{least}/?INST\])|<(?=\\{least}(?:/?s>|</?SYS>>|{named}))"
_ANY = re.compile(_AT.replace("{least}", "*").replace("{named}", _NAMED), re.A)
_ESCAPED = re.compile(_AT.replace("{least}", "+").replace("{named}", _NAMED).replace(r"\[(", r"(\[)(").replace("<(?=", r"(<)(?="), re.A)

Turn = tuple[str, str]


def escape(text: str) -> str:
    return _ANY.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    """Takes one backslash from every control string that has some."""
    if "\\" not in text:
        return text
    out, at = [], 0
    for m in _ESCAPED.finditer(text):
        out.append(text[at:m.end()])
        at = m.end() + 1
    return "".join((*out, text[at:]))


def marks(role: str) -> tuple[str, str]:
    return TURN_MARKS.get(role) or (f"<<ROLE:{quote(role, safe='')}>>", ROLE_END)


def render(turns: list[Turn], escaped: set[int]) -> str:
    out = []
    for i, (role, text) in enumerate(turns):
        opening, closing = marks(role)
        out += [opening, escape(text) if i in escaped else text, closing]
    return "".join(out)


_ROLE_OF = {opening: role for role, (opening, _) in TURN_MARKS.items()}


def parse(rendered: str) -> list[tuple[str, int, int]] | None:
    """(role, start, end) of the turns' texts as rendered; None if the text is not of the grammar."""
    found, at = [], 0
    while at < len(rendered):
        opening = OPENING.match(rendered, at)
        closing = opening and CONTROL.search(rendered, opening.end())
        if not closing:
            return None
        role = _ROLE_OF.get(opening[0])
        role = unquote(opening[1]) if role is None else role
        if closing[0] != marks(role)[1]:
            return None
        found.append((role, opening.end(), closing.start()))
        at = closing.end()
    return found


def recovered(rendered: str) -> list[Turn] | None:
    found = parse(rendered)
    return found if found is None else [(role, unescape(rendered[a:b])) for role, a, b in found]


def round_trip(turns: list[Turn]) -> str:
    """The rendered text that reads back as exactly these turns."""
    escaped: set[int] = set()
    while recovered(rendered := render(turns, escaped)) != turns:
        conflicting = {i for i, turn in enumerate(turns) if i not in escaped and recovered(render([turn], set())) != [turn]}
        if not conflicting:
            raise ValueError("turns that escaping does not tell apart")
        escaped |= conflicting
    return rendered


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
_PIECES = "conv_id bigint, whole boolean, first_turn bigint, n_turns bigint, start bigint, formatted string, " \
          "loss array<struct<start:bigint,length:bigint>>"


class _Pieces:
    """Pieces of the conversations of one partition, whose rows come in order."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.held, self.chars = [], 0
        self.conv, self.begun = None, False
        self.turns = self.at = self.seen = 0

    def add(self, conv: int | None, role: str | None, text: str | None) -> None:
        if self.begun and conv != self.conv:
            self.close(last=False)
        if not self.begun or conv != self.conv:
            self.seen += 1
            self.conv, self.begun, self.turns, self.at = conv, True, 0, 0
        elif self.chars > PIECE_CHARS:
            self.flush(False)
        self.held.append((role or "", text or ""))
        self.chars += len(text or "")

    def close(self, last: bool) -> None:
        """The conversation ends here; it may lie in other partitions too if it is the first or last one."""
        if self.held:
            self.flush(self.turns == 0 and self.seen > 1 and not last)

    def flush(self, whole: bool) -> None:
        rendered = round_trip(self.held)
        spans = [{"start": a, "length": b - a} for role, a, b in parse(rendered) if role == TRAINED]
        self.rows.append((self.conv, whole, self.turns, len(self.held), self.at, rendered, spans))
        self.turns += len(self.held)
        self.at += len(rendered)
        self.held, self.chars = [], 0

    def taken(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), _SPANS]
        names = ["conv_id", "whole", "first_turn", "n_turns", "start", "formatted", "loss"]
        out = pa.RecordBatch.from_arrays([pa.array([r[i] for r in self.rows], k) for i, k in enumerate(kinds)], names)
        self.rows = []
        return out


def _format(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv_id, role, text) in order to pieces."""
    pieces, size = _Pieces(), 0
    for b in batches:
        for conv, role, text in zip(*(c.to_pylist() for c in b.columns)):
            before = len(pieces.rows)
            pieces.add(conv, role, text)
            size += sum(len(r[5]) for r in pieces.rows[before:])
            if size > PIECE_CHARS:
                yield pieces.taken()
                size = 0
    pieces.close(last=True)
    if pieces.rows:
        yield pieces.taken()


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, place, whole, first_turn, n_turns, start, formatted, loss) from (conv_id, turn, role, text).

    `place` orders the pieces of a conversation; `whole` says that the piece surely is all of it; `first_turn`
    and `start` (code points) are where it begins in it; `loss` has the spans of `formatted` to train on."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumns({"tie": F.xxhash64("role", "text"), "row": F.monotonically_increasing_id()})
    order = ["conv_id", "turn", "tie", "row"]
    pieces = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
              .mapInArrow(_format, _PIECES).withColumn("place", F.monotonically_increasing_id()))
    pieces = stored(pieces, "pieces").withColumn("part", F.shiftright("place", 33))
    split = pieces.where("NOT whole")
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = split.groupBy("conv_id", "part").agg(F.sum("n_turns").alias("turns"), F.sum(F.length("formatted")).alias("chars"))
    carried = sums.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"),
                          F.coalesce(F.sum("turns").over(before), F.lit(0)).alias("_turns"),
                          F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("_chars"))
    moved = split.join(carried, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part"))).withColumns({
        "first_turn": F.col("first_turn") + F.col("_turns"), "start": F.col("start") + F.col("_chars")})
    names = ["conv_id", "place", "whole", "first_turn", "n_turns", "start", "formatted", "loss"]
    return pieces.where("whole").select(*names).unionByName(moved.select(*names))


_DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (conv_id, formatted, loss), those of a conversation one after the other: one row a conversation."""
    names = [f.split()[0] for f in _DIGESTS.split(", ")]
    now, state, rows = None, None, []

    def end():
        n, turns, loss_chars, loss, chars = state
        rows.append((now, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars))

    def taken():
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha" in n else pa.int64()) for n, c in zip(names, zip(*rows))], names)

    for b in batches:
        for conv, formatted, loss in zip(*(c.to_pylist() for c in b.columns)):
            if state is None or conv != now:
                if state is not None:
                    end()
                now, state = conv, [0, sha256(), 0, sha256(), 0]
            for role, text in recovered(formatted):
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(formatted[span["start"]:span["start"] + span["length"]])
                state[2] += len(text)
                state[3].update(text.encode())
            state[4] += len(formatted)
        if rows:
            yield taken()
            rows.clear()
    if state is not None:
        end()
        yield taken()


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from its pieces: number of turns, digest of the turns, length and digest
    of all text under the loss mask, length of the formatted text."""
    columns = ["conv_id", "formatted", "loss"]
    whole = pieces.where("whole").select(*columns).mapInArrow(_read, _DIGESTS)
    split = (pieces.where("NOT whole").repartition("conv_id").sortWithinPartitions("conv_id", "place").select(*columns)
             .mapInArrow(_read, _DIGESTS))
    return whole.unionByName(split)
