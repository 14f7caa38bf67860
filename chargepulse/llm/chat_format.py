"""Conversations formatted by a compiled template, and read back.

The default template marks each turn with control strings and its loss mask
covers exactly the assistant texts.  Control strings inside roles and texts
are escaped with a backslash after their first character, and backslashes are
doubled, so that the formatted text can be taken apart again.

A template that is one loop over the turns and looks at nothing but the turn
(as the default one; found from its syntax tree) is rendered turn by turn:
turns are range-partitioned by (conversation, turn, role, text), so a
conversation of very many turns is sorted and rendered by several tasks.
Chunks are numbered by task and place in it, ascending with gaps.  Any other
template needs its conversation in one task.  Either way turns stream by and
are written in chunks of at most about ``CHUNK`` characters, never inside a
turn (of other templates: a piece), so no conversation is ever held whole.

Reading back takes each chunk apart where it lies; only digests, which are
sequential by definition, need the plain turns of a conversation in one task,
where they stream by in order.

Nulls: a null text or role is empty, rows of a null conversation id form one
conversation, a null turn number comes first.  Turns of equal number are
ordered by role and text; repeated rows are repeated turns.  An empty table
gives an empty result.  Further columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chat_template import Piece, by_item, compile_template
from .common import stored

CHUNK = 1 << 20
BEGIN, END = "<|im_start|>", "<|im_end|>"
CONTROL = (BEGIN, END, "<s>", "</s>", "[INST]", "[/INST]")
TEMPLATE = (
    "{% for m in messages %}" + BEGIN + "{{ m.role | escape_line }}\n"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}" + END + "\n{% endfor %}")
_CONTROL = re.compile("|".join(map(re.escape, CONTROL)))
_UNESCAPE = re.compile(r"\\(.)", re.S)
_TURN = re.compile(re.escape(BEGIN) + r"((?:[^\\\n]|\\.)*)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def escape_line(text: str) -> str:
    return escape(text).replace("\n", "\\\n")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[1], text)


FILTERS = {"escape": escape, "escape_line": escape_line}


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, dict]]:
    for b in batches:
        for conv, role, text in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
            yield conv, {"role": role or "", "text": text or ""}


def _conversations(turns: Iterator[tuple[int | None, dict]]) -> Iterator[tuple[int | None, Iterator[dict]]]:
    """Runs of turns of one conversation, each read as it comes."""
    from itertools import groupby

    for conv, own in groupby(turns, key=lambda t: t[0]):
        yield conv, (m for _, m in own)


def _in_pieces(render) -> Callable[[Iterator[dict]], Iterator[list[Piece]]]:
    """Pieces that a chunk may end after, for templates that need the whole conversation."""
    return lambda messages: ([piece] for piece in render(messages=messages))


def _in_turns(render) -> Callable[[Iterator[dict]], Iterator[list[Piece]]]:
    """The pieces of each turn, for templates that render turn by turn."""
    return lambda messages: (list(render(messages=[m])) for m in messages)


def _render(template: str, by_turn: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        units = (_in_turns if by_turn else _in_pieces)(compile_template(template, FILTERS))
        first = TaskContext.get().partitionId() << 32 if by_turn else 0
        rows: list[tuple] = []
        held = 0

        def out() -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays([
                pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
                pa.array(cols[3], pa.list_(pa.int64()))], names=["conv_id", "chunk", "text", "loss"])

        for conv, messages in _conversations(_turns(batches)):
            number, parts, loss, size = first, [], [], 0
            for unit in units(messages):
                if parts and size + sum(len(text) for text, _ in unit) > CHUNK:
                    rows.append((conv, number, "".join(parts), loss))
                    held += size
                    number, parts, loss, size = number + 1, [], [], 0
                    if held > CHUNK:
                        yield out()
                        held = 0
                for text, generated in unit:
                    if generated:
                        loss += [size, size + len(text)]
                    parts.append(text)
                    size += len(text)
            rows.append((conv, number, "".join(parts), loss))
            held += size
            if held > CHUNK or len(rows) > 4096:
                yield out()
                held = 0
        if rows:
            yield out()
    return run


def format_conversations(turns: DataFrame, template: str = TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, chunk (ascending within a conversation), text, loss (start, end, start, end ... in
    code points of the chunk)."""
    rows = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    by_turn = by_item(template, FILTERS, "messages")
    dealt = rows.repartitionByRange("conv_id", "turn", "role", "text") if by_turn else rows.repartition("conv_id")
    return (dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
            .mapInArrow(_render(template, by_turn), "conv_id long, chunk long, text string, loss array<long>"))


_PLAIN = "conv_id long, chunk long, n_turns long, turns binary, loss_chars long, loss binary, chars long"


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def _take_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The plain turns and the text under the loss mask of each chunk."""
    rows: list[tuple] = []
    held = 0
    for b in batches:
        for conv, chunk, text, spans in zip(*(b.column(k).to_pylist() for k in range(4)), strict=True):
            loss = [unescape(text[a:z]) for a, z in zip(spans[0::2], spans[1::2], strict=True)]
            turns, at = [], 0
            while m := _TURN.match(text, at):
                turns.append(_utf8(f"{unescape(m[1])}\n{unescape(m[2])}\n"))
                at = m.end()
            if at < len(text):
                raise ValueError(f"conversation {conv}: the formatted text cannot be read back")
            rows.append((conv, chunk, len(turns), b"".join(turns), sum(map(len, loss)), _utf8("".join(loss)), len(text)))
            held += len(text)
            if held > CHUNK or len(rows) > 4096:
                yield _batch(rows, _PLAIN)
                rows.clear()
                held = 0
    if rows:
        yield _batch(rows, _PLAIN)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from itertools import groupby

    def chunks():
        for b in batches:
            yield from zip(*(b.column(k).to_pylist() for k in range(6)), strict=True)

    rows: list[tuple] = []
    for conv, own in groupby(chunks(), key=lambda r: r[0]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n, loss_chars, size = 0, 0, 0
        for _, more, said, more_loss, masked, chars in own:
            turns.update(said)
            loss.update(masked)
            n, loss_chars, size = n + more, loss_chars + more_loss, size + chars
        rows.append((conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), size))
        if len(rows) >= 4096:
            yield _batch(rows, _DIGEST)
            rows.clear()
    if rows:
        yield _batch(rows, _DIGEST)


_DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[t]) for c, (_, t) in zip(zip(*rows, strict=True), named, strict=True)],
                                      names=[n for n, _ in named])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of each conversation, from formatted chunks of the default template."""
    plain = formatted.select("conv_id", "chunk", "text", "loss").mapInArrow(_take_apart, _PLAIN)
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return (ordered.select("conv_id", "n_turns", "turns", "loss_chars", "loss", "chars")
            .mapInArrow(_digest, _DIGEST))


def format_and_read(turns: DataFrame, template: str = TEMPLATE, **kw) -> DataFrame:
    """Format all conversations, write the output, and read it back."""
    return read_back(stored(format_conversations(turns, template, **kw), "conversations"))
