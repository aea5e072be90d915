"""Chat formatting with a round trip: rendered text is parsed again and escaped until it gives the source back."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"
_LINE = "<|n|>"
LOSS_ROLE = "assistant"

_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """Put one more backslash into each ``<|``, ``<\\|``, ...: no control string is left, and ``unescape`` undoes it."""
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(role: str, text: str) -> str:
    return f"{START}{role}\n{text}{END}\n"


def parse(piece: str) -> Iterator[tuple[str, str, int, int]]:
    """Turns of a rendered text as (role, text, from, to), both unescaped; from/to is the place of the escaped text.

    Grammar: ( START role LF text END LF )*, where neither role nor text holds ``<|`` but for the line mark in a
    role. Anything else raises ValueError, so a text has one reading or none.
    """
    at = 0
    while at < len(piece):
        if not piece.startswith(START, at):
            raise ValueError(f"a turn is expected at {at}")
        line = piece.find("\n", at)
        end = piece.find("<|", line + 1)
        if line < 0 or end < 0 or not piece.startswith(END + "\n", end):
            raise ValueError(f"the turn at {at} does not end")
        role = piece[at + len(START) : line]
        if "<|" in role.replace(_LINE, ""):
            raise ValueError(f"control string in the role at {at}")
        yield unescape(role.replace(_LINE, "\n")), unescape(piece[line + 1 : end]), line + 1, end
        at = end + len(END) + 1


def _reads_back(piece: str, role: str, text: str) -> bool:
    try:
        turns = list(parse(piece))
    except ValueError:
        return False
    return [(r, t) for r, t, _, _ in turns] == [(role, text)]


def format_turn(role: str, text: str) -> tuple[str, int]:
    """The rendered turn and how often its content was escaped: as it is if that reads back, else escaped until it does."""
    shown_role, shown_text, times = role, text, 0
    while not _reads_back(piece := render(shown_role.replace("\n", _LINE) if times else shown_role, shown_text), role, text):
        shown_role, shown_text, times = escape(shown_role), escape(shown_text), times + 1
        if times > 2:
            raise ValueError("the turn cannot be rendered")
    return piece, times


_PIECE = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("piece", pa.string()), ("escapes", pa.int32())])
_DIGEST = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def format_chats(turns: DataFrame) -> DataFrame:
    """One row per turn in the order of its conversation: conv_id, place (0, 1, ...), piece, escapes.

    A conversation's formatted text is its pieces by place. Null role and text are empty; turns without a number come last; equal turn
    numbers are ordered by role and text; repeated rows are turns of their own; rows without a conv_id are one conversation;
    an empty table gives an empty result; other columns are ignored. Rows of a conversation are sorted and streamed, never held together.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, place = object(), 0
        for batch in batches:
            out = []
            for c, role, text in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
                place = place + 1 if c == conv else 0
                conv = c
                out.append((c, place, *format_turn(role, text)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), _PIECE.types, strict=True)], schema=_PIECE)

    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_last("turn"), "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(rendered, "conv_id long, place long, piece string, escapes int")


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader of the formatted text sees, one row per conversation: number of turns, digest of all turns, digest and
    length of the text under the loss mask (texts of the assistant), and the length of the formatted text.

    ``formatted`` has the pieces of a conversation in one partition in order, as ``format_chats`` gives them; digests are carried on from
    batch to batch.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None
        for batch in batches:
            done = []
            for c, piece in zip(batch["conv_id"].to_pylist(), batch["piece"].to_pylist(), strict=True):
                if c != conv or state is None:
                    if state:
                        done.append(_closed(conv, state))
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text, _, _ in parse(piece):
                    state[0] += 1
                    state[1].update(f"{role}\n{text}\n".encode())
                    if role == LOSS_ROLE:
                        state[2] += len(text)
                        state[3].update(text.encode())
                state[4] += len(piece)
            if done:
                yield _digest_rows(done)
        if state:
            yield _digest_rows([_closed(conv, state)])

    return formatted.select("conv_id", "piece").mapInArrow(digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _closed(conv: int | None, state: list) -> tuple:
    return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _DIGEST.types, strict=True)], schema=_DIGEST)


def loss_spans(formatted: DataFrame) -> DataFrame:
    """conv_id, place, start, length: where each turn's loss text stands inside its piece, in code points; only turns under the mask."""

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (c, place, start, end - start)
                for c, place, piece in zip(batch["conv_id"].to_pylist(), batch["place"].to_pylist(), batch["piece"].to_pylist(), strict=True)
                for role, _, start, end in parse(piece)
                if role == LOSS_ROLE
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)], names=["conv_id", "place", "start", "length"])

    return formatted.mapInArrow(spans, "conv_id long, place long, start long, length long")
