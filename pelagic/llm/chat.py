"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as one string and encoded once, with offsets. The spans of its turns in the string, and of the
tokens, are sorted, so that binary search finds the tokens of a turn; a token that reaches over an edge of the turn is
cut there, so that the loss covers the assistant's texts and nothing else.

Template: <|im_start|>ROLE line-break TEXT<|im_end|> line-break, turn after turn. Inside roles and texts every `<|`, with
any backslashes between, gets one backslash more; a role's backslashes and line breaks are escaped as well. Both ways
back are exact, and no text can look like a mark.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import small_batches

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)
_ROLE_BACK = re.compile(r"\\(.)")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_BACK.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Formatted(NamedTuple):
    """A rendered conversation: its string, token ids, and the part of each token that is under the loss."""

    text: str
    ids: list[int]
    loss_start: np.ndarray
    loss_end: np.ndarray

    def loss_text(self) -> str:
        """The text under the loss, unescaped: a turn's tokens adjoin, and marks stand between turns."""
        some = self.loss_start < self.loss_end
        start, end = self.loss_start[some], self.loss_end[some]
        if not len(start):
            return ""
        new = np.flatnonzero(np.r_[True, start[1:] != end[:-1]])
        last = np.r_[new[1:], len(start)] - 1
        return "".join(unescape(self.text[a:b]) for a, b in zip(start[new].tolist(), end[last].tolist()))

    def turns(self) -> list[tuple[str, str]]:
        """Roles and texts, read back from the string."""
        return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(self.text)]


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray, np.ndarray]:
    """(the string, starts and ends of the texts under the loss)."""
    parts, at, starts, ends = [], 0, [], []
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role == LOSS_ROLE:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), np.array(starts, np.int64), np.array(ends, np.int64)


def align(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each token inside a span (empty: none), by binary search over the sorted spans.

    Tokens that share a character (its bytes are several tokens) leave it to the first of them.
    """
    begin, stop = offsets[:, 0], np.maximum.accumulate(offsets[:, 1]) if len(offsets) else offsets[:, 1]
    begin = np.maximum(begin, np.r_[0, stop[:-1]]) if len(offsets) else begin
    if not len(starts) or not len(offsets):
        return begin, begin
    span = np.minimum(np.searchsorted(ends, begin, side="right"), len(ends) - 1)  # the first that ends after the token begins
    low, high = np.maximum(begin, starts[span]), np.minimum(stop, ends[span])
    return low, np.maximum(low, high)


class ChatFormatter:
    """Renders and encodes with a byte-level BPE file to which the two marks are added as special tokens."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([AddedToken(x, special=True, normalized=False) for x in (START, END)])

    def format(self, turns: list[tuple[str, str]]) -> Formatted:
        text, starts, ends = render(turns)
        encoded = self.tokenizer.encode(text, add_special_tokens=False)
        return Formatted(text, encoded.ids, *align(np.array(encoded.offsets, np.int64).reshape(-1, 2), starts, ends))


_formatters: dict[str, ChatFormatter] = {}


def _formatter(path: str) -> ChatFormatter:
    if path not in _formatters:
        _formatters[path] = ChatFormatter(path)
    return _formatters[path]


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, list[tuple[str, str]]]]:
    """Sorted rows to conversations; one may reach over several batches."""
    turns: list[tuple[str, str]] = []
    current: object = None
    for batch in batches:
        for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "role", "text")]):
            if turns and conv != current:
                yield current, turns
                turns = []
            current = conv
            turns.append((role, text))
    if turns:
        yield current, turns


def format_chats(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """A row per conversation: conv_id, n_turns, formatted, ids, loss (per token: start and end of its part under the loss).

    Rows of a conversation are ordered by turn, then role and text, so that ties and repeated rows have one order. A null
    role or text is empty; a null conv_id is a conversation of its own; null turns come first. Other columns are not read.
    An empty table gives no rows. Only a conversation is ever held whole, as its rendering needs.
    """
    return _formatted(conversations, tokenizer_path, "n_turns long, formatted string, ids array<int>, loss_start array<int>, loss_end array<int>", _full)


def chat_digests(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_tokens, all read back from the output.

    Nulls, ties, repeated rows, empty tables and other columns as for format_chats.
    """
    return _formatted(conversations, tokenizer_path, "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long", _digest)


def _full(f: Formatted) -> tuple:
    return len(f.turns()), f.text, f.ids, f.loss_start.tolist(), f.loss_end.tolist()


def _digest(f: Formatted) -> tuple:
    turns, loss = f.turns(), f.loss_text()
    whole = hashlib.sha256()
    for role, text in turns:
        whole.update(f"{role}\n{text}\n".encode())
    return len(turns), whole.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(f.text), len(f.ids)


def _formatted(conversations: DataFrame, tokenizer_path: str, schema: str, row) -> DataFrame:
    small_batches(conversations.sparkSession)
    d = conversations.select("conv_id", "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")])
    d = d.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    kind = d.schema["conv_id"].dataType.simpleString()
    arrow = to_arrow_schema(StructType.fromDDL(f"conv_id {kind}, {schema}"))
    names = ["conv_id", *(x.split()[0] for x in schema.split(", "))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        formatter, out, size = _formatter(tokenizer_path), [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)

        for conv, turns in _conversations(batches):
            made = formatter.format(turns)
            out.append((conv, *row(made)))
            size += len(made.text)
            if len(out) >= 500 or size > 4_000_000:
                yield batch_of()
                out, size = [], 0
        if out:
            yield batch_of()

    return d.mapInArrow(run, f"conv_id {kind}, {schema}")
