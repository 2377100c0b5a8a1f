r"""Conversations as training text with a loss mask.

The template writes each turn as <|im_start|>role<|im_sep|>text<|im_end|>. The marks are tokens of
their own, so no token spans a mark. Inside roles and texts every "<|" is escaped: "<", any number
of backslashes and "|" get one backslash more, and unescaping takes it away. A text can
therefore neither end its turn nor open another.

A conversation is rendered whole and encoded once with offsets. Turn spans and token spans are both
sorted, so the tokens of a turn are found by two binary searches. Turns come to a task in order, as a
stream; a conversation of more than part_chars characters is given as several rows, cut between
turns, where no token can cross. So the longest conversation needs no more memory than one turn.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from newsloom.llm.tables import column

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PART_CHARS = 1 << 20

_ESCAPE, _UNESCAPE = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>(.*?)<\|im_sep\|>(.*?)<\|im_end\|>", re.DOTALL)


def escaped(text: str) -> str:
    return _ESCAPE.sub(r"<\\\1|", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def marked_tokenizer(path: str):
    """The tokenizer with the three marks as tokens."""
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, SEP, END)])
    return tokenizer


def rendered(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the span of each turn's text in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escaped(role)}{SEP}", escaped(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(parts), spans


def token_mask(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens lie in the spans. Tokens and spans are in order."""
    mask = np.zeros(len(starts), bool)
    if spans:
        first = np.searchsorted(ends, [a for a, _ in spans], side="right")
        last = np.searchsorted(starts, [b for _, b in spans], side="left")
        for a, b in zip(first.tolist(), last.tolist()):
            mask[a:b] = True
    return mask


SCHEMA = "conv_id long, part int, n_turns int, formatted string, ids array<int>, starts array<int>, ends array<int>, mask array<boolean>"


def formatted(
    conversations: DataFrame,
    tokenizer_path: str,
    trained_roles: tuple[str, ...] = ("assistant",),
    part_chars: int = PART_CHARS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, part, n_turns, formatted, ids, starts, ends, mask): a row for each conversation, or
    for each part of a long one, parts in order within a task. starts and ends are the tokens' code
    points in formatted; mask is true for tokens of texts of the trained roles.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one
    order and all stay. Null role and text are empty; null conv_id is a conversation of its own. An
    empty table gives an empty table. Other columns are not looked at.
    """

    def run(batches):
        tokenizer = marked_tokenizer(tokenizer_path)
        conv, part, turns, chars, any_row = None, 0, [], 0, False

        def row():
            text, spans = rendered(turns)
            found = tokenizer.encode(text, add_special_tokens=False)
            at = np.array(found.offsets, np.int32).reshape(-1, 2)
            wanted = [s for s, (role, _) in zip(spans, turns) if role in trained_roles]
            mask = token_mask(at[:, 0], at[:, 1], wanted)
            values = [conv, part, len(turns), text, found.ids, at[:, 0], at[:, 1], mask.tolist()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, _KINDS)], names=_NAMES)

        for batch in batches:
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text"))):
                if any_row and (c != conv or chars >= part_chars):
                    yield row()
                    part = part + 1 if c == conv else 0
                    turns, chars = [], 0
                conv, any_row = c, True
                turns.append((role, text))
                chars += len(text)
        if any_row:
            yield row()

    rows = conversations.select(
        column(conv_col).cast("long").alias("conv_id"),
        column(turn_col).alias("turn"),
        F.coalesce(column(role_col), F.lit("")).alias("role"),
        F.coalesce(column(text_col), F.lit("")).alias("text"),
    )
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]
_KINDS = [
    pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32()),
    pa.list_(pa.bool_()),
]


def turns_of(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    return [(unescaped(role), unescaped(body)) for role, body in _TURN.findall(text)]


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> str:
    """The text under the loss mask, unescaped: a run of masked tokens is one piece."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
    return "".join(unescaped(text[starts[a] : ends[b - 1]]) for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()))


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted(),
    read back from its text, tokens and mask. Takes the rows as they come from it, without a shuffle."""

    def run(batches):
        conv, state = None, None

        def row():
            n, turns, chars, loss, size = state
            values = [[conv], [n], [turns.hexdigest()], [chars], [loss.hexdigest()], [size]]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            for i in range(batch.num_rows):
                c, part, text = (batch.column(k)[i].as_py() for k in ("conv_id", "part", "formatted"))
                if part == 0:
                    if state is not None:
                        yield row()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                starts, ends, mask = (
                    batch.column(k)[i].values.to_numpy(zero_copy_only=False) for k in ("starts", "ends", "mask")
                )
                for role, body in turns_of(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                loss = masked_text(text, starts, ends, mask)
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(text)
        if state is not None:
            yield row()

    return parts.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
