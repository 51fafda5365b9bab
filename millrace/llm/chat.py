"""Conversations to one training text each, assembled by columns of bytes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.text import buffers

START, END = b"<|im_start|>", b"<|im_end|>"
_TURN = re.compile(rb"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.DOTALL)

FORMATTED = "formatted string, loss_spans array<struct<start:int,end:int>>"


def escape_role(role: str | None) -> bytes:
    """A role in one line and without a control string."""
    role = (role or "").replace("\\", "\\\\").replace("\n", "\\n")
    return role.encode().replace(b"<|", b"<||")


def unescape(data: bytes) -> bytes:
    """What a text was: after ``<|`` the assembler puts a second bar, which is taken out."""
    return data.replace(b"<||", b"<|")


def unescape_role(data: bytes) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(data).decode(), flags=re.DOTALL)


def _scatter(out: np.ndarray, data: np.ndarray, lengths: np.ndarray, to: np.ndarray, gaps: np.ndarray | None = None) -> None:
    """Copy consecutive segments of ``data`` to the places ``to``, ``gaps`` further on within each."""
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    at = np.arange(len(data), dtype=np.int64) + np.repeat(to - first, lengths)
    if gaps is not None:
        at += gaps
    out[at] = data


def assemble(roles: pa.Array, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All turns as one buffer, the offset of each turn in it, and its text's span there.

    Turn ``i`` is ``<|im_start|>role\\ntext<|im_end|>\\n``. Lengths give offsets, offsets
    give the place of every byte, and headers, texts and footers are each copied at once.
    """
    distinct = pc.fill_null(roles, "").dictionary_encode()
    heads = [START + escape_role(r) + b"\n" for r in distinct.dictionary.to_pylist()]
    code = distinct.indices.to_numpy(zero_copy_only=False)
    head_len = np.array([len(h) for h in heads], dtype=np.int64)[code]
    data, offsets = buffers(texts)
    text_len = np.diff(offsets)
    bar = np.zeros(len(data), dtype=bool)
    if len(data):
        bar[1:] = (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        bar[inner] = False
    seen = np.concatenate([[0], np.cumsum(bar)])
    extra = seen[offsets[1:]] - seen[offsets[:-1]]
    foot = np.frombuffer(END + b"\n", dtype=np.uint8)
    length = head_len + text_len + extra + len(foot)
    turn = np.concatenate([[0], np.cumsum(length)])
    out = np.empty(int(turn[-1]), dtype=np.uint8)
    for k, head in enumerate(heads):
        own = turn[:-1][code == k]
        out[(own[:, None] + np.arange(len(head))).ravel()] = np.tile(np.frombuffer(head, np.uint8), len(own))
    start = turn[:-1] + head_len
    within = seen[1:] - np.repeat(seen[offsets[:-1]], text_len)
    _scatter(out, data, text_len, start, within)
    # The added bar stands before the bar it doubles, so one byte to the left of it.
    marks = np.flatnonzero(bar)
    row = np.searchsorted(offsets, marks, side="right") - 1
    out[start[row] + marks - offsets[row] + within[marks] - 1] = 0x7C
    end = start + text_len + extra
    out[(end[:, None] + np.arange(len(foot))).ravel()] = np.tile(foot, len(end))
    return out, turn, np.stack([start, end], axis=1)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = batch.column(1)
        counts = np.diff(turns.offsets.to_numpy()).astype(np.int64)
        fields = turns.flatten()
        roles, texts = fields.field("role"), fields.field("text")
        loss = pc.fill_null(pc.equal(roles, "assistant"), False).to_numpy(zero_copy_only=False)
        out, turn, span = assemble(roles, texts)
        last = np.concatenate([[0], np.cumsum(counts)])
        base = turn[last]
        conv = np.repeat(np.arange(len(counts)), counts)
        span = (span - base[conv][:, None])[loss]
        spans = np.concatenate([[0], np.cumsum(np.bincount(conv[loss], minlength=len(counts)))])
        yield pa.record_batch(
            [
                batch.column(0),
                pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(base), pa.py_buffer(out)).cast(pa.string()),
                pa.ListArray.from_arrays(
                    pa.array(spans, pa.int32()),
                    pa.StructArray.from_arrays(
                        [pa.array(span[:, 0], pa.int32()), pa.array(span[:, 1], pa.int32())], names=["start", "end"]
                    ),
                ),
            ],
            names=["__conv", "formatted", "loss_spans"],
        )


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``(conversation, formatted, loss_spans)``, one row per conversation.

    ``formatted`` is every turn as ``<|im_start|>role\\ntext<|im_end|>\\n``, in the order of
    ``turn``; ties are ordered by role and text. ``loss_spans`` are the byte ranges of the
    assistant's texts, as formatted, without header and footer. In texts and roles ``<|``
    becomes ``<||``, so neither can hold a control string; in roles a line break is written
    ``\\n`` and a backslash twice. ``parse_chat`` is the inverse.

    A null text or role is an empty one, a null turn comes first, repeated rows are turns
    of their own. A null conversation id is one more conversation. Other columns are not
    read. An empty table gives an empty result. A conversation is one value of the result,
    so it must fit into a row.
    """
    kind = turns.schema[conv_col].dataType.simpleString()
    one = F.struct(
        F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    grouped = turns.select(F.col(conv_col).alias("__conv"), one.alias("turn"))
    grouped = grouped.groupBy("__conv").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    done = grouped.mapInArrow(_format, f"__conv {kind}, {FORMATTED}")
    return done.withColumnRenamed("__conv", conv_col)


def parse_chat(formatted: bytes) -> list[tuple[str, bytes]]:
    """The turns of a formatted text: role and text, unescaped."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, hashes, loss_chars, loss_hashes, chars = [], [], [], [], []
        for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            data = text.encode()
            turns = parse_chat(data)
            whole = hashlib.sha256()
            for role, own in turns:
                whole.update(role.encode() + b"\n" + own + b"\n")
            loss = b"".join(unescape(data[s["start"] : s["end"]]) for s in spans)
            counts.append(len(turns))
            hashes.append(whole.hexdigest())
            loss_chars.append(len(loss.decode()))
            loss_hashes.append(hashlib.sha256(loss).hexdigest())
            chars.append(len(text))
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(counts, pa.int64()),
                pa.array(hashes, pa.string()),
                pa.array(loss_chars, pa.int64()),
                pa.array(loss_hashes, pa.string()),
                pa.array(chars, pa.int64()),
            ],
            names=["__conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
        )


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of formatted conversations, taken from the formatted text alone."""
    kind = formatted.schema[conv_col].dataType.simpleString()
    done = formatted.select(F.col(conv_col).alias("__conv"), "formatted", "loss_spans").mapInArrow(
        _digest,
        f"__conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
    return done.withColumnRenamed("__conv", conv_col)
