"""Chat formatting (operator 2): columnar byte assembly.

Template, for each turn: ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside
texts and roles (``CONTROL``, the template's own and those of other public templates)
get one backslash after their first character; a control string that already has
backslashes there gets one more. So no text holds a control string, and taking one
backslash away restores every text exactly. In roles, backslash and line feed are
written ``\\\\`` and ``\\n``.

Turns are range-partitioned by (conversation, turn, the beginnings of role and text), so a
conversation with a third of all turns is formatted by many tasks, and the sample that
finds the ranges has short keys. For each slice of about a megabyte of text, numpy computes the lengths of
all segments (marker, role, line feed, text, end), their cumulative offsets and the
scatter indices, and copies headers and contents into one preallocated buffer. The
output is one row per *part*: consecutive turns of one conversation, in order, with the
formatted bytes as text and the byte spans under the loss mask (assistant texts).
A conversation is its parts, one after another, by ``part``.

Defined results
* turns are ordered by turn (nulls first), then role, then text (roles that share their
  first ``KEY_CHARS`` characters: by the text's beginning first); rows repeated verbatim
  count each;
* a very long text is a slice of its own: about 40 bytes of memory a byte of it;
* a null text or role is empty; a null conversation id is a conversation of its own;
* only the role ``assistant``, spelled so, is under the loss mask;
* an empty table gives no parts; other columns are not touched, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens.llm.common import col_of, text_slices

START, END = "<|im_start|>", "<|im_end|>"
# fixed values: control strings of public chat templates, first character apart
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]")
_REST = {c: "|".join(re.escape(x[1:]) for x in CONTROL if x[0] == c) for c in "<["}
_ESCAPE = re.compile("|".join(rf"{re.escape(c)}(?=\\*(?:{rest}))" for c, rest in _REST.items()))
_UNESCAPE = re.compile("|".join(rf"{re.escape(c)}\\(?=\\*(?:{rest}))" for c, rest in _REST.items()))
PART_BYTES = 4 << 20
KEY_CHARS = 64

PART = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("part", T.LongType()),
    T.StructField("n_turns", T.LongType()),
    T.StructField("formatted", T.StringType()),
    T.StructField("loss_start", T.ArrayType(T.LongType())),
    T.StructField("loss_end", T.ArrayType(T.LongType())),
])


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][0], text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def _column(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a column and its offsets."""
    arr = pa.array(values, pa.large_string())
    offsets = np.frombuffer(arr.buffers()[1], dtype=np.int64)[: len(arr) + 1]
    data = arr.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)), offsets


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy the i-th value of a column to ``out[at[i]:]``, all at once."""
    lens = np.diff(offsets)
    index = np.arange(len(data), dtype=np.int64) + np.repeat(at - offsets[:-1], lens)
    out[index] = data


def assemble(roles: list[str], texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One buffer with all turns, the turns' offsets in it, and where their texts start
    and end. ``roles`` and ``texts`` are escaped."""
    role, role_at = _column(roles)
    text, text_at = _column(texts)
    head, tail = (np.frombuffer(x.encode(), dtype=np.uint8) for x in (START, END + "\n"))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    sizes = len(head) + role_len + 1 + text_len + len(tail)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    begin = offsets[:-1]
    role_to = begin + len(head)
    text_to = role_to + role_len + 1
    out = np.empty(offsets[-1], dtype=np.uint8)
    out[begin[:, None] + np.arange(len(head))] = head
    _scatter(out, role_to, role, role_at)
    out[text_to - 1] = ord("\n")
    _scatter(out, text_to, text, text_at)
    out[(text_to + text_len)[:, None] + np.arange(len(tail))] = tail
    return out, offsets, text_to, text_to + text_len


def _parts_of(convs: list, sizes: np.ndarray) -> list[int]:
    """Where parts begin: at a new conversation, or when a part has ``PART_BYTES``."""
    cuts, held = [0], 0
    for i in range(1, len(convs)):
        held += int(sizes[i - 1])
        if convs[i] != convs[i - 1] or held >= PART_BYTES:
            cuts.append(i)
            held = 0
    return [*cuts, len(convs)]


def format_chats(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The parts of all conversations: columns of ``PART``."""

    def parts(batches):
        number = TaskContext.get().partitionId() << 40  # range partitions are in order, so are parts
        for rec in (part for batch in batches for part in text_slices(batch, 2)):
            convs, roles, texts = (rec.column(i).to_pylist() for i in range(3))
            buf, offsets, lo, hi = assemble([escape_role(x) for x in roles], [escape(x) for x in texts])
            loss = np.array([r == "assistant" for r in roles])
            cuts = _parts_of(convs, np.diff(offsets))
            flat = pa.py_buffer(buf)
            starts = np.array(cuts)
            formatted = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets[starts].astype(np.int64)), flat)
            spans = [(lo[a:b][loss[a:b]] - offsets[a], hi[a:b][loss[a:b]] - offsets[a]) for a, b in zip(cuts, cuts[1:])]
            yield pa.record_batch([
                pa.array([convs[a] for a in cuts[:-1]], pa.int64()),
                pa.array(number + np.arange(len(cuts) - 1)),
                pa.array(np.diff(starts)),
                formatted.cast(pa.string()),
                pa.array([s for s, _ in spans], pa.list_(pa.int64())),
                pa.array([e for _, e in spans], pa.list_(pa.int64())),
            ], names=PART.names)
            number += len(cuts) - 1

    rows = df.select(
        col_of(conv_col).cast("bigint").alias("c"),
        F.coalesce(col_of(role_col).cast("string"), F.lit("")).alias("r"),
        F.coalesce(col_of(text_col).cast("string"), F.lit("")).alias("t"),
        col_of(turn_col).alias("n"),
    )
    begins = [F.left(x, F.lit(KEY_CHARS)) for x in ("r", "t")]
    ranges = rows.repartitionByRange("c", "n", *begins)
    return ranges.sortWithinPartitions("c", "n", *begins, "r", "t").mapInArrow(parts, PART)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read from formatted text."""
    turns = []
    for piece in formatted.split(START)[1:]:
        head, _, rest = piece.partition("\n")
        turns.append((unescape_role(head), unescape(rest[: rest.rindex(END)])))
    return turns


DIGEST = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()),
    T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()),
    T.StructField("formatted_chars", T.LongType()),
])


class _Reading:
    """What is read back from one conversation's parts so far."""

    def __init__(self, conv):
        self.conv, self.turns, self.loss_chars, self.chars = conv, 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, starts: list[int], ends: list[int]) -> None:
        self.chars += len(formatted)
        for role, text in read_turns(formatted):
            self.turns += 1
            self.all.update(f"{role}\n{text}\n".encode())
        raw = formatted.encode()
        for a, b in zip(starts, ends):
            text = unescape(raw[a:b].decode())
            self.loss_chars += len(text)
            self.loss.update(text.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


def read_back(parts: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its formatted parts. A SHA-256 takes its
    bytes in order, so one task streams the parts of a conversation, a batch at a time;
    it holds one part and two hash states, however long the conversation is."""

    def digests(batches):
        state = None
        for rec in batches:
            done = []
            for conv, _, _, formatted, lo, hi in zip(*(rec.column(i).to_pylist() for i in range(6))):
                if state is None or state.conv != conv:
                    if state is not None:
                        done.append(state.row())
                    state = _Reading(conv)
                state.add(formatted, lo, hi)
            if done:
                yield _digest_batch(done)
        if state is not None:
            yield _digest_batch([state.row()])

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(digests, DIGEST)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=DIGEST.names)
