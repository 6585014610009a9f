"""Chat formatting at token level.

A turn is ``<|im_start|>role\\n text <|im_end|>\\n``. Role, text and separators are encoded apart, and the reserved ids are spliced
in between, so no text can spell one. Control strings inside a text are escaped all the same, for readers of the rendered text: a
backslash goes between ``<`` and ``|``, and one more where there were some already, which is undone exactly. Loss masks are prefix sums of
+1 and -1 at segment borders, and so are the places of turns in their conversation.

Runs of white space longer than ``LONG_SPACE`` are cut out by a linear scan and encoded apart, in pieces of that length: the vocabulary's split pattern would
go as deep as they are long. Decoding is exact all the same.

Rows are encoded where they are read, then moved to their conversation and put in order of ``turn`` (equal turns by role, then by a hash of the text;
a null turn first). A conversation is a run of rows, one for each turn, never one value: tasks stream it with a carried position, however long
it is. Defined results: a null text or role is empty; null ``conv_id`` rows make up one conversation; repeated rows are turns of their own; an empty table gives none.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import lists

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed values: the published split pattern of this vocabulary, and the control strings of the template
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
LONG_SPACE = 4096
_LONG = re.compile(rf"(\s{{{LONG_SPACE},}})")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\([\\n])", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


class Codec:
    """The byte-pair vocabulary with the two reserved ids behind it."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.start, self.end = max(ranks.values()) + 1, max(ranks.values()) + 2
        self.core = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.kind = np.dtype("<u2" if self.end < 1 << 16 else "<u4")

    def encode(self, text: str) -> list[int]:
        ids = []
        for k, part in enumerate(_LONG.split(text)):
            step = LONG_SPACE if k % 2 else len(part) or 1
            for begin in range(0, len(part), step):
                ids += self.core.encode_ordinary(part[begin : begin + step])
        return ids

    def decode(self, ids: list[int]) -> str:
        return self.core.decode_bytes(ids).decode()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _encode(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        line = c.encode("\n")
        for batch in batches:
            ids, sizes = [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True):
                head, body = c.encode(escape_role(role)), c.encode(escape(text))
                ids.append(np.array([c.start, *head, *line, *body, c.end, *line], c.kind).tobytes())
                sizes.append((1 + len(head) + len(line), len(body)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in ("conv_id", "turn", "role", "tie")] + [pa.array(ids, pa.binary()), pa.array([s[0] for s in sizes], pa.int32()), pa.array([s[1] for s in sizes], pa.int32())],
                names=["conv_id", "turn", "role", "tie", "ids", "head", "body"],
            )

    return rows


def _assemble(path: str):
    """Token ids, their place in the conversation and the loss mask, from rows in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, own, place = codec(path).kind, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = batch.column("ids").to_pylist()
            size = np.array([len(x) // kind.itemsize for x in raw], np.int64)
            flat = np.frombuffer(b"".join(raw), kind).astype(np.int32)
            begin = np.cumsum(size) - size
            head, body = np.array(batch.column("head")), np.array(batch.column("body"))
            learnt = np.array([r == LOSS_ROLE for r in batch.column("role").to_pylist()])
            step = np.zeros(len(flat) + 1, np.int8)
            np.add.at(step, (begin + head)[learnt], 1)
            np.add.at(step, (begin + head + body)[learnt], -1)
            mask = np.cumsum(step[:-1], dtype=np.int8) > 0
            conv = batch.column("conv_id").to_pylist()
            offset = np.zeros(len(conv), np.int64)
            for i, name in enumerate(conv):
                if i == 0 and own != (name,) or i and name != conv[i - 1]:
                    own, place = (name,), 0
                offset[i] = place
                place += int(size[i])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), pa.array(offset), lists(flat, size, pa.int32()), lists(mask, size, pa.bool_())],
                names=["conv_id", "turn", "offset", "ids", "loss"],
            )

    return rows


FORMATTED = "conv_id long, turn long, offset long, ids array<int>, loss array<boolean>"


def format_conversations(turns: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row for each turn, in order within each partition, a conversation in one partition: ids, their offset and the loss mask."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    plain = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"), F.xxhash64(text).alias("tie"))
    coded = plain.mapInArrow(_encode(vocabulary), "conv_id long, turn long, role string, tie long, ids binary, head int, body int")
    placed = coded.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "tie")
    return placed.mapInArrow(_assemble(vocabulary), FORMATTED)


def _read(path: str):
    """Conversations read back from ids and masks alone, row by row."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, own, state = codec(path), None, None

        def done() -> pa.RecordBatch:
            n, turns, chars, loss, long = state
            values = [own[0], n, turns.hexdigest(), chars, loss.hexdigest(), long]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=DIGEST_NAMES)

        for batch in batches:
            for name, ids, loss in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "ids", "loss")), strict=True):
                if own != (name,):
                    if own is not None:
                        yield done()
                    own, state = (name,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if ids[0] != c.start or ids.count(c.start) != 1 or ids.count(c.end) != 1:
                    raise ValueError("a formatted turn holds each reserved id once")
                close = ids.index(c.end)
                shown = c.decode(ids[1:close])
                role, _, body = shown.partition("\n")
                text = unescape(body)
                state[0] += 1
                state[1].update(f"{unescape_role(role)}\n{text}\n".encode())
                learnt = unescape(c.decode([i for i, m in zip(ids, loss, strict=True) if m]))
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += len(START) + len(shown) + len(END) + len(c.decode(ids[close + 1 :]))
        if own is not None:
            yield done()

    return rows


DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def conversation_digests(formatted: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Digests of what ``format_conversations`` gave, in the same partitions."""
    return formatted.mapInArrow(_read(vocabulary), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
