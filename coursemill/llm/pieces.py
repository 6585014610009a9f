"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives one Viterbi pass.

At each position the automaton's output links give every piece that ends there, and each relaxes the best score of that place. For a unigram
model a path's score is the sum of its pieces'. For a byte-pair model, a step from one piece to the next counts only if
no merge across their border would have come before the merges that made the two; exactly one path then has a finite score, the one that
merging gives, so ids equal the library's for both kinds. Characters that no piece holds become the bytes of the byte-fallback pieces.

No piece has a word mark inside, so a text is cut before each run of word marks and at unknown characters, which changes no result,
and cuts are remembered in a table of at most ``REMEMBERED`` entries per worker, until another operator's task begins in it.

Defined results: a null text is empty and has no ids; equal scores prefer the longer last piece; repeated rows each get a result;
a text that holds the word mark itself decodes to a space there, as with the library; an empty table gives none.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import begins, chunks, lists

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 400_000
MARK = "▁"
# fixed values of the model format
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one protocol-buffers message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, raw[at : at + size]
            at += size


class Pieces:
    """A model file's pieces with their automaton."""

    def __init__(self, raw: bytes) -> None:
        self.text, self.score, self.kind = [], [], []
        self.model, prefix, charsmap, extra = UNIGRAM, 1, b"", 1
        for field, value in _fields(raw):
            if field == 1:
                piece = dict(_fields(value))
                self.text.append(piece[1].decode())
                self.score.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kind.append(piece.get(3, NORMAL))
            elif field == 2:
                self.model = dict(_fields(value)).get(3, UNIGRAM)
            elif field == 3:
                rules = dict(_fields(value))
                charsmap, prefix, extra = rules.get(2, b""), rules.get(3, 1), rules.get(4, 1)
        if charsmap or extra or self.model not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models with identity normalisation are read")
        self.prefix = MARK if prefix else ""
        ordinary = [i for i, k in enumerate(self.kind) if k in (NORMAL, USER)]
        self.ids = {self.text[i]: i for i in ordinary}
        self.bytes = {int(self.text[i][3:5], 16): i for i, k in enumerate(self.kind) if k == BYTE}
        self.unknown = self.kind.index(UNKNOWN)
        self.least = min(self.score[i] for i in ordinary) - _UNKNOWN_PENALTY
        if any(MARK in self.text[i].lstrip(MARK) for i in ordinary):
            raise ValueError("a piece has a word mark inside")
        known = set("".join(self.ids))
        lone = "" if "\n" in known else "\n"
        self.cuts = re.compile(f"{MARK}*[^{MARK}{lone}]+|{MARK}+" + (f"|{lone}" if lone else ""))
        if self.model == BPE:
            # earlier merges have lower ranks; merges of one rank happen from left to right
            order = {x: r for r, x in enumerate(sorted({-self.score[i] for i in ordinary}))}
            self.rank = {self.text[i]: order[-self.score[i]] for i in ordinary}
            self.spines = {i: self._spines(self.text[i]) for i in ordinary}
        self.automaton = ahocorasick.Automaton()
        for i in ordinary:
            if self.model == UNIGRAM or self.spines[i] is not None:
                self.automaton.add_word(self.text[i], (i, len(self.text[i])))
        self.automaton.make_automaton()
        # plain numbers as keys and tuples as values: smaller than tuples and lists, and not walked by the garbage collector
        self.joined: dict[int, bool] = {}
        self.recent: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.plain = [self._plain(i) for i in range(len(self.text))]

    def _spines(self, text: str) -> tuple[list, list] | None:
        """The symbols that stood at a piece's left and right edge while it was merged, each with the rank that ended it."""
        parts, left, right = list(text), [], []
        while len(parts) > 1:
            ranks = [(self.rank[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not ranks:
                return None  # no merges lead to this piece
            r, k = min(ranks)
            if k == 0:
                left.append((parts[0], r))
            if k == len(parts) - 2:
                right.append((parts[-1], r))
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        never = len(self.rank)
        return [*left, (text, never)], [*right, (text, never)]

    def joins(self, a: int, b: int) -> bool:
        """Whether merging leaves pieces ``a`` and ``b`` side by side."""
        found = self.joined.get(a << 32 | b)
        if found is None:
            if len(self.joined) > REMEMBERED:
                self.joined.clear()
            self.joined[a << 32 | b] = found = self._joins(a, b)
        return found

    def _joins(self, a: int, b: int) -> bool:
        xs, ys, i, j, never = self.spines[a][1], self.spines[b][0], 0, 0, len(self.rank)
        while True:
            (x, x_ends), (y, y_ends) = xs[i], ys[j]
            across = self.rank.get(x + y, never)
            if across < x_ends and across <= y_ends and across < never:
                return False
            if x_ends == never and y_ends == never:
                return True
            if x_ends <= y_ends:
                i += 1
            else:
                j += 1

    def best(self, cut: str) -> list[int]:
        """Ids of the best path through one cut, in a single pass."""
        n, merges, unknown, worth, joined = len(cut), self.model == BPE, self.unknown, self.score, self.joined
        score: list[float | None] = [None] * (n + 1)
        last, came = [unknown] * (n + 1), [0] * (n + 1)  # of the best path: its last piece, and where that began
        score[0], reached = 0.0, 0
        for end, (piece, size) in self.automaton.iter(cut):
            if reached < end:
                self._skip(score, came, reached, end)
                reached = end
            end += 1
            begin = end - size
            gain, have = score[begin] + worth[piece], score[end]
            if have is not None and gain <= have:
                continue
            if merges and begin and (before := last[begin]) != unknown:
                fits = joined.get(before << 32 | piece)
                if not (self.joins(before, piece) if fits is None else fits):
                    continue
            score[end], last[end], came[end] = gain, piece, begin
        self._skip(score, came, reached, n)
        ids, at = [], n
        while at:
            piece, begin = last[at], came[at]
            if piece == unknown:
                ids += [self.bytes[x] for x in reversed(cut[begin:at].encode())] if self.bytes else [unknown]
            else:
                ids.append(piece)
            at = begin
        return ids[::-1]

    def _skip(self, score: list, came: list, reached: int, to: int) -> None:
        """Positions at which no piece ends are reached by an unknown character."""
        for k in range(reached + 1, to + 1):
            if score[k] is None:
                score[k], came[k] = score[k - 1] + self.least, k - 1

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        out, recent = [], self.recent
        for cut in self.cuts.findall(self.prefix + text.replace(" ", MARK)):
            ids = recent.get(cut)
            if ids is None:
                ids = self.older.get(cut)
                if ids is None:
                    ids = tuple(self.best(cut))
                if len(recent) >= REMEMBERED // 2:  # what was not asked for since the last turn is forgotten
                    self.older, self.recent = recent, {}
                    recent = self.recent
                if len(cut) < 64:
                    recent[cut] = ids
            out += ids
        return out

    def _plain(self, i: int) -> bytes:
        if self.kind[i] == BYTE:
            return bytes([int(self.text[i][3:5], 16)])
        if self.kind[i] == UNKNOWN:
            return " ⁇ ".encode()
        return b"" if self.kind[i] == CONTROL else self.text[i].replace(MARK, " ").encode()

    def decode(self, ids: list[int]) -> str:
        raw = b"".join([self.plain[i] for i in ids])
        return (raw[1:] if self.prefix and raw.startswith(b" ") else raw).decode(errors="replace")


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    with open(path, "rb") as file:
        return Pieces(file.read())


def _encoded(path: str, carry: list[str]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("pieces", pieces.cache_clear)
        model = pieces(path)
        for batch in chunks(batches, operator="pieces"):
            texts = batch.column("text").to_pylist()
            ids = [model.encode(t or "") for t in texts]
            size = np.array([len(x) for x in ids], np.int64)
            whole = [model.decode(x) == (t or "") for x, t in zip(ids, texts, strict=True)]
            flat = np.fromiter(chain.from_iterable(ids), np.int32, int(size.sum()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carry), pa.array(size), lists(flat, size, pa.int32()), pa.array(whole)], names=[*carry, "n_tokens", "ids", "round_trip"]
            )

    return rows


def encode(docs: DataFrame, carry: list[str], model: str = MODEL) -> DataFrame:
    """The columns ``carry``, then ``n_tokens``, ``ids`` and whether decoding the ids gave the text again."""
    taken = docs.select(*carry, *(["text"] if "text" not in carry else []))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema if f.name in carry)
    return taken.mapInArrow(_encoded(model, carry), f"{kinds}, n_tokens long, ids array<int>, round_trip boolean")


def decode(encoded: DataFrame, model: str = MODEL, column: str = "ids") -> DataFrame:
    """``encoded`` with a column ``text`` instead of the ids."""
    keep = [c for c in encoded.columns if c not in (column, "text")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins("pieces", pieces.cache_clear)
        for batch in batches:
            texts = [pieces(model).decode(x or []) for x in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "text"])

    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in encoded.schema if f.name in keep)
    return encoded.select(*keep, F.col(column)).mapInArrow(rows, f"{kinds}text string")
