"""Substring deduplication: word windows that repeat across documents, found by level-wise doubling.

Levels are the wanted window length halved down to ``SHORTEST`` or less (13: 7, 13; 50: 7, 13, 25, 50). At the first
level only the runs that are the least of their neighbourhood are counted: every window of the next length holds such a
run, and equal windows hold equal ones, so no repeat is lost. From level to level, only windows made of parts that
repeat across documents are looked at again, each level twice as long (or up to the wanted length), until that length
is reached or no candidate survives. What a level finds is written to the shared folder, and texts are read again from
their table, so no job holds more than one shuffle of them.

Defined results: a null text is an empty text; a text with fewer words than a window keeps all; a null ``doc_id`` is
neither smaller nor larger than another, so its row keeps all and takes nothing away; rows that repeat a whole row get
the same result each; rows of one id and different texts are judged apart, each against smaller ids; copies under different ids lose everything but in the smallest id; an empty table gives none.
Windows are told apart by 96 bits of hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, chunks, flat, lists, signed, span_hashes, spaces, window_hashes, word_spans

SHORTEST = 8
ROW = ["doc_id", "tie"]


def levels(window: int) -> list[int]:
    out = [window]
    while out[0] > SHORTEST:
        out.insert(0, (out[0] + 1) // 2)
    return out


class _Words:
    """The words of a run of documents."""

    def __init__(self, batch: pa.RecordBatch, seed: int = 1) -> None:
        self.data, self.offsets = flat(batch.column("text"))
        self.begin, self.end, self.first = word_spans(self.data, self.offsets)
        self.hashes = span_hashes(self.data, self.begin, self.end, seed)
        self.doc = np.repeat(np.arange(batch.num_rows), np.diff(self.first))

    def inside(self, length: int) -> np.ndarray:
        """Positions where a window of ``length`` words begins and ends in one document."""
        n = len(self.doc) - length + 1
        return np.nonzero(self.doc[:n] == self.doc[length - 1 :])[0] if n > 0 else np.zeros(0, np.int64)

    def seeds(self, short: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Windows' positions, the least short run in each (the first of equals) and the hashes of short runs."""
        at, runs = self.inside(window), window_hashes(self.hashes, short)
        if not len(at):
            return at, at, runs
        least = np.lib.stride_tricks.sliding_window_view(runs, window - short + 1)
        step = 1 << 18
        where = np.concatenate([least[at[i : i + step]].argmin(1) for i in range(0, len(at), step)])
        return at, at + where, runs


def _seed_rows(short: int, window: int, with_doc: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = _Words(batch)
            _, picked, runs = w.seeds(short, window)
            picked = np.unique(picked)
            pair = np.unique(np.rec.fromarrays([w.doc[picked], runs[picked]], names="d,h"))
            out = [pa.array(signed(np.ascontiguousarray(pair.h)))]
            if with_doc:
                out += [batch.column(c).take(pa.array(np.ascontiguousarray(pair.d))) for c in ROW]
            yield pa.RecordBatch.from_arrays(out, names=["seed", *ROW][: len(out)])

    return rows


def _windows(batch: pa.RecordBatch, mark: str, parts: tuple[int, int], length: int) -> tuple[np.ndarray, ...]:
    """Candidate windows of ``length``: position, document row and both hashes.

    ``mark`` holds, per document, either seeds (the first level) or positions at which windows of the level before repeat.
    """
    w = _Words(batch)
    marks = batch.column(mark)
    owner = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
    values = marks.flatten().to_numpy(zero_copy_only=False)
    if mark == "seeds":
        at, picked, runs = w.seeds(parts[0], length)
        # a seed belongs to its document: both are told together
        if len(at):
            key = np.rec.fromarrays([w.doc[at], signed(runs[picked])], names="d,h")
            at = at[np.isin(_packed(key.d, key.h), _packed(owner, values))]
    else:
        alive = np.zeros(len(w.doc) + 1, bool)
        alive[w.first[owner] + values] = True
        at = w.inside(length)
        at = at[alive[at] & alive[at + length - parts[1]]]
    one, two = window_hashes(w.hashes, length), window_hashes(w.hashes ^ np.uint64(0x5851F42D4C957F2D), length, 0xD6E8FEB86659FD93)
    return at - w.first[w.doc[at]], w.doc[at], signed(one)[at], (signed(two)[at] >> 32).astype(np.int32)


def _packed(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One value of a document's row in its batch and a hash (a false match only adds a candidate)."""
    return h ^ (doc.astype(np.int64) << 40) ^ (doc.astype(np.int64) * 0x9E3779B1)


def _window_rows(mark: str, parts: tuple[int, int], length: int, with_position: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            at, doc, one, two = _windows(batch, mark, parts, length)
            if with_position:
                extra = [batch.column("tie").take(pa.array(doc)), pa.array(at.astype(np.int32))]
            else:
                pair = np.unique(np.rec.fromarrays([doc, one, two], names="d,a,b"))
                doc, one, two, extra = (np.ascontiguousarray(x) for x in (pair.d, pair.a, pair.b, pair.d))
                extra = []
            out = [pa.array(one), pa.array(two), batch.column("doc_id").take(pa.array(doc)), *extra]
            yield pa.RecordBatch.from_arrays(out, names=["one", "two", "doc_id", "tie", "pos"][: len(out)])

    return rows


def with_ties(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with ``tie``: zero, but for ids that several texts share, where it is the text's hash."""
    text = F.xxhash64("text")
    several = docs.groupBy("doc_id").agg(F.min(text).alias("least"), F.max(text).alias("most")).filter("least < most")
    several = scratch.keep(several.select(F.col("doc_id").alias("_shared")), "shared-ids")
    joined = docs.join(several, F.col("doc_id") == F.col("_shared"), "left")
    return joined.withColumn("tie", F.when(F.col("_shared").isNotNull(), text).otherwise(F.lit(0).cast("bigint"))).drop("_shared")


def repeated_windows(texts: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """``doc_id, tie, positions``: where windows of ``window`` words begin that also begin in a smaller ``doc_id``."""
    lengths = levels(window)
    texts = texts.select(*ROW, "text").filter("doc_id is not null")
    if len(lengths) == 1:
        lengths = [window, window]
    short = lengths[0]
    counted = texts.mapInArrow(_seed_rows(short, lengths[1], False), "seed long")
    again = scratch.keep(counted.groupBy("seed").count().filter("count > 1").select("seed"), "seeds")
    own = texts.mapInArrow(_seed_rows(short, lengths[1], True), "seed long, doc_id long, tie long")
    marks = scratch.keep(own.join(again, "seed").groupBy(*ROW).agg(F.collect_set("seed").alias("seeds")), "level-0")
    for k, length in enumerate(lengths[1:], 1):
        mark, parts = marks.columns[-1], (short, lengths[k - 1])
        last = k == len(lengths) - 1
        marked = texts.join(marks, ROW)
        seen = marked.mapInArrow(_window_rows(mark, parts, length, False), "one long, two int, doc_id long")
        seen = seen.groupBy("one", "two").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
        seen = scratch.keep(seen.filter("n > 1").drop("n"), f"windows-{k}")
        placed = marked.mapInArrow(_window_rows(mark, parts, length, True), "one long, two int, doc_id long, tie long, pos int")
        placed = placed.join(seen, ["one", "two"])
        if last:
            placed = placed.filter("doc_id > least")
        marks = scratch.keep(placed.groupBy(*ROW).agg(F.collect_set("pos").alias("positions")), f"level-{k}")
    return marks


def _covered(w: _Words, batch: pa.RecordBatch, window: int) -> np.ndarray:
    """Which words lie in a marked window."""
    marks = batch.column("positions")
    owner = np.repeat(np.arange(batch.num_rows), np.diff(marks.offsets.to_numpy()))
    begin = w.first[owner] + marks.flatten().to_numpy(zero_copy_only=False)
    change = np.zeros(len(w.doc) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + window, -1)
    return np.cumsum(change[:-1]) > 0


def _cut(window: int):
    """Texts without the marked words; what is left keeps its own white space before each word."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            w = _Words(batch)
            gone = _covered(w, batch, window)
            n, removed = np.diff(w.first), np.zeros(batch.num_rows, np.int64)
            np.add.at(removed, w.doc, gone)
            # a removed word takes the white space before it along
            change = np.zeros(len(w.data) + 1, np.int64)
            before = np.where(np.r_[True, w.doc[1:] != w.doc[:-1]], w.offsets[w.doc], np.r_[0, w.end[:-1]]) if len(w.doc) else w.begin
            np.add.at(change, before[gone], 1)
            np.add.at(change, w.end[gone], -1)
            stay = np.cumsum(change[:-1]) == 0
            blank = spaces(w.data)
            texts, digests = [], []
            for i, (a, b) in enumerate(zip(w.offsets[:-1], w.offsets[1:], strict=True)):
                own = w.data[a:b]
                text = own[stay[a:b]].tobytes() if removed[i] else own.tobytes()
                if removed[i] == n[i] and n[i]:
                    text = b""
                elif removed[i] and gone[w.first[i]]:
                    text = text[int(np.argmin(blank[a:b][stay[a:b]])) :]
                texts.append(text.decode())
                digests.append(hashlib.sha256(b" ".join(text.split())).hexdigest())
            spans = _spans(w, gone)
            found = [pa.array(n.astype(np.int64)), pa.array(removed), pa.array(texts, pa.string()), pa.array(digests, pa.string()), spans]
            names = ["n_words", "n_removed", "kept_text", "kept_sha256", "removed_spans"]
            own = [c for c in ("doc_id", "carried") if c in batch.schema.names]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *found], names=[*own, *names])

    return rows


def _spans(w: _Words, gone: np.ndarray) -> pa.Array:
    """Per document, first word and end of each removed run, one after the other."""
    edge = np.r_[True, w.doc[1:] != w.doc[:-1]] if len(w.doc) else np.zeros(0, bool)
    begin = np.nonzero(gone & (edge | ~np.r_[False, gone[:-1]]))[0] if len(gone) else np.zeros(0, np.int64)
    end = np.nonzero(gone & (np.r_[edge[1:], True] | ~np.r_[gone[1:], False]))[0] + 1 if len(gone) else begin
    doc = w.doc[begin]
    values = np.stack([begin - w.first[doc], end - w.first[doc]], 1).reshape(-1)
    return lists(values.astype(np.int32), 2 * np.bincount(doc, minlength=len(w.first) - 1), pa.int32())


CUT = "n_words long, n_removed long, kept_text string, kept_sha256 string, removed_spans array<int>"


def substring_dedup(docs: DataFrame, window: int = 13, carry: list[str] | None = None) -> DataFrame:
    """Per document: its words, how many were removed, the text that is left, its digest (kept words joined by a space) and the removed spans.

    Columns named in ``carry`` come along in a struct ``carried``.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    carried = [F.struct(*carry).alias("carried")] if carry else []
    texts = with_ties(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *carried, "text"), scratch)
    marks = repeated_windows(texts, window, scratch)
    joined = texts.join(marks, ROW, "left").withColumn("positions", F.coalesce("positions", F.array().cast("array<int>")))
    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in joined.schema if f.name in ("doc_id", "carried"))
    return joined.mapInArrow(_cut(window), kinds + CUT)
