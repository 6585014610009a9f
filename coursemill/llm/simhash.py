"""SimHash near-duplicates: 64-bit fingerprints, linked where few bits differ, compared in bit-sliced form.

Fingerprints that differ in at most two bits agree in two of four 16-bit blocks, so each distinct fingerprint is filed
under its six pairs of blocks. A file with more than ``SPLIT`` members is filed again by pairs of the four 8-bit blocks of the
other 32 bits, by the same argument; such a file shares 48 bits and so holds 65,536 distinct fingerprints at most. No
file is cut short. Within files, bit planes are stored vertically: plane ``b`` holds bit ``b`` of all fingerprints.
Plane against the same plane moved by ``lag`` compares every fingerprint with the one ``lag`` places on; carry-save
counters add up the differing planes, and a lag is abandoned once all its pairs exceed the radius. A file gives the
edges of a spanning forest, not its pairs. Edges become components by star contractions (components.py).

Defined results: null and word-less texts have fingerprint zero, linked like any other; shorter texts are one shingle; repeated rows
each get a result; a component whose ids are all null has a null id; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch, chunks, flat, signed, word_spans
from coursemill.llm.components import components

RADIUS = 2
SPLIT = 4096
SEED = 42
SHINGLE = 3
_PAIRS = list(combinations(range(4), 2))


def fingerprints(batch: pa.RecordBatch, shingle: int = SHINGLE) -> np.ndarray:
    data, offsets = flat(batch.column("text"))
    data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    begin, end, first = word_spans(data, offsets)
    # one space after each word, nothing else between: a shingle is then a slice
    keep = np.zeros(len(data) + 1, np.int8)
    np.add.at(keep, begin, 1)
    np.add.at(keep, end, -1)
    solid = np.cumsum(keep[:-1]) > 0
    size = end - begin
    at = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    where = np.ones(len(joined), bool)
    where[at + size] = False
    joined[where] = data[solid]
    n = np.diff(first)
    count = np.where(n >= shingle, n - shingle + 1, np.minimum(n, 1))
    doc = np.repeat(np.arange(len(n)), count)
    start = first[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    stop = np.minimum(start + shingle, first[doc + 1]) - 1
    raw, digest = joined.tobytes(), xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(at[start].tolist(), (at + size)[stop].tolist(), strict=True)], np.uint64)
    out = np.zeros(len(n), np.uint64)
    some = np.nonzero(count)[0]
    if len(some):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, (np.cumsum(count) - count)[some], axis=0, dtype=np.int32)
        over = (2 * ones > count[some, None]).astype(np.uint8)
        out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(signed(fingerprints(batch)))], names=["doc_id", "fp"])


def _block(fp, i: int, bits: int):
    return F.shiftrightunsigned(fp, i * bits).bitwiseAND((1 << bits) - 1)


def _exceeds(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Where the counted differences are more than ``radius`` (counters: bits of the count, lowest first)."""
    more, same = over, ~over
    for k in reversed(range(len(counters))):
        if radius >> k & 1:
            same = same & counters[k]
        else:
            more = more | (same & counters[k])
            same = same & ~counters[k]
    return more


def links_by_lag(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of positions in the same group (groups are runs) whose fingerprints differ in at most ``radius`` bits."""
    n = len(fps)
    size = np.bincount(group) if n else np.zeros(1, np.int64)
    if n < 2 or size.max() < 2:
        return
    words = (n + 63) // 64
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((64, (words + 1) * 64), np.uint8)
    padded[:, :n] = bits.T
    planes = np.packbits(padded, axis=1, bitorder="little").view(np.uint64)
    planes = planes[bits.min(0) != bits.max(0)]  # bits that all share need no counting
    last = np.concatenate([[0], np.cumsum(size)])[group + 1]  # end of each position's group
    for lag in range(1, int(size.max())):
        valid = np.zeros(words * 64, np.uint8)
        valid[:n] = np.arange(n) + lag < last
        want = np.packbits(valid, bitorder="little").view(np.uint64)
        skip, shift = lag // 64, np.uint64(lag % 64)
        counters = [np.zeros(words, np.uint64) for _ in range((radius + 1).bit_length())]
        over = np.zeros(words, np.uint64)
        over[:] = ~want
        width = words - skip
        for k, plane in enumerate(planes):
            moved = plane[skip : skip + width] >> shift
            if shift:
                moved = moved | (plane[skip + 1 : skip + 1 + width] << (np.uint64(64) - shift))
            carry = np.zeros(words, np.uint64)
            carry[:width] = plane[:width] ^ moved
            for c, counter in enumerate(counters):  # carry-save: each counter keeps its bit and hands on the carry
                counters[c], carry = counter ^ carry, counter & carry
            over |= carry
            if k % 4 == 3 and not (~_exceeds(counters, over, radius)).any():
                break
        near = ~_exceeds(counters, over, radius) & want
        if near.any():
            i = np.nonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))[0]
            yield i, i + lag


def forest(fps: np.ndarray, group: np.ndarray, radius: int) -> np.ndarray:
    """For each position the least position that its links reach."""
    label = np.arange(len(fps))
    for a, b in links_by_lag(fps, group, radius):
        while True:
            la, lb = label[a], label[b]
            apart = la != lb
            if not apart.any():
                break
            a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            while (label != (step := label[label])).any():
                label = step
    return label


def _compare(radius: int):
    """Edges of every file in a stream of rows ordered by file; a file that a batch cuts is held until it is whole."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, np.ndarray] | None = None

        def edges(file: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            group = np.cumsum(np.r_[0, file[1:] != file[:-1]])
            # small files first, so that a lag runs over those that are that long
            label = np.arange(len(fp))
            size = np.bincount(group)[group]
            for low in (2, 16, 128, 1024, 8192):
                pick = np.nonzero((size >= low) & (size < (low * 8 if low < 8192 else 1 << 62)))[0]
                for part in np.split(pick, np.searchsorted(group[pick], np.unique(group[pick])[:: max(1, 65536 // low)])):
                    if len(part):
                        own = group[part]
                        label[part] = part[forest(fp[part], np.cumsum(np.r_[0, own[1:] != own[:-1]]), radius)]
            tied = label != np.arange(len(fp))
            return pa.RecordBatch.from_arrays([pa.array(signed(fp[tied])), pa.array(signed(fp[label[tied]]))], names=["a", "b"])

        for batch in batches:
            file, fp = (np.array(batch.column(c)) for c in ("file", "fp"))
            fp = fp.view(np.uint64)
            if held is not None:
                file, fp = np.concatenate([held[0], file]), np.concatenate([held[1], fp])
            if not len(file):
                continue
            cut = int(np.searchsorted(file, file[-1]))
            held = file[cut:], fp[cut:]
            if cut:
                yield edges(file[:cut], fp[:cut])
        if held is not None and len(held[0]):
            yield edges(*held)

    return rows


def near_fingerprints(fps: DataFrame, scratch: Scratch, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """Edges ``a, b`` that tie all distinct fingerprints ``fp`` with at most ``radius`` (two or fewer) differing bits."""
    if radius > 2:
        raise ValueError("the filing by two of four blocks holds for two differing bits at most")
    fp = F.col("fp")
    combos = F.array(*[
        F.struct(F.lit(k).alias("combo"), F.shiftleft(_block(fp, i, 16), 16).bitwiseOR(_block(fp, j, 16)).alias("key"))
        for k, (i, j) in enumerate(_PAIRS)
    ])
    filed = fps.select("fp", F.explode(combos).alias("c")).select("fp", "c.combo", "c.key")
    counts = filed.groupBy("combo", "key").agg(F.count("*").alias("n")).filter("n > 1")
    counts = scratch.keep(counts, "files")  # a written side leaves the join plain, so adaptive execution can split hot files
    filed = filed.join(counts, ["combo", "key"])
    # the other two 16-bit blocks, as four of 8 bits, by combo
    others = [[b for b in range(4) if b not in pair] for pair in _PAIRS]
    eights = F.array(*[F.array(*[_block(fp, 2 * b + half, 8) for b in rest for half in (0, 1)]) for rest in others])
    filed = filed.withColumn("e", F.get(eights, F.col("combo")))
    again = F.array(*[
        F.struct(F.lit(k + 1).alias("sub"), F.shiftleft(F.get("e", F.lit(i)), 8).bitwiseOR(F.get("e", F.lit(j))).alias("subkey"))
        for k, (i, j) in enumerate(_PAIRS)
    ])
    once = F.array(F.struct(F.lit(0).alias("sub"), F.lit(0).cast("bigint").alias("subkey")))
    filed = filed.select("fp", "combo", "key", F.explode(F.when(F.col("n") > split, again).otherwise(once)).alias("s"))
    # one number names a file within its task: files that share it are compared together, which adds no false edge
    file = F.xxhash64("combo", "key", "s.sub", "s.subkey")
    filed = filed.select("fp", file.alias("file")).repartition("file").sortWithinPartitions("file", "fp")
    return filed.mapInArrow(_compare(radius), "a long, b long")


def simhash(docs: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row for each document."""
    scratch = Scratch(docs.sparkSession, "simhash")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = scratch.keep(texts.mapInArrow(_prints, "doc_id long, fp long"), "prints")
    distinct = scratch.keep(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    edges = scratch.keep(near_fingerprints(distinct.select("fp"), scratch, radius, split), "edges")
    roots = components(edges, scratch).withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = scratch.keep(rooted, "roots")
    ids = scratch.keep(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "ids")
    found = scratch.keep(rooted.join(ids, "root").select("fp", "component_id"), "found")
    out = prints.join(found, "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
