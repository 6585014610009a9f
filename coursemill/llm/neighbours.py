"""Nearest neighbours by inner product through an inverted multi-index.

The two halves of a vector are quantised apart, by codebooks fitted on at most ``SAMPLE`` vectors (those with the smallest hash of their id), so
every vector lies in one of ``codes * codes`` cells. A query walks the pairs of centroids in the order of their summed nearness
with a heap, until the cells passed hold ``share`` of all vectors; the sum at which it stops tells which cells it visits.
Queries and index meet in blocks of bounded size, and visited entries are ranked by the exact inner product in double precision.

Equal vectors are one index entry, with its ``k + 1`` smallest ids: ties go to the smaller id, so a larger one can be in
no answer. ``share`` is set for vectors without any structure (README has the recall measured); it can be far smaller on clustered ones.

Defined results: null, zero and non-finite vectors, null ids and vectors of another length than most of the sample take no part; rows
that repeat count once; fewer than ``k`` candidates give all of them; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch

CODES = 64
SAMPLE = 16_384
SHARE = 0.5
GROUPS = 8
QUERY_BLOCK = 256
ENTRY_BLOCK = 4096


@dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    @property
    def half(self) -> int:
        return self.first.shape[1]

    @classmethod
    def fit(cls, sample: np.ndarray, codes: int, rounds: int = 10) -> Codebooks:
        half = sample.shape[1] // 2
        return cls(_means(sample[:, :half], codes, rounds), _means(sample[:, half:], codes, rounds))

    def cells(self, x: np.ndarray) -> np.ndarray:
        return _nearest(x[:, : self.half], self.first) * len(self.second) + _nearest(x[:, self.half :], self.second)

    def sums(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:, : self.half] @ self.first.T, x[:, self.half :] @ self.second.T


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(x @ centres.T - 0.5 * (centres**2).sum(1), axis=1)


def _means(x: np.ndarray, codes: int, rounds: int) -> np.ndarray:
    random = np.random.default_rng(7)
    centres = x[random.choice(len(x), min(codes, len(x)), replace=False)]
    for _ in range(rounds):
        own = _nearest(x, centres)
        count = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def walk(one: np.ndarray, two: np.ndarray, counts: np.ndarray, wanted: int) -> float:
    """The summed nearness at which a walk over centroid pairs, nearest first, has passed ``wanted`` entries."""
    a, b = np.argsort(-one, kind="stable"), np.argsort(-two, kind="stable")
    x, y, held = one[a].tolist(), two[b].tolist(), counts[np.ix_(a, b)].tolist()
    heap, seen, at = [(-(x[0] + y[0]), 0, 0)], 0, -np.inf
    while heap:
        near, i, j = heapq.heappop(heap)
        seen, at = seen + held[i][j], -near
        if seen >= wanted:
            return at
        if j + 1 < len(y):
            heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
    return -np.inf


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.array(column.flatten(), np.float64).reshape(-1, dims)


def _assign(books: Codebooks, dims: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = books.cells(_matrix(batch.column("v"), dims)) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], names=[*batch.schema.names, "cell"])

    return rows


def _stops(books: Codebooks, counts: np.ndarray, wanted: int, groups: int):
    """Blocks of queries with their stopping sums, once for each group of cells that one of them visits."""
    best = np.arange(len(books.first)) % groups

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims = books.half + books.second.shape[1]
        for batch in batches:
            for begin in range(0, batch.num_rows, QUERY_BLOCK):
                part = batch.slice(begin, QUERY_BLOCK)
                x = _matrix(part.column("v"), dims)
                one, two = books.sums(x)
                stop = np.array([walk(a, b, counts, wanted) for a, b in zip(one, two, strict=True)])
                visits = one + two.max(1)[:, None] >= stop[:, None]
                for g in np.unique(best[visits.any(0)]).tolist():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([g], pa.int32()), *(pa.array([v], pa.list_(t)) for v, t in ((np.array(part.column("vec_id")), pa.int64()), (x.reshape(-1), pa.float64()), (stop, pa.float64())))],
                        names=["g", "qid", "qv", "stop"],
                    )

    return rows


def _rank(books: Codebooks, k: int):
    """The ``k`` best of one block of entries for each query of one block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, seconds = books.half + books.second.shape[1], len(books.second)
        for batch in batches:
            for r in range(batch.num_rows):
                value = lambda c, r=r: batch.column(c)[r].values
                qid, q, stop = np.array(value("qid")), np.array(value("qv")).reshape(-1, dims), np.array(value("stop"))
                cell, ids = np.array(value("cells")), value("ids")
                e = np.array(value("vs").flatten(), np.float64).reshape(-1, dims)
                one, two = books.sums(q)
                score = q @ e.T
                score[one[:, cell // seconds] + two[:, cell % seconds] < stop[:, None]] = -np.inf
                sizes, members = np.diff(ids.offsets.to_numpy()), np.array(ids.flatten())
                starts = np.cumsum(sizes) - sizes
                least = np.partition(score, max(0, len(e) - k - 1), axis=1)[:, max(0, len(e) - k - 1)]
                out = []
                for i, s in enumerate(score):
                    pick = np.nonzero((s >= least[i]) & (s > -np.inf))[0]
                    own = np.repeat(pick, sizes[pick])
                    ident = members[np.repeat(starts[pick], sizes[pick]) + np.arange(len(own)) - np.repeat(np.cumsum(sizes[pick]) - sizes[pick], sizes[pick])]
                    own, ident = own[ident != qid[i]], ident[ident != qid[i]]
                    order = np.lexsort([ident, -s[own]])[:k]
                    out.append((np.full(len(order), qid[i]), ident[order], s[own][order]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return rows


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, share: float = SHARE, codes: int = CODES) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries``, against all of ``vectors`` (both ``vec_id, embedding``)."""
    spark, scratch = vectors.sparkSession, Scratch(vectors.sparkSession, "neighbours")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("embedding")
    whole = F.coalesce(F.forall(v, fine) & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    shape = lambda df: df.filter(whole).select(F.col("vec_id").cast("bigint").alias("vec_id"), v.cast("array<double>").alias("v"))
    rows, asked = shape(vectors), shape(queries)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).toPandas()["v"].tolist()
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = np.array([len(x) for x in sample])
    dims = int(np.bincount(lengths).argmax())
    books = Codebooks.fit(np.array([x for x in sample if len(x) == dims]), codes)
    same = F.size("v") == dims
    few = Window.partitionBy("v").orderBy("vec_id")
    ranked = rows.filter(same).distinct().withColumn("r", F.row_number().over(few)).filter(F.col("r") <= k + 1)
    entries = ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = scratch.keep(entries.mapInArrow(_assign(books, dims), "v array<double>, ids array<long>, cell int"), "entries")
    counts = np.zeros(len(books.first) * len(books.second), np.int64)
    for cell, n in entries.groupBy("cell").count().collect():  # one row for each cell, of which there is a fixed number
        counts[cell] = n
    wanted = max(int(np.ceil(share * counts.sum())), k + 1)
    stops = asked.filter(same).distinct().mapInArrow(_stops(books, counts.reshape(len(books.first), -1), wanted, GROUPS), "g int, qid array<long>, qv array<double>, stop array<double>")
    group = (F.floor(F.col("cell") / len(books.second)) % GROUPS).cast("int")
    parts = max(1, -(-int(counts.sum()) // (GROUPS * ENTRY_BLOCK)))
    # a block is about the same size whatever the cells hold: within a group, entries are dealt by hash
    blocks = entries.select(group.alias("g"), F.pmod(F.xxhash64("v"), F.lit(4 * parts)).alias("part"), "cell", "ids", "v")
    blocks = blocks.groupBy("g", "part").agg(F.collect_list(F.struct("cell", "ids", "v")).alias("e"))
    blocks = scratch.keep(blocks.select("g", "part", F.col("e.cell").alias("cells"), F.col("e.ids").alias("ids"), F.col("e.v").alias("vs")), "blocks")
    stops = scratch.keep(stops, "queries")
    # only the queries are copied, once for each block of entries in a group that they visit
    met = stops.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(4 * parts - 1)))).join(blocks, ["g", "part"])
    found = met.select("qid", "qv", "stop", "cells", "ids", "vs").mapInArrow(_rank(books, k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
