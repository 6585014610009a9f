"""Exact top-k search by integer inner product over a bit-sliced index.

A vector becomes whole numbers, ``floor(64 * x)`` for each component. A block of the index holds, for each component and each bit of its values,
one bitmap with a bit for every row. A query's weights are written in signed binary digits; each digit adds the shifted bitmaps of its
component (or their complements) to the score, all of them at once by carry-save addition. The result is the score of all rows of the
block in bit slices, from which the best rows are taken from the most significant slice downward. Once few rows are left at the
boundary they are scored and ordered exactly; where the slices are used up, rows at the boundary have equal scores and the
smaller ids win, as rows lie in the order of their ids.

Defined results: null and empty vectors, vectors with null or non-finite components and null ids take no part; zero vectors do. A vector is
compared with vectors of its own length. Whole rows that repeat count once; rows of one id and different vectors are all candidates and, if
asked, queries that share a ranking; no query finds its own id. Components are held to 2**27 after scaling, beyond which products of
512 of them would not fit a score. Fewer than ``k`` candidates give all of them; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coursemill.llm.common import Scratch

SCALE = 64
LIMIT = 2**27
ROWS = 4096  # rows of one block of the index
QUERIES = 256  # queries that meet a block together
FEW = 4  # boundary rows that are worth scoring, in multiples of k


def pack(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as bitmaps of 64-bit words; the last dimension is padded with zeros."""
    padded = np.pad(bits, [(0, 0)] * (bits.ndim - 1) + [(0, -bits.shape[-1] % 64)])
    return np.ascontiguousarray(np.packbits(padded, axis=-1, bitorder="little")).view(np.uint64)


def positions(bitmap: np.ndarray) -> np.ndarray:
    return np.nonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))[0]


def size(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def slices(x: np.ndarray) -> np.ndarray:
    """Bit planes, component by component and least bit first, of values counted from each component's least one; then their complements."""
    u = x - x.min(0)
    width = max(1, int(u.max()).bit_length())
    planes = np.stack([pack((u.T >> b & 1).astype(bool)) for b in range(width)], axis=1)
    return np.concatenate([planes, ~planes])


def digits(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Component, place and sign of the digits that are not zero, when every weight is written with no two of them side by side."""
    size_, place = np.abs(q), np.arange(62)
    plus, minus = (3 * size_ & ~size_) >> 1, (~(3 * size_) & size_) >> 1
    component, at = np.nonzero((plus | minus)[:, None] >> place & 1)
    return component, at, ((minus[component] >> at & 1) == 1) != (q[component] < 0)


def add(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Bit slices, least first, of the sums of bitmaps; ``columns[p]`` holds those of weight ``2**p`` as rows."""
    columns, out = list(columns), []
    while len(out) < len(columns):
        here, carries = columns[len(out)], []
        while len(here) > 1:
            third = max(1, len(here) // 3)
            a, b, c = here[:third], here[third : 2 * third], here[2 * third : 3 * third]
            either, both = a ^ b, a & b
            if len(c):
                both |= either & c
                either ^= c
            carries.append(both)
            here = np.concatenate([either, here[3 * third :]])
        out.append(here[0] if len(here) else None)
        if carries:
            carried = np.concatenate(carries)
            if len(out) < len(columns):
                columns[len(out)] = np.concatenate([columns[len(out)], carried])
            else:
                columns.append(carried)
    some = next((s for s in out if s is not None), None)
    return [] if some is None else [np.zeros_like(some) if s is None else s for s in out]


def scores(planes: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """The score of every row, less a constant of the query, in bit slices."""
    half, width, words = len(planes) // 2, planes.shape[1], planes.shape[2]
    component, place, negative = digits(q)
    bit = np.arange(width)
    row = ((component + negative * half) * width)[:, None] + bit
    column = (place[:, None] + bit).reshape(-1)
    order = np.argsort(column, kind="stable")
    stacked = planes.reshape(-1, words)[row.reshape(-1)[order]]
    ends = np.searchsorted(column[order], np.arange(1, column.max(initial=-1) + 2))
    return add(np.split(stacked, ends[:-1])) if len(ends) else []


def select(sums: list[np.ndarray], live: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that are among the ``k`` best, and rows at the boundary: few ones, or ones with equal scores."""
    sure, edge, have = np.zeros_like(live), live, 0
    for s in reversed(sums):
        if have + size(edge) <= FEW * k:
            break
        hit = edge & s
        n = size(hit)
        if have + n > k:
            edge = hit
        else:
            sure, edge, have = sure | hit, edge & ~s, have + n
    return positions(sure), positions(edge)


def _index(key: tuple, rows: pa.Table) -> pa.Table:
    """One block: ids in order, values, and their bit planes."""
    rows = rows.sort_by("vec_id")
    x = np.array(rows["x"].combine_chunks().flatten(), np.int64).reshape(rows.num_rows, -1)
    cells = [pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([rows["vec_id"].to_pylist()], pa.list_(pa.int64()))]
    return pa.Table.from_arrays([*cells, pa.array([x.tobytes()], pa.binary()), pa.array([slices(x).tobytes()], pa.binary())], names=["dims", "part", "ids", "x", "planes"])


def _meet(k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                at = lambda c, r=r: batch.column(c)[r]
                ids, dims = np.array(at("ids").values), at("dims").as_py()
                x = np.frombuffer(at("x").as_py(), np.int64).reshape(len(ids), dims)
                live = pack(np.ones(len(ids), bool))
                planes = np.frombuffer(at("planes").as_py(), np.uint64).reshape(2 * dims, -1, len(live))
                asked, q = np.array(at("qids").values), np.array(at("q").values.flatten(), np.int64).reshape(-1, dims)
                out = []
                for own, weights in zip(asked, q, strict=True):
                    sure, edge = select(scores(planes, weights), live & ~pack(ids == own), k)
                    if len(sure) + len(edge) > FEW * k:  # equal scores at the boundary: rows lie in the order of their ids
                        edge = edge[: k - len(sure)]
                    pick = np.concatenate([sure, edge])
                    exact = x[pick] @ weights
                    best = np.lexsort([ids[pick], -exact])[:k]
                    out.append((np.full(len(best), own), ids[pick][best], exact[best]))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    return rows


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """``floor(scale * x)`` of every component as double, held to ``LIMIT``."""
    held = lambda x: F.greatest(F.least(F.floor(x.cast("double") * scale), F.lit(LIMIT)), F.lit(-LIMIT)).cast("bigint")
    return F.transform(vector, held)


def fit(vector: Column) -> Column:
    """Whether a vector has components and all of them are finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine), F.lit(False))


def top_scores(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` for ``queries``, against all of ``vectors`` (both ``vec_id, embedding``)."""
    scratch = Scratch(vectors.sparkSession, "sliced")
    shape = lambda df: df.filter(fit(F.col("embedding")) & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("bigint").alias("vec_id"), whole_numbers(F.col("embedding")).alias("x")).distinct()
    rows, asked = scratch.keep(shape(vectors), "rows"), shape(queries)
    parts = max(1, -(-rows.count() // ROWS))
    blocks = max(1, -(-asked.count() // QUERIES))
    deal = lambda n: F.pmod(F.xxhash64("vec_id", "x"), F.lit(n)).cast("int")
    index = rows.withColumn("dims", F.size("x")).withColumn("part", deal(parts)).groupBy("dims", "part")
    index = scratch.keep(index.applyInArrow(_index, "dims int, part int, ids array<long>, x binary, planes binary"), "index")
    asked = asked.groupBy(F.size("x").alias("dims"), deal(blocks).alias("block")).agg(F.collect_list(F.struct("vec_id", "x")).alias("e"))
    asked = asked.select("dims", F.col("e.vec_id").alias("qids"), F.col("e.x").alias("q"))
    # blocks of queries are copied, once for each block of the index
    met = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).join(index, ["dims", "part"])
    found = met.select("dims", "ids", "x", "planes", "qids", "q").mapInArrow(_meet(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
