"""What the operators share: written tables between jobs, batches of whole texts as flat word arrays, and hashes of them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.session import shuffle_files_removed, workspace

CHUNK_BYTES = 2 << 20  # texts are worked on in runs of whole documents of about this many bytes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Written tables below the shared folder. Writing one ends its job, so its shuffle files can go at once."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.base = spark, workspace(spark, name)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        with shuffle_files_removed(self.spark):
            df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its values in them; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, (offsets - offsets[0]) if len(column) else np.zeros(1, np.int64)


_REMEMBERED: dict[str, Callable[[], None]] = {}


def begins(operator: str = "", forget: Callable[[], None] | None = None) -> None:
    """A task of ``operator`` begins in this Python worker, which may have served others before: what they remember here is let go.

    ``forget`` lets go of what this one will remember from task to task.
    """
    for other in [x for x in _REMEMBERED if x != operator]:
        _REMEMBERED.pop(other)()
    if forget is not None:
        _REMEMBERED[operator] = forget


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", operator: str = "") -> Iterator[pa.RecordBatch]:
    """Runs of whole rows of about ``CHUNK_BYTES`` of text each, for a task of ``operator`` (one that remembers nothing, if not named)."""
    begins(operator)
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
        part, begin = offsets[:-1] // CHUNK_BYTES, 0
        for end in [*(np.nonzero(np.diff(part))[0] + 1), batch.num_rows]:
            yield batch.slice(begin, end - begin)
            begin = end


def spaces(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, offsets: np.ndarray, solid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in the bytes, and ``first``: where each document's words begin in those lists.

    ``solid`` tells the bytes of words; without it, all that are not white space.
    """
    solid = ~spaces(data) if solid is None else solid
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    begin = np.nonzero(solid & (np.r_[True, ~solid[:-1]] | cut[:-1]))[0] if len(data) else np.zeros(0, np.int64)
    end = np.nonzero(solid & (np.r_[~solid[1:], True] | cut[1:]))[0] + 1 if len(data) else np.zeros(0, np.int64)
    return begin, end, np.searchsorted(begin, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Bit mixing of 64-bit values (the finaliser published with MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, eight bytes a step over all spans at once."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))
    left = end - begin
    h = mix(left.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    live, at = np.arange(len(begin)), begin.copy()
    while len(live):
        v = eight[at]
        short = left < 8
        v[short] &= (np.uint64(1) << (left[short].astype(np.uint64) * np.uint64(8))) - np.uint64(1)
        h[live] = mix((h[live] ^ v) * np.uint64(0x9FB21C651E98DF25) + np.uint64(0x632BE59BD9B4E019))
        on = left > 8
        live, at, left = live[on], at[on] + 8, left[on] - 8
    return h


def window_hashes(units: np.ndarray, length: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of every run of ``length`` neighbours, put together from runs of half the length."""
    if len(units) < length:
        return np.zeros(0, np.uint64)
    base = base & ((1 << 64) - 1)

    def runs(k: int) -> np.ndarray:
        if k == 1:
            return units
        half = runs(k // 2)
        n = len(units) - k + 1
        out = half[:n] * np.uint64(pow(base, k // 2, 1 << 64)) + half[k // 2 : k // 2 + n]
        if k % 2:
            out = half[:n] * np.uint64(pow(base, k // 2 + 1, 1 << 64)) + half[k // 2 : k // 2 + n] * np.uint64(base) + units[k - 1 : k - 1 + n]
        return out

    return mix(runs(length))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the number of values in each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values).cast(kind))
