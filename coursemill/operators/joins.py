"""Joins with a strategy of their own: measured broadcast, hot-key salting, range lookup and additive full outer."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from coursemill.functions.columns import ipv4_number, region_province
from coursemill.operators.grouping import pick_one

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_within(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if it was measured to be small enough; else hand it back for a shuffle join.

    Rows are counted first, which needs no column; only few enough rows are then weighed, by the length of their JSON.
    """
    if df.count() > max_rows:
        return df
    weight = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("b")).first()["b"]
    return F.broadcast(df) if weight <= max_bytes else df


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = 0.001) -> DataFrame:
    """Keys that hold more than ``share`` of all rows, as a local frame of fewer than ``1 / share`` rows."""
    return _hot_keys(df, keys, share)[0]


def _hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> tuple[DataFrame, bool]:
    """The hot keys, and whether rows without a key hold more than ``share`` of all rows.

    One pass over the key columns: counts are combined before the shuffle, the total is observed on the way, and only
    the ``1 / share`` largest counts come back. No more keys than that can hold such a share, whatever the data.
    """
    total = Observation()
    counts = (
        df.select(*keys)
        .observe(total, F.count(F.lit(1)).alias("rows"), F.count_if(~_all_set(keys)).alias("unset"))
        .where(_all_set(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    largest = counts.orderBy(F.col("n").desc()).limit(int(1 / share) + 1).collect()
    found = [tuple(r[k] for k in keys) for r in largest if r["n"] > share * total.get["rows"]]
    hot = df.sparkSession.createDataFrame(found, counts.select(*keys).schema)
    return hot, total.get["unset"] > share * total.get["rows"]


def _all_set(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).isNotNull()
    return cond


def salted_join(
    small: DataFrame,
    big: DataFrame,
    on: Sequence[str],
    how: str,
    *,
    spread_by: Sequence[str],
    salts: int = 100,
    hot_share: float | None = 0.001,
) -> DataFrame:
    """``small.join(big, on, how)`` for a big side with hot keys; ``how`` is ``inner`` or ``right``.

    A row of the big side gets salt ``hash(spread_by) mod salts`` and the small side is repeated once per salt, so a
    hot key is spread over ``salts`` reducers. With ``hot_share`` only keys that hold more than that share of the big
    side are salted and repeated; with ``None`` all keys are. The salt is a hash and not a random number: a task that
    is run again after a lost executor sends its rows to the same place.
    """
    if how not in ("inner", "right"):
        raise ValueError("the big side must be the preserved side: inner or right")
    on = list(on)
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot_share is None:
        big_salted = big.withColumn("_salt", salt)
        small_salted = small.withColumn("_salt", F.explode(every))
    else:
        found, unset = _hot_keys(big, on, hot_share)
        if found.isEmpty() and not unset:
            return small.join(big, on, how)
        hot = F.broadcast(found.withColumn("_hot", F.lit(True)))
        # a null key matches nothing, but its rows must not meet in one reducer either
        big_salted = big.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot") | ~_all_set(on), salt).otherwise(0))
        small_salted = small.join(hot, on, "left").withColumn(
            "_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))
        )
        big_salted, small_salted = big_salted.drop("_hot"), small_salted.drop("_hot")
    return small_salted.join(big_salted, [*on, "_salt"], how).drop("_salt")


def range_lookup(
    rows: DataFrame,
    ranges: DataFrame,
    *,
    point: str,
    start: str,
    end: str,
    width: int = 65536,
    nested: bool = False,
) -> DataFrame:
    """Left join on ``start <= point <= end`` as an equi-join on buckets of ``width`` numbers.

    Each range is listed once per bucket it reaches into, so the join key is an equality and Spark may hash it either
    way; a broadcast is its own choice, made from real sizes. Ranges must not overlap, as in an address table, which
    keeps a bucket's list at most ``width`` long and the total at ``ranges + span / width``. With ``nested`` they may:
    they are cut into ``disjoint_pieces`` first, and a row still meets one range, the innermost.
    """
    if nested:
        listed, low, high = disjoint_pieces(ranges, start=start, end=end, width=width), "_from", "_to"
    else:
        first, last = (_bucket_of(c, width) for c in (start, end))
        listed, low, high = ranges.withColumn("_bucket", F.explode(F.sequence(first, last))), start, end
    left = rows.withColumn("_bucket", _bucket_of(point, width))
    inside = (
        (left["_bucket"] == listed["_bucket"]) & (left[point] >= listed[low]) & (left[point] <= listed[high])
    )
    kept = [left[c] for c in rows.columns] + [listed[c] for c in ranges.columns if c not in rows.columns]
    return left.join(listed, inside, "left").select(*kept)


def _bucket_of(column: str, width: int) -> Column:
    return F.floor(F.col(column) / width).cast("long")


def disjoint_pieces(ranges: DataFrame, *, start: str, end: str, width: int = 65536) -> DataFrame:
    """The ranges' rows with the pieces ``_from .. _to`` of ``_bucket`` in which they are the innermost.

    At a point the range wins that starts last; of those the one that ends first; of equal ranges the smallest row. Ranges
    without a bound or with their end before their start hold no point and give no piece. Pieces of a bucket do not
    overlap and are at most two per range listed in it. A bucket is swept in the order of its starts, batch by batch, with
    only the ranges that may still win in memory.
    """
    others = [c for c in ranges.columns if c not in (start, end)]
    sound = ranges.where(F.col(start) <= F.col(end))
    each = pick_one(sound, [start, end]) if others else sound.distinct()
    bounds = each.select(F.col(start).cast("long").alias("_start"), F.col(end).cast("long").alias("_end"))
    listed = bounds.withColumn("_bucket", F.explode(F.sequence(_bucket_of("_start", width), _bucket_of("_end", width))))
    ordered = listed.repartition("_bucket").sortWithinPartitions("_bucket", "_start", "_end")
    pieces = ordered.mapInPandas(_sweep(width), "_start long, _end long, _bucket long, _from long, _to long")
    found = (pieces["_start"] == each[start]) & (pieces["_end"] == each[end])
    return each.join(pieces, found).select(*[each[c] for c in ranges.columns], "_bucket", "_from", "_to")


def _sweep(width: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Cuts ranges that come by bucket and start into pieces of the innermost ones."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, at, heap, out = None, 0, [], []

        def forward(stop: int) -> None:
            nonlocal at
            while heap and at < stop:
                begin, last = -heap[0][0], heap[0][1]
                if last < at:
                    heapq.heappop(heap)
                    continue
                to = min(last, stop - 1)
                out.append((begin, last, bucket, at, to))
                at = to + 1
            at = max(at, stop)

        def cut() -> pd.DataFrame:
            done = pd.DataFrame(out, columns=["_start", "_end", "_bucket", "_from", "_to"], dtype="int64")
            out.clear()
            return done

        for batch in batches:
            for begin, last, of in zip(batch["_start"], batch["_end"], batch["_bucket"], strict=True):
                if of != bucket:
                    if bucket is not None:
                        forward((bucket + 1) * width)
                    heap.clear()
                    bucket, at = of, of * width
                forward(max(begin, of * width))
                heapq.heappush(heap, (-begin, last))
            yield cut()
        if bucket is not None:
            forward((bucket + 1) * width)
            yield cut()

    return rows


def province_of_ip(rows: DataFrame, ranges: DataFrame, *, unknown: str = "0", nested: bool = False) -> DataFrame:
    """Add ``province`` for the IPv4 text in ``ip``, from rows ``ip_start, ip_end, region``; no match gives ``0``.

    ``nested`` is for tables in which a network lies inside another one: the innermost counts.
    """
    numbered = rows.withColumn("_ip", ipv4_number("ip"))
    found = range_lookup(numbered, ranges, point="_ip", start="ip_start", end="ip_end", nested=nested)
    province = F.coalesce(region_province("region"), F.lit(unknown))
    return found.withColumn("province", province).select(*rows.columns, "province")


def add_full_outer(history: DataFrame, batch: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Totals of both sides per key, a missing side counting as 0. Each side has one row per key."""
    h, b = history.withColumnRenamed(value, "_h"), batch.withColumnRenamed(value, "_b")
    total = F.coalesce("_h", F.lit(0)) + F.coalesce("_b", F.lit(0))
    return h.join(b, list(keys), "full").select(*keys, total.alias(value))
