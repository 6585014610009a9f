"""Watched intervals of videos: unions, newly covered seconds and watch totals.

Positions are whole seconds inside one video, so a video of L seconds has at most L different starts. Every operator
first reduces rows to one per (key, start) or (key, start, end) with partial aggregation, so what a window over one key
then sees is bounded by the video's length, however many rows a hot key has. Windows stream and spill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursemill.functions.columns import watch_seconds, whole_div

INTERVALS = "array<struct<s:int,e:int>>"


def islands(rows: DataFrame, keys: Sequence[str], start: str = "ps", end: str = "pe") -> DataFrame:
    """Union of the intervals per key as rows ``start, end``; overlapping and touching ones are one."""
    keys = list(keys)
    longest = rows.where(F.col(start) <= F.col(end)).groupBy(*keys, start).agg(F.max(end).alias(end))
    by_start = W.partitionBy(*keys).orderBy(start)
    earlier = by_start.rowsBetween(W.unboundedPreceding, -1)
    gap = F.coalesce(F.max(end).over(earlier) < F.col(start), F.lit(False))
    marked = longest.withColumn("_gap", gap.cast("int"))
    numbered = marked.withColumn("_island", F.sum("_gap").over(by_start.rowsBetween(W.unboundedPreceding, 0)))
    merged = numbered.groupBy(*keys, "_island").agg(F.min(start).alias(start), F.max(end).alias(end))
    return merged.drop("_island")


def interval_sets(islands_: DataFrame, keys: Sequence[str], start: str = "ps", end: str = "pe") -> DataFrame:
    """Disjoint intervals of each key as one sorted array column ``intervals`` (at most L / 2 elements)."""
    pair = F.struct(F.col(start).cast("int").alias("s"), F.col(end).cast("int").alias("e"))
    return islands_.groupBy(*keys).agg(F.sort_array(F.collect_list(pair)).alias("intervals"))


def interval_text(intervals: Column | str) -> Column:
    """``s-e,s-e`` as the result tables store it."""
    each = F.transform(intervals, lambda i: F.concat_ws("-", i["s"].cast("string"), i["e"].cast("string")))
    return F.array_join(each, ",")


def covered_seconds(intervals: Column, lo: Column, hi: Column) -> Column:
    """Seconds of [lo, hi) inside a set of disjoint intervals."""
    def overlap(total, i):
        inside = F.least(i["e"].cast("long"), hi) - F.greatest(i["s"].cast("long"), lo)
        return total + F.greatest(F.lit(0).cast("long"), inside)

    return F.aggregate(intervals, F.lit(0).cast("long"), overlap)


def uncovered_pieces(
    pairs: DataFrame, keys: Sequence[str], history: DataFrame | None = None, start: str = "ps", end: str = "pe"
) -> DataFrame:
    """Add ``new_seconds`` and ``first_of_key`` to distinct (key, start, end) rows.

    ``new_seconds`` is what the row covers beyond history and beyond the key's earlier rows in (start, end) order: a sweep
    over the rows of a key, put in order once. The furthest end reached by smaller starts is a running maximum over the range
    of starts before; within one start it is the previous end. Both windows, and an aggregation by key that follows,
    share the one shuffle by key. ``history`` has the disjoint ``intervals`` of a key. Rows without a key or start are left out.
    """
    keys = list(keys)
    for c in (*keys, start):
        pairs = pairs.where(F.col(c).isNotNull())
    smaller = W.partitionBy(*keys).orderBy(start).rangeBetween(W.unboundedPreceding, -1)
    both = pairs.withColumn("_reached", F.max(end).over(smaller))
    both = both.withColumn("_before", F.lag(end).over(W.partitionBy(*keys, start).orderBy(end)))
    if history is not None:
        both = both.join(history.select(*keys, "intervals"), keys, "left")
    else:
        both = both.withColumn("intervals", F.lit(None).cast(INTERVALS))
    hi = F.col(end).cast("long")
    lo = F.greatest(F.col(start), F.col("_reached"), F.col("_before")).cast("long")
    known = F.coalesce(covered_seconds(F.col("intervals"), lo, hi), F.lit(0))
    new = F.when(lo < hi, hi - lo - known).otherwise(F.lit(0).cast("long"))
    fresh = F.col("_reached").isNull() & F.col("_before").isNull() & F.col("intervals").isNull()
    return both.withColumn("new_seconds", new).withColumn("first_of_key", fresh).drop(
        "_before", "_reached", "intervals"
    )


def watch_pairs(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows reduced to one per (key, ps, pe): all watched seconds and those of its first row in (ts, te) order."""
    secs = watch_seconds("ts", "te")
    return rows.groupBy(*keys, "ps", "pe").agg(
        F.sum(secs).alias("secs"), F.min_by(secs, F.struct("ts", "te")).alias("first_secs")
    )


def watch_totals(rows: DataFrame, keys: Sequence[str], history: DataFrame | None = None) -> DataFrame:
    """Total, effective and complete seconds that ``rows`` add per key.

    Rows of a key count in (ps, pe, ts) order. ``complete`` is newly covered seconds; ``effective`` is
    ``secs * new / (pe - ps)`` per row in whole seconds. Of equal (ps, pe) rows only the first covers anything new,
    so one row per pair carries all that is needed. The very first row of a key keeps all its seconds as effective.
    """
    pieces = uncovered_pieces(watch_pairs(rows, keys), keys, history)
    part = F.coalesce(whole_div(F.col("first_secs") * F.col("new_seconds"), F.col("pe") - F.col("ps")), F.lit(0))
    effective = F.when(F.col("first_of_key"), F.col("first_secs")).otherwise(part)
    return pieces.groupBy(*keys).agg(
        F.sum("secs").alias("totaltime"),
        F.sum(effective).alias("effecttime"),
        F.sum("new_seconds").alias("completetime"),
    )
