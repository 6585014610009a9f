"""Grouped operators: counts, ordered picks, salted aggregation, top-k per group, list columns and word counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursemill.functions.columns import tokens, whole_div
from coursemill.session import workspace


def count_by(df: DataFrame, keys: Sequence[str], counted: str, name: str) -> DataFrame:
    """Non-null ``counted`` per key tuple. Columns stay columns: keys are never glued into one string."""
    return df.groupBy(*keys).agg(F.count(counted).alias(name))


def pick_one(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest in column order, hence the same one in every run."""
    values = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*values)).alias("r"))
    return picked.select(*keys, *[F.col(f"r.{v}").alias(v) for v in values])


def two_phase_count(df: DataFrame, keys: Sequence[str], name: str, *, spread_by: Sequence[str], salts: int = 3):
    """Count per key in two shuffles: by key and salt, then by key."""
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    partial = df.withColumn("_salt", salt).groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    return partial.groupBy(*keys).agg(F.sum("_n").alias(name))


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rownum") -> DataFrame:
    """First ``k`` rows per group by row number.

    The rank filter sits right on the window, so Spark cuts each map task's groups to ``k`` rows before the shuffle:
    a group with a third of all rows sends ``k`` rows per task.
    """
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def dense_top(
    df: DataFrame, keys: Sequence[str], value: str, k: int, *, descending: bool, name: str = "rk"
) -> DataFrame:
    """All rows whose ``value`` is among the ``k`` best distinct values of their group, with its dense rank.

    Ties are unlimited, so ranking whole rows could put a third of the table into one window. Only distinct
    (group, value) pairs are ranked, after partial aggregation; the at most ``k`` pairs kept per group are then joined
    back by equality, which Spark broadcasts or splits by size.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    pairs = df.select(*keys, value).distinct()
    ranked = pairs.withColumn(name, F.dense_rank().over(W.partitionBy(*keys).orderBy(order))).where(F.col(name) <= k)
    left, right = df.alias("l"), ranked.alias("r")
    same = F.lit(True)
    for c in [*keys, value]:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, same).select(*[F.col(f"l.{c}") for c in df.columns], F.col(f"r.{name}"))


def joined_lists(df: DataFrame, keys: Sequence[str], item: str, name: str, *, parts: int = 1) -> DataFrame:
    """Sorted comma list of ``item`` per group, duplicates kept, nulls left out, in ``parts`` slices of like length.

    Slices follow each other in the order of the items and are numbered from 0 in ``part``; a group with fewer items than
    slices has fewer. The shape depends on ``parts`` alone, never on the size of a group: declare more slices where one
    list would be too long a value. One slice is one value, so a group then is one task's work in one shuffle; of more
    slices, none needs its whole group in one task (``placed_items``).
    """
    keys = list(keys)
    if parts == 1:
        items = F.transform(F.sort_array(F.collect_list(item)), lambda x: x.cast("string"))
        return df.groupBy(*keys, F.lit(0).cast("long").alias("part")).agg(F.array_join(items, ",").alias(name))
    rows = placed_items(df, keys, item, parts)
    each = F.sort_array(F.collect_list(F.when(F.col("_n") > 0, F.struct(F.col(item).alias("x"), F.col("_n").alias("n")))))
    items = F.flatten(F.transform(each, lambda x: F.array_repeat(x["x"].cast("string"), x["n"].cast("int"))))
    return rows.groupBy(*keys, "part").agg(F.array_join(items, ",").alias(name))


def placed_items(df: DataFrame, keys: Sequence[str], item: str, parts: int) -> DataFrame:
    """Distinct ``keys, item`` with the slice ``part`` they belong to and how often they occur in it (``_n``).

    Places come from prefix sums on two levels: equal items are counted, the counts are put in order by range over at least
    ``parts`` tasks, and the sums of a group in earlier ranges are added to the running sum within its range. A range, and not a
    group, is the largest piece of work. An item that occurs over a border is in all slices that it reaches. Ranges
    are sampled, so they are written down once, and tasks that run again find the same ones.
    """
    spark = df.sparkSession
    keys = list(keys)
    counted = df.groupBy(*keys, item).agg(F.count(item).alias("_n"))
    tasks = max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = counted.repartitionByRange(tasks, *keys, F.col(item).asc_nulls_last()).withColumn("_range", F.spark_partition_id())
    path = f"{workspace(spark, 'slices')}/ranges"
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    names = [f"_k{i}" for i in range(len(keys))]
    sums = ranged.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col("_range").alias("_r")).agg(F.sum("_n").alias("_sum"))
    group = W.partitionBy(*names)
    sums = sums.select(
        *names, "_r", F.sum("_sum").over(group).alias("_total"),
        F.coalesce(F.sum("_sum").over(group.orderBy("_r").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"),
    )
    same = F.col("_range") == F.col("_r")
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    within = W.partitionBy(*keys, "_range").orderBy(F.col(item).asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    begin = F.coalesce(F.sum("_n").over(within), F.lit(0))
    summed = ranged.withColumn("_begin", begin).join(sums, same).withColumn("_begin", F.col("_begin") + F.col("_base"))
    # place j of a group of t is in slice floor(j * parts / t), which begins at place ceil(part * t / parts)
    total, first = F.col("_total"), F.col("_begin")
    slice_of = lambda place: whole_div(place * parts, total)
    starts = lambda part: whole_div(part * total + (parts - 1), F.lit(parts))
    reach = F.when(F.col("_n") > 0, F.sequence(slice_of(first), slice_of(first + F.col("_n") - 1))).otherwise(F.array(F.lit(0).cast("long")))
    spread = summed.withColumn("part", F.explode(reach))
    count = F.least(starts(F.col("part") + 1), first + F.col("_n")) - F.greatest(starts(F.col("part")), first)
    return spread.select(*keys, item, "part", F.when(F.col("_n") > 0, count).otherwise(F.lit(0)).alias("_n"))


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each single-space token."""
    words = lines.where(F.col(text).isNotNull()).select(F.explode(tokens(text)).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
