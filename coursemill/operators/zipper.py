"""Slowly changing history ("zipper") of payments and levels per member and site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursemill.functions.columns import OPEN_END, dashed_date, money

COLUMNS = ["uid", "paymoney", "vip_level", "start_time", "end_time", "dn"]


def day_changes(pay: DataFrame, vip: DataFrame, dt: str) -> DataFrame:
    """One open row per member and site from the day's payments that have a known level."""
    paid = pay.where(F.col("dt") == dt).select("uid", "dn", "vip_id", money("paymoney").alias("paymoney"))
    levels = vip.select("vip_id", "dn", "vip_level")
    return (
        paid.join(levels, ["vip_id", "dn"])
        .groupBy("uid", "dn")
        .agg(F.sum("paymoney").alias("paymoney"), F.max("vip_level").alias("vip_level"))
        .withColumn("start_time", dashed_date(F.lit(dt)))
        .withColumn("end_time", F.lit(OPEN_END))
        .select(*COLUMNS)
    )


def undo_day(history: DataFrame, day: str) -> DataFrame:
    """History as it was before ``day`` (``yyyy-MM-dd``) was merged, so that a day can be merged again."""
    reopened = F.when(F.col("end_time") == day, F.lit(OPEN_END)).otherwise(F.col("end_time"))
    return history.where(F.col("start_time") != day).withColumn("end_time", reopened)


def merge_open(open_rows: DataFrame, day_rows: DataFrame) -> DataFrame:
    """Open rows and a day's rows as they stand after the day: at most one row per member closes.

    The second last row of a member closes at the start of the last one, which adds its money. Both inputs have about
    one row per member and site, so no member can form a large group.
    """
    by_start = W.partitionBy("uid", "dn").orderBy("start_time")
    is_last = F.col("_next").isNull()
    is_second_last = F.col("_next").isNotNull() & F.col("_after_next").isNull()
    zero = F.lit(0).cast("decimal(20,4)")
    added = F.coalesce("paymoney", zero) + F.coalesce("_prev_money", zero)
    merged = (
        open_rows.select(*COLUMNS)
        .unionByName(day_rows.select(*COLUMNS))
        .withColumn("_next", F.lead("start_time").over(by_start))
        .withColumn("_after_next", F.lead("start_time", 2).over(by_start))
        .withColumn("_prev", F.lag("start_time").over(by_start))
        .withColumn("_prev_money", F.lag("paymoney").over(by_start))
        .withColumn("end_time", F.when(is_second_last, F.col("_next")).otherwise(F.col("end_time")))
        .withColumn("paymoney", F.when(is_last & F.col("_prev").isNotNull(), added).otherwise(F.col("paymoney")))
    )
    return merged.withColumn("paymoney", F.col("paymoney").cast("decimal(20,4)")).select(*COLUMNS)


def merge_day(history: DataFrame, day_rows: DataFrame, day: str) -> DataFrame:
    """Whole history after one day. Closed rows cannot change, so they pass straight through and only open rows and
    the day's rows are shuffled. Days are merged in order; merging the latest day again gives the same history.
    """
    before = undo_day(history.select(*COLUMNS), day)
    closed = before.where(F.col("end_time") != OPEN_END)
    closed = closed.withColumn("paymoney", F.col("paymoney").cast("decimal(20,4)"))
    return closed.unionByName(merge_open(before.where(F.col("end_time") == OPEN_END), day_rows))
