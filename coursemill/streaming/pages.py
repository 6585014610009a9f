"""Page jumps, funnel rates and clicks per province."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions.columns import percent_text
from coursemill.operators.joins import province_of_ip
from coursemill.sinks.tables import additive_totals, latest_rows, publish_changes
from coursemill.sources.lines import json_fields

# Fields of a page message, and the funnel's pages in order.
PAGE_FIELDS = ["uid", "app_id", "device_id", "ip", "last_page_id", "page_id", "next_page_id"]
PAGE_IDS = ["last_page_id", "page_id", "next_page_id"]
FUNNEL = [1, 2, 3]


def page_events(lines: DataFrame) -> DataFrame:
    """Page messages with absent fields as empty text, without those that lack one of the three pages."""
    filled = json_fields(lines, PAGE_FIELDS).select(*[F.coalesce(f, F.lit("")).alias(f) for f in PAGE_FIELDS])
    for page in PAGE_IDS:
        filled = filled.where(F.col(page) != "")
    return filled


def page_jumps(events: DataFrame) -> DataFrame:
    """Jumps per (last, current, next) page."""
    return events.groupBy(*PAGE_IDS).agg(F.count(F.lit(1)).alias("num"))


def page_totals(jumps: DataFrame) -> DataFrame:
    return jumps.groupBy("page_id").agg(F.sum("num").alias("num"))


def funnel_rates(totals: DataFrame) -> DataFrame:
    """Conversion into each funnel page: the first is 100%, each next one is its total over the previous total.

    The three totals are picked out by conditional sums into one row and unfolded again, so pages without any visit
    still get a rate and no join is needed. ``totals`` has one row per page.
    """
    first, rest = FUNNEL[0], FUNNEL[1:]
    page = F.col("page_id").try_cast("int")
    sums = totals.agg(*[F.coalesce(F.sum(F.when(page == p, F.col("num"))), F.lit(0)).alias(f"n{p}") for p in FUNNEL])

    def row(p: int, rate: Column) -> Column:
        return F.struct(F.lit(p).alias("page_id"), F.col(f"n{p}").alias("num"), rate.alias("jump_rate"))

    rows = [row(first, F.lit("100%"))]
    rows += [row(p, percent_text(f"n{p}", f"n{before}")) for before, p in zip(FUNNEL, rest)]
    return sums.select(F.inline(F.array(*rows)))


def province_clicks(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Clicks per province. Clicks are counted per address before the lookup, so a hot address is one row in it."""
    per_ip = events.groupBy("ip").agg(F.count(F.lit(1)).alias("_n"))
    found = province_of_ip(per_ip, ranges)
    return found.groupBy("province").agg(F.sum("_n").alias("num"))


def top_provinces(clicks: DataFrame, k: int = 3) -> DataFrame:
    return clicks.orderBy(F.col("num").desc(), F.col("province").asc()).limit(k)


def publish_jumps(root: str):
    """Publisher for update-mode jump counts: each batch records only the jumps it changed."""
    return lambda rows, batch: publish_changes(rows, root, batch, compact=True)


def published_jumps(spark: SparkSession, root: str) -> DataFrame:
    return latest_rows(spark, root, PAGE_IDS)


def published_pages(spark: SparkSession, root: str) -> DataFrame:
    """Totals of all pages, and the rates of those in the funnel."""
    totals = page_totals(published_jumps(spark, root))
    rates = funnel_rates(totals).select(F.col("page_id").cast("string"), "jump_rate")
    return totals.join(rates, "page_id", "left")


def publish_clicks(root: str, ranges: DataFrame):
    """Publisher for the events of each batch: clicks are counted per address, looked up and recorded per province.

    A batch counts before the lookup, so a busy address block is a few rows in it, and no state is kept: amounts add up on reading.
    """
    return lambda events, batch: publish_changes(province_clicks(events, ranges), root, batch, compact=True)


def published_clicks(spark: SparkSession, root: str) -> DataFrame:
    return additive_totals(spark, root, ["province"])
