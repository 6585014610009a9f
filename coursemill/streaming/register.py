"""Sign-up counts per platform: running totals and sliding windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.columns import APP_PLATFORM_OTHER, APP_PLATFORMS, label
from coursemill.sources.lines import tsv_fields

# Window length and slide of the sign-up counts.
WINDOW_SECONDS, SLIDE_SECONDS = 60, 6


def register_events(lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``app_name`` per valid line of three fields."""
    fields = tsv_fields(lines, ["_first", "_code", "_third"], keep)
    return fields.select(*keep, label("_code", APP_PLATFORMS, APP_PLATFORM_OTHER).alias("app_name"))


def running_counts(events: DataFrame, key: str = "app_name") -> DataFrame:
    """Counts over all time; partial aggregation keeps the shuffle at one row per task and platform."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("num"))


def sliding_counts(events: DataFrame, ts: str, key: str = "app_name", late: str | None = None) -> DataFrame:
    """Counts per one-minute window sliding by six seconds, for streams (``late`` sets a watermark) and batches."""
    if late:
        events = events.withWatermark(ts, late)
    span = F.window(ts, f"{WINDOW_SECONDS} seconds", f"{SLIDE_SECONDS} seconds")
    counted = events.groupBy(span.alias("w"), key).agg(F.count(F.lit(1)).alias("num"))
    return counted.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "num")


def sliding_counts_paned(events: DataFrame, ts: str, key: str = "app_name") -> DataFrame:
    """The same windows for a bounded table, built from six-second panes.

    Rows are counted once per pane and only the pane counts are copied into their ten windows, where the direct form
    copies every row ten times before counting.
    """
    panes = events.groupBy(F.window(ts, f"{SLIDE_SECONDS} seconds").alias("p"), key).agg(
        F.count(F.lit(1)).alias("_n")
    )
    copies = F.explode(F.sequence(F.lit(0), F.lit(WINDOW_SECONDS // SLIDE_SECONDS - 1)))
    spread = panes.withColumn("_back", copies)
    start = F.col("p.start") - F.make_dt_interval(secs=F.col("_back") * SLIDE_SECONDS)
    windows = spread.groupBy(start.alias("window_start"), key).agg(F.sum("_n").alias("num"))
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(WINDOW_SECONDS))
    return windows.select("window_start", end.alias("window_end"), key, "num")
