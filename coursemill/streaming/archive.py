"""Raw archive: message values as compressed text under ``<base>/topic=<topic>/dt=<day>/``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursemill.functions.columns import day_of_millis


def archive_rows(lines: DataFrame, topic: str, millis: str | None = None) -> DataFrame:
    """Values with their topic and day; the day is that of the batch unless ``millis`` names a time column."""
    now = (F.current_timestamp().cast("double") * 1000).cast("long")
    day = day_of_millis(F.col(millis) if millis else now)
    return lines.select("value", F.lit(topic).alias("topic"), day.alias("dt"))


def write_archive(rows: DataFrame, base: str, codec: str = "gzip") -> None:
    rows.write.mode("append").option("compression", codec).partitionBy("topic", "dt").text(base)


def start_archive(
    rows: DataFrame, base: str, checkpoint: str, *, codec: str = "gzip", interval: str | None = None
) -> StreamingQuery:
    """File sink: its log makes each batch appear exactly once, and finished files are never appended to."""
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        rows.writeStream.format("text")
        .outputMode("append")
        .option("compression", codec)
        .option("path", base)
        .option("checkpointLocation", checkpoint)
        .partitionBy("topic", "dt")
        .trigger(**trigger)
        .start()
    )
