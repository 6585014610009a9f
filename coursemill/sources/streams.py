"""One factory for the line streams the jobs read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# messages, and files, of one micro-batch unless told otherwise
PER_TRIGGER = {"kafka": 1_000_000, "files": 100}


def line_stream(
    spark: SparkSession,
    kind: str,
    where: str,
    *,
    servers: str | None = None,
    per_trigger: int | None = None,
    starting: str = "earliest",
) -> DataFrame:
    """Unbounded frame with a ``value`` string column.

    ``kind="kafka"``: ``where`` is the topic. ``kind="files"``: ``where`` is a folder of text files. Every stream is
    rate limited (messages or files per micro-batch), so a backlog is cut into bounded ones. Offsets live in the query's checkpoint, so no offset
    table is kept and ``starting`` only matters for the first run.
    """
    if kind not in PER_TRIGGER:
        raise ValueError(f"unknown stream kind: {kind}")
    limit = per_trigger or PER_TRIGGER[kind]
    if kind == "kafka":
        return (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", where)
            .option("startingOffsets", starting)
            .option("maxOffsetsPerTrigger", limit)
            .load()
            .select(F.col("value").cast("string").alias("value"))
        )
    return spark.readStream.option("maxFilesPerTrigger", limit).text(where)
