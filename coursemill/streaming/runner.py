"""Starting streaming queries: triggers, checkpoints and idempotent batch publication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

# Micro-batch intervals of the jobs.
INTERVALS = {
    "register": "3 seconds",
    "page": "10 seconds",
    "answer": "30 seconds",
    "learn": "3 seconds",
    "archive": "3 seconds",
}


def start(
    df: DataFrame,
    publish: Callable[[DataFrame, int], None],
    *,
    checkpoint: str,
    mode: str = "update",
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Run ``publish(rows, batch_id)`` per micro-batch; without ``interval`` all available input is worked off once.

    ``publish`` must be idempotent per batch id: after a failure Spark hands in the same batch again. An error in it
    fails the query, so offsets never move past lost data. The checkpoint holds offsets and state.
    """
    writer = df.writeStream.outputMode(mode).foreachBatch(publish).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
