"""Reduced facts of append-only tables, kept up to date by what was appended since the last run.

A table that only grows is read as a stream of its files: the checkpoint knows which ones are folded in already, so a run
opens the new files and the stored facts, whatever the age of the table. Facts must be mergeable: reducing the results of
parts gives the result of the whole. A run writes them as a new version, whose cost follows the number of members.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from coursemill.sinks.tables import latest_version, publish_snapshot, read_snapshot
from coursemill.streaming.runner import start

Reduce = Callable[[DataFrame], DataFrame]


def fold_appended(
    spark: SparkSession, table: str, schema: str, root: str, columns: Reduce, reduce: Reduce
) -> StreamingQuery:
    """Fold the files of ``table`` that no earlier run has seen into the facts below ``root``; the finished query comes back.

    ``columns`` picks what is needed, before files are opened; ``reduce`` makes facts of rows and of facts. Versions are
    named by the micro-batch: one that is handed in again after a lost driver finds its version announced and does nothing,
    or writes it over. Late files and files of any day count, once each. A table that is deleted and loaded anew needs a
    new ``root``, as its files would be added to what the old ones gave.
    """

    def publish(rows: DataFrame, batch: int) -> None:
        session = rows.sparkSession
        last = latest_version(session, root)
        if last is not None and int(last) >= batch:
            return
        facts = reduce(rows)
        if last is not None:
            facts = reduce(read_snapshot(session, root).unionByName(facts))
        publish_snapshot(facts, root, str(batch))

    stream = columns(spark.readStream.schema(schema).parquet(table))
    query = start(stream, publish, checkpoint=f"{root}/_checkpoint", mode="append")
    query.awaitTermination()
    return query


def read_facts(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The facts as last published; none where the table has had no file yet."""
    return read_snapshot(spark, root, schema)
