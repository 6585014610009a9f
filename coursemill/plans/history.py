"""The payment history as stored: one immutable run per day, each with the rows the day closed and all open rows.

A closed row never changes again, so a day writes what it closed and the open rows, not the whole history: its cost
follows the number of members and not the age of the table. A day starts from the open rows of the day before it, so
running it again simply replaces its run. A day that comes late, or is run again, changes what the days after it started
from: ``publish_from`` merges those again too and announces all of them at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursemill.functions.columns import OPEN_END
from coursemill.operators.zipper import merge_open
from coursemill.sinks.tables import exists

_ROWS = "uid int, paymoney decimal(20,4), vip_level string, start_time string, end_time string"
_STORED = f"{_ROWS}, run string, state string, dn string"
_SCHEMA = f"{_ROWS}, dn string"


def publish_day(rows: DataFrame, root: str, dt: str) -> None:
    """Write a day's run below ``root`` and announce it once it is complete."""
    _announce(rows.sparkSession, root, [(dt, _write_run(rows, root))])


def publish_from(spark: SparkSession, root: str, dt: str, changes: Callable[[str], DataFrame]) -> list[str]:
    """Merge ``dt`` and, in order, every later day that is published already; the days that were merged come back.

    ``changes`` gives a day's rows (``zipper.day_changes``). Each run starts from the open rows of the one before it, as
    written, so a plan never spans days. Readers see the old runs until all new ones are there, and a job that is lost on
    the way leaves the history as it was. An in-order day merges itself only; a late one costs as much as the days after it.
    """
    days = sorted({dt, *(day for day in _runs(spark, root) if day > dt)})
    open_rows, done = open_before(spark, root, dt), []
    for day in days:
        run = _write_run(merge_open(open_rows, changes(day)), root)
        done.append((day, run))
        open_rows = _open_rows(spark, root, [run])
    _announce(spark, root, done)
    return days


def _write_run(rows: DataFrame, root: str) -> str:
    run = uuid.uuid4().hex
    state = F.when(F.col("end_time") == OPEN_END, "open").otherwise("closed")
    rows.withColumn("state", state).write.partitionBy("state", "dn").parquet(f"{root}/run={run}")
    return run


def _announce(spark: SparkSession, root: str, runs: list[tuple[str, str]]) -> None:
    """All runs in one file, so that a reader finds all of them or none."""
    notes = spark.createDataFrame(runs, "dt string, run string").coalesce(1)
    notes.withColumn("at", F.current_timestamp().cast("double")).write.mode("append").parquet(f"{root}/published")


def _runs(spark: SparkSession, root: str) -> dict[str, str]:
    """Latest run of each day: as many entries as there are days. A log that cannot be read is not an empty history."""
    if not exists(spark, f"{root}/published"):
        return {}
    notes = spark.read.parquet(f"{root}/published")
    return {r["dt"]: r["run"] for r in notes.groupBy("dt").agg(F.max_by("run", "at").alias("run")).collect()}


def _read(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], _STORED)
    paths = [f"{root}/run={run}" for run in runs]
    return spark.read.schema(_STORED).option("basePath", root).parquet(*paths)


def open_before(spark: SparkSession, root: str, dt: str) -> DataFrame:
    """Open rows as the last day before ``dt`` left them."""
    earlier = {day: run for day, run in _runs(spark, root).items() if day < dt}
    return _open_rows(spark, root, [earlier[max(earlier)]] if earlier else [])


def _open_rows(spark: SparkSession, root: str, runs: list[str]) -> DataFrame:
    return _read(spark, root, runs).where(F.col("state") == "open").select(*_names())


def read_all(spark: SparkSession, root: str) -> DataFrame:
    """Whole history: what every day closed, and what the last day left open."""
    runs = _runs(spark, root)
    if not runs:
        return spark.createDataFrame([], _SCHEMA)
    last = runs[max(runs)]
    live = (F.col("state") == "closed") | (F.col("run") == last)
    return _read(spark, root, list(runs.values())).where(live).select(*_names())


def _names() -> list[str]:
    return [part.split()[0] for part in _SCHEMA.split(", ")]
