"""The real-time jobs from source to published result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from coursemill.sinks.tables import exists, fold_changes, publish_changes
from coursemill.streaming import answers, archive, learning, pages, register
from coursemill.streaming.runner import INTERVALS, start


def _changes(path: str) -> Callable[[DataFrame, int], None]:
    return lambda rows, batch: publish_changes(rows, path, batch, compact=True)


def _run(job: str, name: str, df: DataFrame, publish, out: str, mode: str, once: bool) -> StreamingQuery:
    interval = None if once else INTERVALS[job]
    return start(df, publish, checkpoint=f"{out}/_checkpoint_{name}", mode=mode, interval=interval)


def register_job(lines: DataFrame, out: str, once: bool = False) -> list[StreamingQuery]:
    """Running sign-up counts, and counts of the last minute by arrival time."""
    arrived = register.register_events(lines.withColumn("ts", F.current_timestamp()), ("ts",))
    running = register.running_counts(arrived)
    sliding = register.sliding_counts(arrived, "ts", late=f"{register.WINDOW_SECONDS} seconds")
    return [
        _run("register", "running", running, _changes(f"{out}/running"), out, "update", once),
        _run("register", "sliding", sliding, _changes(f"{out}/sliding"), out, "update", once),
    ]


def page_job(lines: DataFrame, ranges: DataFrame, out: str, once: bool = False) -> list[StreamingQuery]:
    """Jumps, from which funnel rates follow, and clicks per province, from which the top ones do."""
    events = pages.page_events(lines)
    jumps, clicks = pages.publish_jumps(f"{out}/funnel"), pages.publish_clicks(f"{out}/provinces", ranges)
    return [
        _run("page", "funnel", pages.page_jumps(events), jumps, out, "update", once),
        _run("page", "provinces", events.select("ip"), clicks, out, "append", once),
    ]


def answer_job(lines: DataFrame, out: str, once: bool = False) -> list[StreamingQuery]:
    """With each batch the points it touched: their detail and their question lists, from a state per point."""
    totals = answers.point_totals(answers.answer_events(lines))
    return [_run("answer", "points", totals, answers.publish_points(f"{out}/points"), out, "update", once)]


def learn_job(lines: DataFrame, out: str, once: bool = False) -> list[StreamingQuery]:
    """Watched seconds per dimension, and watch time per video without repeated viewing."""
    events = learning.learn_events(lines)
    return [
        _run("learn", "dims", learning.seconds_by_dimension(events), _changes(f"{out}/dims"), out, "update", once),
        _run("learn", "videos", learning.watch_time_stream(events), _changes(f"{out}/videos"), out, "update", once),
    ]


def archive_job(lines: DataFrame, topic: str, out: str, once: bool = False) -> list[StreamingQuery]:
    rows = archive.archive_rows(lines, topic)
    interval = None if once else INTERVALS["archive"]
    return [archive.start_archive(rows, f"{out}/raw", f"{out}/_checkpoint_raw", interval=interval)]


# change logs of each job below its output folder: their keys, and whether the amounts of batches add up
RESULTS = {
    "register": {"running": (["app_name"], False), "sliding": (["window_start", "window_end", "app_name"], False)},
    "page": {"funnel": (pages.PAGE_IDS, False), "provinces": (["province"], True)},
    "answer": {"points": (answers.POINT_KEYS, False)},
    "learn": {"dims": (["dim", "key"], False), "videos": (learning.VIDEO_KEYS, False)},
}


def fold_job(spark: SparkSession, job: str, out: str) -> None:
    """Upkeep of a job's results, beside the running job: fold what its batches have recorded since the last time."""
    for name, (keys, additive) in RESULTS[job].items():
        if exists(spark, f"{out}/{name}/changes"):
            fold_changes(spark, f"{out}/{name}", keys, additive)
