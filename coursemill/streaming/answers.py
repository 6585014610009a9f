"""Answer mastery per user, course and point."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions.columns import now_text, ratio
from coursemill.operators.grouping import joined_lists
from coursemill.sinks.tables import latest_rows, publish_changes
from coursemill.sources.lines import tsv_fields

# Fields of an answer message, and the questions every point is taken to have.
ANSWER_FIELDS = ["userid", "courseid", "pointid", "questionid", "istrue", "createtime"]
POINT_KEYS = ["userid", "courseid", "pointid"]
QUESTION_KEYS = [*POINT_KEYS, "questionid"]
QUESTIONS_PER_POINT = 10


def answer_events(lines: DataFrame) -> DataFrame:
    return tsv_fields(lines, ANSWER_FIELDS)


def question_totals(events: DataFrame) -> DataFrame:
    """Answers, right answers and first time per question: distinct questions become a plain count of rows."""
    return events.groupBy(*QUESTION_KEYS).agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(F.col("istrue") == "1").alias("right"),
        F.min("createtime").alias("createtime"),
    )


def point_totals(events: DataFrame) -> DataFrame:
    """Totals of a point with the ids of its questions: the state of the answer job, a row per point.

    A batch adds to the points that it names and hands those out whole, so nothing that was published is read again. The
    set holds a point's distinct questions, about ten, not its answers; answers are combined before the shuffle.
    """
    unnamed = F.col("questionid").isNull()
    totals = events.groupBy(*POINT_KEYS).agg(
        F.count(F.lit(1)).alias("qz_sum"),
        F.collect_set("questionid").alias("questions"),
        F.max(unnamed.cast("int")).alias("_unnamed"),
        F.count_if(F.col("istrue") == "1").alias("qz_istrue"),
        F.min("createtime").alias("createtime"),
    )
    count = (F.size("questions") + F.col("_unnamed")).cast("bigint")
    return totals.withColumn("qz_count", count).withColumn("questions", F.sort_array("questions")).drop("_unnamed")


def mastery(questions: DataFrame) -> DataFrame:
    """Totals, distinct questions, right answers, correct rate and mastery per point."""
    totals = questions.groupBy(*POINT_KEYS).agg(
        F.sum("answers").alias("qz_sum"),
        F.count(F.lit(1)).alias("qz_count"),
        F.sum("right").alias("qz_istrue"),
        F.min("createtime").alias("createtime"),
    )
    return with_rates(totals)


def with_rates(totals: DataFrame) -> DataFrame:
    correct = F.col("qz_istrue").cast("double") / F.col("qz_sum").cast("double")
    return (
        totals.withColumn("correct_rate", correct)
        .withColumn("mastery_rate", F.col("qz_count").cast("double") / QUESTIONS_PER_POINT * F.col("correct_rate"))
        .withColumn("correct_percent", ratio("qz_istrue", "qz_sum"))
    )


def with_update_time(points: DataFrame) -> DataFrame:
    return points.withColumn("updatetime", now_text())


def question_history(questions: DataFrame, parts: int = 1) -> DataFrame:
    """Comma list of the distinct questions per point, as the history table stores it, with the first time.

    ``parts`` cuts long lists into slices (``joined_lists``); a point is taken to have ten questions.
    """
    lists = joined_lists(questions, POINT_KEYS, "questionid", "questionids", parts=parts)
    first = questions.groupBy(*POINT_KEYS).agg(F.min("createtime").alias("createtime"))
    return lists.join(first, POINT_KEYS)


def publish_points(root: str):
    """Publisher of the answer job: the whole row of every point that the batch touched, and nothing is read back."""
    def publish(rows: DataFrame, batch: int) -> None:
        publish_changes(with_update_time(with_rates(rows)), root, batch, compact=True)

    return publish


def published_points(spark, root: str) -> DataFrame:
    """The detail of every point, with the time of its last update."""
    return latest_rows(spark, root, POINT_KEYS).drop("questions")


def published_history(spark, root: str) -> DataFrame:
    """The question list of every point, as ``question_history`` gives it in one part."""
    rows = latest_rows(spark, root, POINT_KEYS)
    return rows.select(*POINT_KEYS, F.lit(0).cast("bigint").alias("part"), F.array_join("questions", ",").alias("questionids"), "createtime")
