import random

import pytest
from pyspark.sql import functions as F

from coursemill.operators.intervals import (
    covered_seconds,
    interval_sets,
    interval_text,
    islands,
    uncovered_pieces,
    watch_totals,
)
from tests.conftest import plan

SHAPES = [
    [(0, 10), (2, 5)],  # contained
    [(5, 10), (0, 7)],  # left
    [(0, 7), (5, 10)],  # right
    [(3, 5), (0, 9)],  # enclosing
    [(0, 5), (5, 9)],  # touching
    [(0, 3), (7, 9)],  # disjoint
    [(4, 9), (0, 9)],  # same end
    [(0, 3), (6, 9), (2, 7)],  # spanning two
    [(4, 4), (1, 9)],  # zero length
]


def cases():
    rng = random.Random(23)
    out = [list(s) for s in SHAPES]
    for _ in range(250):
        out.append([(a, a + rng.randrange(0, 12)) for a in (rng.randrange(0, 40) for _ in range(rng.randrange(1, 12)))])
    # a hot key: far more rows than the video has seconds
    out.append([(a, a + rng.randrange(0, 9)) for a in (rng.randrange(0, 120) for _ in range(3000))])
    return out


@pytest.fixture(scope="module")
def data(spark):
    all_cases = cases()
    flat = [(k, ps, pe) for k, case in enumerate(all_cases) for ps, pe in case]
    return all_cases, spark.createDataFrame(flat, "k int, ps int, pe int")


def seconds(case):
    return {s for ps, pe in case for s in range(ps, pe)}


def test_islands_cover_the_same_seconds_and_do_not_touch(data):
    all_cases, df = data
    got = {}
    for r in islands(df, ["k"]).collect():
        got.setdefault(r["k"], []).append((r["ps"], r["pe"]))
    for k, case in enumerate(all_cases):
        merged = sorted(got[k])
        assert seconds(merged) == seconds(case)
        assert all(a[1] < b[0] for a, b in zip(merged, merged[1:]))


def test_uncovered_seconds_against_sets(data):
    all_cases, df = data
    # even keys have history: the first half of their rows
    history_rows = [(k, ps, pe) for k, c in enumerate(all_cases) if k % 2 == 0 for ps, pe in c[: len(c) // 2]]
    spark = df.sparkSession
    history = interval_sets(islands(spark.createDataFrame(history_rows, "k int, ps int, pe int"), ["k"]), ["k"])
    pieces = uncovered_pieces(df.distinct(), ["k"], history).collect()
    got = {(r["k"], r["ps"], r["pe"]): r["new_seconds"] for r in pieces}
    assert len(got) == len(pieces)
    for k, case in enumerate(all_cases):
        known = seconds(case[: len(case) // 2]) if k % 2 == 0 else set()
        for ps, pe in sorted(set(case)):
            fresh = set(range(ps, pe)) - known
            assert got[(k, ps, pe)] == len(fresh), (k, ps, pe)
            known |= fresh


def brute_totals(rows):
    """Row by row in (ps, pe, ts, te) order."""
    seen, total, effective, complete = set(), 0, 0, 0
    for n, (ps, pe, ts, te) in enumerate(sorted(rows)):
        secs, fresh = (te - ts) // 1000, set(range(ps, pe)) - seen
        total += secs
        complete += len(fresh)
        effective += secs if n == 0 else (secs * len(fresh) // (pe - ps) if pe != ps else 0)
        seen |= fresh
    return total, effective, complete


def test_watch_totals_against_brute_force(data):
    all_cases, df = data
    rng = random.Random(29)
    timed = []
    for k, case in enumerate(all_cases):
        for ps, pe in case:
            ts = rng.randrange(0, 50) * 1000
            timed.append((k, ps, pe, ts, ts + rng.randrange(0, 90_000)))
    frame = df.sparkSession.createDataFrame(timed, "k int, ps int, pe int, ts long, te long")
    got = {r["k"]: tuple(r)[1:] for r in watch_totals(frame, ["k"]).collect()}
    for k in range(len(all_cases)):
        assert got[k] == brute_totals([t[1:] for t in timed if t[0] == k]), k


def test_worked_example_with_history(spark):
    first = spark.createDataFrame([(1, 30, 100, 1563352128131, 1563352144131)], "k int, ps int, pe int, ts long, te long")
    second = spark.createDataFrame([(1, 30, 110, 1564456120128, 1564456140128)], "k int, ps int, pe int, ts long, te long")
    assert tuple(watch_totals(first, ["k"]).first()) == (1, 16, 16, 70)
    history = interval_sets(islands(first, ["k"]), ["k"])
    assert tuple(watch_totals(second, ["k"], history).first()) == (1, 20, 2, 10)
    both = tuple(watch_totals(first.union(second), ["k"]).first())
    assert both == (1, 36, 18, 80)


def test_covered_seconds_and_text(spark):
    df = spark.range(1).select(F.expr("array(named_struct('s', 0, 'e', 5), named_struct('s', 8, 'e', 9))").alias("i"))
    got = df.select(covered_seconds(F.col("i"), F.lit(3).cast("long"), F.lit(20).cast("long")), interval_text("i")).first()
    assert tuple(got) == (3, "0-5,8-9")


def test_watch_totals_take_two_shuffles(spark):
    rows_ = spark.createDataFrame([(1, 0, 9, 0, 9000)], "k int, ps int, pe int, ts long, te long")
    assert plan(watch_totals(rows_, ["k"])).count("Exchange hashpartitioning") == 2
    assert plan(uncovered_pieces(rows_.select("k", "ps", "pe").distinct(), ["k"])).count("Exchange hashpartitioning") == 2
