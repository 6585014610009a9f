import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from coursemill.operators.grouping import (
    count_by,
    dense_top,
    joined_lists,
    placed_items,
    pick_one,
    top_rows,
    two_phase_count,
    word_count,
)
from coursemill.session import workspace
from tests.conftest import plan


@pytest.fixture(scope="module")
def scores(spark):
    """A third of all rows in one group, many ties, a null score and a null group."""
    rng = random.Random(11)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 9), rng.randrange(0, 12), i) for i in range(600)]
    data += [(None, 5, 600), (1, None, 601)]
    return data, spark.createDataFrame(data, "g int, s int, u int")


def test_keys_with_underscores_and_nulls_stay_apart(spark, rows):
    df = spark.createDataFrame([("a_b", "c", 1), ("a", "b_c", 2), (None, "c", 3), ("null", "c", 4), ("x", "c", None)], "p string, q string, u int")
    assert rows(count_by(df, ["p", "q"], "u", "n")) == [
        (None, "c", 1), ("a", "b_c", 1), ("a_b", "c", 1), ("null", "c", 1), ("x", "c", 0),
    ]


def test_pick_one_is_the_smallest_row(spark, rows):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 9), (1, "a", 3), (2, None, 1)], "k int, x string, y int")
    assert rows(pick_one(df, ["k"])) == [(1, "a", 3), (2, None, 1)]


def test_top_rows_breaks_ties_by_order_and_limits_before_the_shuffle(scores):
    data, df = scores
    top = top_rows(df, ["g"], [F.col("s").desc(), F.col("u")], 3)
    got = defaultdict(list)
    for r in top.collect():
        got[r["g"]].append((r["rownum"], r["u"]))
    for g in {d[0] for d in data}:
        best = sorted((d for d in data if d[0] == g), key=lambda d: (-(d[1] if d[1] is not None else -1), d[2]))[:3]
        assert sorted(got[g]) == [(i + 1, d[2]) for i, d in enumerate(best)]
    assert "Partial" in plan(top) and "WindowGroupLimit" in plan(top)


@pytest.mark.parametrize("descending", [True, False])
def test_dense_top_keeps_all_ties(scores, descending):
    data, df = scores
    got = Counter((r["g"], r["s"], r["u"], r["rk"]) for r in dense_top(df, ["g"], "s", 3, descending=descending).collect())
    want = Counter()
    for g in {d[0] for d in data}:
        values = sorted({d[1] for d in data if d[0] == g}, key=lambda v: -1 if v is None else v, reverse=descending)[:3]
        want.update((g, s, u, values.index(s) + 1) for gg, s, u in data if gg == g and s in values)
    assert got == want


def test_joined_lists_single_part(spark, rows):
    df = spark.createDataFrame([(1, 3), (1, 1), (1, 3), (None, 2), (2, None)], "k int, u int")
    assert rows(joined_lists(df, ["k"], "u", "us")) == [(None, 0, "2"), (1, 0, "1,3,3"), (2, 0, "")]


def test_joined_lists_in_declared_slices(spark):
    data = [(1, u) for u in range(500)] + [(1, 7)] * 130 + [(2, 4), (2, 5), (3, None), (None, 9)]
    df = spark.createDataFrame(data, "k int, u int").repartition(5)
    out = joined_lists(df, ["k"], "u", "us", parts=4)
    got = {(r["k"], r["part"]): r["us"] for r in out.collect()}
    whole = ",".join(got[1, p] for p in range(4)).split(",")
    assert whole == [str(u) for u in sorted(u for k, u in data if k == 1)]
    assert max(len(got[1, p].split(",")) for p in range(4)) <= 158
    assert got[2, 0] == "4" and got[2, 2] == "5" and got[3, 0] == "" and got[None, 0] == "9"
    assert plan(joined_lists(df, ["k"], "u", "us")).count("Exchange hashpartitioning") == 1


def test_a_third_of_the_rows_in_one_group_is_no_long_task(spark, rows, monkeypatch):
    """Sixty-four slices: no range holds a twentieth of the rows, and no slice more than its share of the group."""
    seen = []
    monkeypatch.setattr("coursemill.operators.grouping.workspace", lambda s, n: seen.append(workspace(s, n)) or seen[-1])
    hot = spark.range(20_000).selectExpr("1 as k", "cast(id * 7919 % 5000 as int) as u")
    rest = spark.range(40_000).selectExpr("cast(2 + id % 900 as int) as k", "if(id % 50 = 0, null, cast(id as int)) as u")
    df = hot.union(rest).repartition(6)
    placed = placed_items(df, ["k"], "u", 64)
    got = {r["part"]: (r["n"], r["least"], r["most"]) for r in placed.where("k = 1").groupBy("part").agg(F.sum("_n").alias("n"), F.min("u").alias("least"), F.max("u").alias("most")).collect()}
    assert len(got) == 64 and all(abs(n - 20_000 / 64) <= 1 for n, _, _ in got.values())
    assert all(got[p][2] <= got[p + 1][1] for p in range(63))
    ranges = spark.read.parquet(f"{seen[0]}/ranges").groupBy("_range").count().collect()
    assert len(ranges) > 40 and max(r["count"] for r in ranges) < 0.05 * sum(r["count"] for r in ranges)
    lists = joined_lists(df, ["k"], "u", "us", parts=64).where("k = 1").collect()
    assert sum(len(r["us"].split(",")) for r in lists) == 20_000


def test_two_phase_count_equals_plain_count(scores, rows):
    _, df = scores
    plain = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    assert rows(two_phase_count(df, ["g"], "n", spread_by=["u"])) == rows(plain)


def test_word_count(spark, rows):
    df = spark.createDataFrame([("a b  a ",), ("b",), (None,), ("",)], "value string")
    assert rows(word_count(df)) == [("", 2), ("a", 2), ("b", 2)]
