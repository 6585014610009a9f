import random

import pytest
from pyspark.sql import functions as F

from coursemill.operators.joins import (
    add_full_outer,
    broadcast_within,
    disjoint_pieces,
    hot_keys,
    province_of_ip,
    range_lookup,
    salted_join,
)
from coursemill.plans import qz, sellcourse
from coursemill.plans.warehouse import Warehouse
from coursemill.registry import reports  # noqa: F401  (importing fills the book)
from coursemill.registry.book import CHECKS, QUERIES
from tests.conftest import plan
from tools.check_queries import bag


@pytest.fixture(scope="module")
def sales(spark):
    """A hot course with a third of the cart, courses missing on either side, carts without payment, two sites."""
    rng = random.Random(3)
    carts = []
    for i in range(900):
        course = 1 if i % 3 == 0 else rng.randrange(2, 60)
        carts.append((course, f"o{i}", "n", 1.0, 2.0, "t", "d1" if i % 10 else "d2", "a" if i % 7 else "b"))
    cart = spark.createDataFrame(
        carts, "courseid int, orderid string, coursename string, discount double, sellmoney double, createtime string, dt string, dn string"
    )
    course = spark.range(0, 40).select(
        F.col("id").cast("int").alias("courseid"), F.lit("name").alias("coursename"), F.lit("1").alias("status"),
        *[F.lit(7).alias(c) for c in ("pointlistid", "majorid", "chapterid", "edusubjectid", "teacherid")],
        *[F.lit("x").alias(c) for c in ("chaptername", "edusubjectname", "teachername", "coursemanager")],
        F.lit(9.5).alias("money"), F.lit("d1").alias("dt"), F.lit("a").alias("dn"),
    )
    pay = spark.range(0, 1200, 2).select(
        F.concat(F.lit("o"), "id").alias("orderid"), F.lit(0.5).alias("discount"), F.col("id").alias("paymoney"),
        F.lit("p").alias("createtime"), F.lit("d1").alias("dt"), F.when(F.col("id") % 8 == 0, "b").otherwise("a").alias("dn"),
    )
    return course, cart, pay


def test_all_sales_forms_give_the_same_rows(spark, rows, sales, tmp_path):
    course, cart, pay = sales
    want = rows(sellcourse.sell_detail(course, cart, pay, "d1"))
    assert len(want) == cart.where("dt = 'd1'").count()
    assert all(r[0] is not None for r in want)  # courseid of carts without a catalog row is kept
    assert rows(sellcourse.sell_detail_salted(course, cart, pay, "d1")) == want
    assert rows(sellcourse.sell_detail_salted(course, cart, pay, "d1", salts=7, hot_share=None)) == want
    assert rows(sellcourse.sell_detail_broadcast(course, cart, pay, "d1")) == want
    house = Warehouse(str(tmp_path), catalog_prefix="joins_")
    for name, df in (("cart", cart), ("pay", pay)):
        house.append_bucketed(df, name, "orderid", ("dt", "dn"))
    stored = [house.read_bucketed(spark, name) for name in ("cart", "pay")]
    assert rows(sellcourse.sell_detail_bucketed(course, *stored, "d1")) == want


def test_bucketed_tables_join_without_shuffle(spark, sales, tmp_path):
    course, cart, pay = sales
    house = Warehouse(str(tmp_path), catalog_prefix="noshuffle_", buckets=6)
    for name, df in (("cart", cart), ("pay", pay)):
        house.append_bucketed(df, name, "orderid", ("dt", "dn"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = [house.read_bucketed(spark, name) for name in ("cart", "pay")]
        text = plan(sellcourse.sell_detail_bucketed(course, *stored, "d1"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "hashpartitioning" not in text


def test_hot_keys_are_found_and_bounded(spark, rows, sales):
    _, cart, _ = sales
    assert rows(hot_keys(cart, ["courseid"], 0.1)) == [(1,)]
    assert hot_keys(cart, ["courseid"], 0.5).isEmpty()


def test_null_keys_are_spread_though_no_key_is_hot(spark, rows):
    small = spark.range(2000).selectExpr("id as k", "concat('n', id) as name")
    big = spark.range(4000).selectExpr("if(id % 2 = 0, null, id % 2000) as k", "id as v")
    got = salted_join(small, big, ["k"], "right", spread_by=["v"])
    assert "_salt" in plan(got) and rows(got) == rows(small.join(big, ["k"], "right"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = salted_join(small, big, ["k"], "right", spread_by=["v"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(r["count"] for r in tasks) < 1400  # of 4000 rows in four tasks, where nulls alone would be 2000
    assert "_salt" not in plan(salted_join(small, big.where("k is not null"), ["k"], "right", spread_by=["v"]))


def test_salted_inner_join_keeps_null_keys_out(spark, rows):
    big = spark.createDataFrame([(None, 1), (1, 2), (1, 3), (2, 4)], "k int, v int")
    small = spark.createDataFrame([(1, "a"), (None, "n")], "k int, w string")
    got = salted_join(small, big, ["k"], "inner", spread_by=["v"], salts=4, hot_share=0.3)
    assert rows(got, "k", "v", "w") == [(1, 2, "a"), (1, 3, "a")]
    outer = salted_join(small, big, ["k"], "right", spread_by=["v"], salts=4, hot_share=0.3)
    assert rows(outer, "k", "v", "w") == rows(small.join(big, ["k"], "right"), "k", "v", "w")
    with pytest.raises(ValueError):
        salted_join(small, big, ["k"], "left", spread_by=["v"])


def test_broadcast_only_within_the_bound(spark):
    df = spark.range(100).withColumn("x", F.lit("y"))
    big = spark.range(1000)
    for bounds, hinted in (({}, True), ({"max_rows": 99}, False), ({"max_bytes": 100}, False)):
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            assert ("BroadcastHashJoin" in plan(big.join(broadcast_within(df, **bounds), "id"))) is hinted
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_range_lookup_against_brute_force(spark, rows):
    rng = random.Random(5)
    cuts = sorted(rng.sample(range(0, 5000), 60))
    ranges = [(a, b - 1, f"r{a}") for a, b in zip(cuts[::2], cuts[1::2])]
    points = [(i, rng.randrange(-10, 5200)) for i in range(500)] + [(900 + i, r[0]) for i, r in enumerate(ranges)]
    points += [(2000 + i, r[1]) for i, r in enumerate(ranges)] + [(5000, None)]
    found = range_lookup(
        spark.createDataFrame(points, "id int, p long"), spark.createDataFrame(ranges, "a long, b long, name string"),
        point="p", start="a", end="b", width=64,
    )
    want = sorted(
        ((i, next((n for a, b, n in ranges if p is not None and a <= p <= b), None)) for i, p in points), key=str
    )
    assert sorted(((r["id"], r["name"]) for r in found.collect()), key=str) == want


def test_nested_ranges_against_brute_force(spark, rows):
    rng = random.Random(8)
    ranges = [(a, a + rng.choice([0, 3, 40, 700, 3000]), f"r{i}") for i, a in enumerate(rng.choices(range(-300, 5000), k=150))]
    ranges += [(0, 4999, "whole"), (0, 4999, "again"), (10, 5, "turned"), (None, 9, "open"), (9, None, "open"), (64, 127, "bucket")]
    points = [(i, rng.randrange(-400, 8500)) for i in range(800)] + [(900 + p, p) for p in (0, 63, 64, 127, 128, 4999)] + [(2000, None)]
    inner = lambda p: min(((-a, b, n) for a, b, n in ranges if None not in (a, b, p) and a <= p <= b), default=(0, 0, None))[2]
    asked, table = spark.createDataFrame(points, "id int, p long"), spark.createDataFrame(ranges, "a long, b long, name string")
    for width in (64, 65536):
        found = range_lookup(asked, table, point="p", start="a", end="b", width=width, nested=True)
        assert found.columns == ["id", "p", "a", "b", "name"]
        assert sorted(((r["id"], r["name"]) for r in found.collect()), key=str) == sorted(((i, inner(p)) for i, p in points), key=str)
    bare = range_lookup(asked, table.select("a", "b"), point="p", start="a", end="b", width=64, nested=True)
    assert bare.count() == len(points)
    assert range_lookup(asked, table.limit(0), point="p", start="a", end="b", nested=True).where("a is null").count() == len(points)


def test_pieces_of_disjoint_ranges_are_the_ranges(spark):
    ranges = spark.createDataFrame([(k * 10, k * 10 + 9, k) for k in range(20)], "a long, b long, k int")
    got = disjoint_pieces(ranges, start="a", end="b", width=1000).select("a", "b", "_from", "_to").collect()
    assert len(got) == 20 and all((r["a"], r["b"]) == (r["_from"], r["_to"]) for r in got)


def test_province_bounds_and_unknown(spark, rows):
    ranges = spark.createDataFrame([(16909056, 16909060, "c|0|North|x|y")], "ip_start long, ip_end long, region string")
    ips = spark.createDataFrame([("1.2.3.0",), ("1.2.3.4",), ("1.2.3.5",), ("",)], "ip string")
    assert rows(province_of_ip(ips, ranges)) == [("", "0"), ("1.2.3.0", "North"), ("1.2.3.4", "North"), ("1.2.3.5", "0")]


def test_full_outer_totals(spark, rows):
    h = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    b = spark.createDataFrame([("b", 5), ("c", 7)], "k string, n long")
    assert rows(add_full_outer(h, b, ["k"], "n")) == [("a", 1), ("b", 7), ("c", 7)]


def test_a_hot_order_is_joined_apart(spark, rows, sales, tmp_path):
    course, cart, pay = sales
    hot_cart = cart.unionByName(cart.withColumn("orderid", F.lit("o2")))
    want = rows(sellcourse.sell_detail(course, hot_cart, pay, "d1"))
    house = Warehouse(str(tmp_path), catalog_prefix="hot_")
    for name, df in (("cart", hot_cart), ("pay", pay)):
        house.append_bucketed(df, name, "orderid", ("dt", "dn"))
    stored = [house.read_bucketed(spark, name) for name in ("cart", "pay")]
    assert rows(sellcourse.sell_detail_bucketed(course, *stored, "d1", hot_share=0.2)) == want


def test_lines_without_an_order_go_round_the_bucketed_join(spark, rows, sales, tmp_path):
    course, cart, pay = sales
    cart = cart.withColumn("orderid", F.when(F.col("courseid") % 2 == 1, F.col("orderid")))
    pay = pay.withColumn("orderid", F.when(F.col("paymoney") % 3 > 0, F.col("orderid")))  # payments without one match nothing
    want = rows(sellcourse.sell_detail(course, cart, pay, "d1"))
    house = Warehouse(str(tmp_path), catalog_prefix="unnamed_", buckets=6)
    for name, df in (("cart", cart), ("pay", pay)):
        house.append_bucketed(df, name, "orderid", ("dt", "dn"))
    stored = [house.read_bucketed(spark, name) for name in ("cart", "pay")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sellcourse.sell_detail_bucketed(course, *stored, "d1", hot_share=0.1)
        text = plan(got)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows(got) == want and sum(r[13] is None for r in want) == cart.where("dt = 'd1' and orderid is null").count() > 0
    assert text.count("SortMergeJoin") == 1 and "isnotnull(orderid" in text and "hashpartitioning" not in text


def test_answer_fact_shuffles_no_small_dimension(spark, rows):
    """Courses and majors are broadcast and joined last; repeated and unset keys count as in plain inner joins."""
    def frame(columns, key, ids):
        names = [c.partition(":")[0] for c in columns.split()]
        names += [] if "dt" in names else ["dt"]
        data = [tuple(i if c == key else "d" if c == "dt" else "a" if c == "dn" else None for c in names) for i in ids]
        kinds = ", ".join(f"{c} {'int' if c == key else 'string'}" for c in names)
        return spark.createDataFrame(data, kinds)

    dims = {n: frame(columns, key, [1, 2, 2, None, 5]) for n, (key, columns) in qz._FACT_DIMS.items()}
    ids = [(1, 1, 1, 1, 1), (2, 1, 2, 1, 2), (2, 2, 2, 2, 2), (None, 1, 1, 1, 1), (1, 1, 1, 1, None), (1, 3, 1, 1, 1), (5, 5, 5, 5, 4)]
    names = [key for key, _ in qz._FACT_DIMS.values()]
    answers = spark.createDataFrame(ids, ", ".join(f"{c} int" for c in names))
    others = {c.partition(":")[0] for c in qz._FACT.split()} - set(names) - {"dt", "dn"}
    answers = answers.withColumns({c: F.lit(None).cast("string") for c in others}).withColumns({"dt": F.lit("d"), "dn": F.lit("a")})
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = qz.answer_fact(answers, dims, "d")
        text = plan(fact)
        assert "hashpartitioning(sitecourseid" not in text and "hashpartitioning(majorid" not in text
        assert rows(fact, *names) == sorted([(1,) * 5, *[(2, 1, 2, 1, 2)] * 8, *[(2,) * 5] * 32])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fact_star_plans_stored_dimensions_and_broadcasts_only_measured_ones(spark, tmp_path):
    """The fact's plan has no joins of stored dimensions, and no broadcast that goes by the size of small files."""
    duckdb = pytest.importorskip("duckdb")
    n = F.col("id")
    key = n.cast("int")
    tables = {
        "region": spark.range(5).select(key.alias("r_regionkey"), F.lit("r").alias("r_name")),
        "nation": spark.range(25).select(key.alias("n_nationkey"), F.lit("n").alias("n_name"), (key % 5).alias("n_regionkey")),
        "supplier": spark.range(6).select(n.alias("s_suppkey")).union(spark.sql("values (2L), (null)")),
        "part": spark.range(12).select(n.alias("p_partkey"), (key * 3).alias("p_size")).union(spark.sql("values (4L, 4), (null, 1)")),
        "customer": spark.range(5).select(n.alias("c_custkey"), key.alias("c_nationkey")).union(spark.sql("values (3L, 3), (1L, null)")),
        "orders": spark.range(8).select(n.alias("o_orderkey")).union(spark.sql("values (1L), (null)")),
        "lineitem": spark.range(200).select(
            F.when(n % 41 > 0, n % 10).alias("l_orderkey"), F.when(n % 43 > 0, n % 13).alias("l_partkey"), (n % 7).alias("l_suppkey"),
            (key % 7 + 1).alias("l_linenumber"), F.element_at(F.array(*map(F.lit, "ANR")), key % 3 + 1).alias("l_returnflag"),
        ),
    }
    con = duckdb.connect()
    for name, df in tables.items():
        df.write.parquet(path := f"{tmp_path}/{name}.parquet")
        con.execute(f"create view {name} as select * from '{path}/*.parquet'")
    fact = QUERIES["fact_star"](spark, str(tmp_path))
    text = plan(fact)
    assert all(column not in text for column in ("p_partkey", "s_suppkey", "c_custkey", "n_nationkey"))
    assert text.count("SortMergeJoin") == 4 and "HashJoin [questionid" not in text
    want = con.execute(CHECKS["fact_star"])
    columns = [d[0] for d in want.description]
    want = bag(want.fetchall(), columns)
    assert bag([tuple(r) for r in fact.collect()], fact.columns) == want and sum(want.values()) > 50
