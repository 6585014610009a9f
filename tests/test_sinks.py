import pytest
from pyspark.sql import functions as F

from coursemill.plans import history
from coursemill.plans.warehouse import Warehouse
from coursemill.session import workspace
from coursemill.sinks import tables as t
from coursemill.sources.streams import line_stream


def test_append_and_partition_overwrite(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, dt string")
    t.write_files(df, path, partition_by=["dt"], codec="snappy")
    t.write_files(df.where("dt = 'a'"), path, partition_by=["dt"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (1, "a"), (2, "b")]
    t.write_files(spark.createDataFrame([(9, "a")], "x int, dt string"), path, partition_by=["dt"], overwrite=True, compact=True)
    assert rows(spark.read.parquet(path)) == [(2, "b"), (9, "a")]
    with pytest.raises(ValueError):
        t.write_files(df, path, codec="lzo")


def test_files_keep_an_order(spark, rows, tmp_path):
    import pyarrow.parquet as pq

    data = [(i * 37 % 1000, f"x{i}", "d", (None, "", "a", "b")[i % 4]) for i in range(1000)]
    df = spark.createDataFrame(data, "n int, x string, dt string, dn string").repartition(7)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        t.write_files(df, str(tmp_path / "o"), partition_by=["dt", "dn"], order_by=[F.col("n").desc(), "x"], overwrite=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    folders = {p.name: sorted(p.glob("*.parquet")) for p in (tmp_path / "o" / "dt=d").iterdir()}
    assert set(folders) == {"dn=__HIVE_DEFAULT_PARTITION__", "dn=a", "dn=b"} and max(map(len, folders.values())) > 1
    for name, files in folders.items():
        got = [n for f in files for n in pq.read_table(f, partitioning=None)["n"].to_pylist()]
        kinds = (None, "") if "HIVE" in name else (name[3:],)
        assert got == sorted((n for n, _, _, dn in data if dn in kinds), reverse=True)


def test_insert_by_name_ignores_column_order(spark, rows, tmp_path):
    spark.sql("drop table if exists by_name")
    spark.sql(f"create table by_name (x int, y string, dt string) using parquet partitioned by (dt) location '{tmp_path / 'b'}'")
    t.insert_by_name(spark.createDataFrame([("d1", "one", 1)], "dt string, y string, x int"), "by_name")
    t.insert_by_name(spark.createDataFrame([("d2", "two", 2)], "dt string, y string, x int"), "by_name")
    t.insert_by_name(spark.createDataFrame([("d2", "new", 3)], "dt string, y string, x int"), "by_name", overwrite=True)
    assert rows(spark.table("by_name")) == [(1, "one", "d1"), (3, "new", "d2")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_snapshot_may_read_what_it_replaces(spark, rows, tmp_path):
    root = str(tmp_path / "s")
    assert rows(t.read_snapshot(spark, root, "x long")) == []
    with pytest.raises(ValueError):
        t.read_snapshot(spark, root)
    t.publish_snapshot(spark.range(2).toDF("x"), root)
    t.publish_snapshot(t.read_snapshot(spark, root).select((F.col("x") + 10).alias("x")), root)
    assert rows(t.read_snapshot(spark, root)) == [(10,), (11,)]


def test_change_log_replay_and_folding(spark, rows, tmp_path):
    root = str(tmp_path / "c")

    def put(batch, *data):
        t.publish_changes(spark.createDataFrame(list(data), "k string, n long"), root, batch)

    put(0, ("a", 1), ("b", 2))
    put(1, ("a", 5))
    put(1, ("a", 6))  # the same batch again replaces itself
    assert rows(t.latest_rows(spark, root, ["k"])) == [("a", 6), ("b", 2)]
    assert rows(t.additive_totals(spark, root, ["k"])) == [("a", 7), ("b", 2)]
    t.fold_changes(spark, root, ["k"])
    put(2, ("b", 9), ("c", 3))
    assert rows(t.latest_rows(spark, root, ["k"])) == [("a", 6), ("b", 9), ("c", 3)]


def test_additive_folding(spark, rows, tmp_path):
    root = str(tmp_path / "a")
    for batch in range(3):
        t.publish_changes(spark.createDataFrame([("a", 1)], "k string, n long"), root, batch)
        t.fold_changes(spark, root, ["k"], additive=True)
    assert rows(t.additive_totals(spark, root, ["k"])) == [("a", 3)]


def test_a_batch_that_lands_during_a_fold_counts_once(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "f")
    put = lambda batch: t.publish_changes(spark.createDataFrame([("a", 1 + batch)], "k string, n long"), root, batch)
    put(0)
    whole = t.publish_snapshot
    monkeypatch.setattr(t, "publish_snapshot", lambda *a: (put(10), whole(*a)))
    t.fold_changes(spark, root, ["k"], additive=True)
    monkeypatch.undo()
    assert rows(t.additive_totals(spark, root, ["k"])) == [("a", 12)]
    t.fold_changes(spark, root, ["k"], additive=True)
    assert rows(t.additive_totals(spark, root, ["k"])) == [("a", 12)]


def test_folds_bound_what_is_listed(spark, rows, tmp_path):
    root = tmp_path / "b"
    put = lambda batch: t.publish_changes(spark.createDataFrame([("a", 1), (f"k{batch}", 1)], "k string, n long"), str(root), batch)
    listed = lambda: sorted(int(p.name[6:]) for p in (root / "changes").glob("batch=*"))
    for batch in range(9):
        put(batch)
        if batch % 3 == 2:
            t.fold_changes(spark, str(root), ["k"], additive=True)
    assert listed() == [6, 7, 8]  # of the last fold; earlier readers may still open them
    assert sorted(p.name for p in (root / "base").glob("version=*")) == ["version=5", "version=8"]
    want = sorted([("a", 9), *((f"k{b}", 1) for b in range(9))])
    assert rows(t.additive_totals(spark, str(root), ["k"])) == want
    t.fold_changes(spark, str(root), ["k"], additive=True)  # nothing new
    put(8)  # a batch handed in again after it was folded
    assert listed() == [6, 7, 8] and rows(t.additive_totals(spark, str(root), ["k"])) == want
    put(9)
    (root / "changes" / "batch=9" / "_SUCCESS").unlink()  # still being committed
    t.fold_changes(spark, str(root), ["k"], additive=True)
    assert t.latest_version(spark, f"{root}/base") == "8"


def test_an_unreadable_log_is_not_taken_for_none(spark, tmp_path):
    (tmp_path / "s" / "published").mkdir(parents=True)
    (tmp_path / "s" / "published" / "part-0.parquet").write_text("broken")
    with pytest.raises(Exception, match="part-0|Parquet|footer"):
        t.latest_version(spark, str(tmp_path / "s"))
    with pytest.raises(Exception, match="part-0|Parquet|footer|infer"):
        history.read_all(spark, str(tmp_path / "s")).count()


def test_sites_stay_text(spark, rows, tmp_path):
    house = Warehouse(str(tmp_path))
    house.write(spark.createDataFrame([(1, "01", "20190722"), (2, "1", "20190723")], "x int, dn string, dt string"), "dws.t", ["dt", "dn"])
    assert rows(house.read(spark, "dws.t"), "x", "dn", "dt") == [(1, "01", "20190722"), (2, "1", "20190723")]
    assert rows(house.read(spark, "dws.t", "20190722"), "x", "dn") == [(1, "01")]


def test_replayed_logs_are_written_where_they_are_read(spark, rows, tmp_path):
    """No shuffle when there are pieces enough, compressed files, and none longer than told."""
    log = str(tmp_path / "log")
    lines = spark.range(0, 1200, numPartitions=12).select(F.concat(F.lit("line "), "id").alias("value"))
    t.replay_lines(lines, "files", log, per_file=60)
    files = spark.read.text(log).groupBy(F.input_file_name().alias("f")).agg(
        F.collect_list(F.substring("value", 6, 9).cast("long")).alias("ids")
    )
    ids = sorted(sorted(r["ids"]) for r in files.collect())
    assert ids == [list(range(a, b)) for p in range(0, 1200, 100) for a, b in ((p, p + 60), (p + 60, p + 100))]
    assert t.data_files(spark, log) == 24 == len(list((tmp_path / "log").glob("part-*.lz4")))
    t.replay_lines(lines.coalesce(1), "files", str(tmp_path / "one"))
    assert t.data_files(spark, str(tmp_path / "one")) == 10
    assert rows(spark.read.text(str(tmp_path / "one"))) == rows(lines)


def test_unknown_kinds_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        t.replay_lines(spark.createDataFrame([("a",)], "value string"), "fax", str(tmp_path))
    with pytest.raises(ValueError):
        line_stream(spark, "fax", str(tmp_path))


def test_workspace_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    one, two = workspace(spark, "x"), workspace(spark, "x")
    assert one != two
    assert shared is None or one.startswith(shared.rstrip("/"))


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = {}

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="checkpoint"):
        workspace(Session, "x")
    Session.conf = {"spark.checkpoint.dir": "hdfs://host/shared/"}
    assert workspace(Session, "x").startswith("hdfs://host/shared/coursemill/x-")
