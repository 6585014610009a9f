import json
import random

import pytest
from pyspark.sql import functions as F

from coursemill.operators.intervals import interval_sets, islands
from coursemill.sinks.tables import latest_rows
from coursemill.sources.streams import line_stream
from coursemill.streaming import answers, archive, jobs, learning, pages, register


def put(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n", encoding="utf-8")


def drain(queries):
    for q in queries:
        q.awaitTermination()
        assert q.exception() is None


@pytest.fixture
def log(tmp_path):
    return tmp_path / "log"


def test_register_job_continues_from_its_checkpoint(spark, rows, log, tmp_path):
    put(log, "1.txt", ["1\t1\tx", "2\t2\tx", "3\t9\tx", "bad", "4\t1", "5\t1\t\t"])
    put(log, "2.txt", ["6\t1\tx"])

    def run():
        drain(jobs.register_job(line_stream(spark, "files", str(log), per_trigger=1), str(tmp_path / "out"), once=True))
        return rows(latest_rows(spark, str(tmp_path / "out" / "running"), ["app_name"]))

    assert run() == [("APP", 1), ("Other", 1), ("PC", 2)]
    put(log, "3.txt", ["7\t2\tx", "8\t1\ty"])
    assert run() == [("APP", 2), ("Other", 1), ("PC", 3)]
    windows = latest_rows(spark, str(tmp_path / "out" / "sliding"), ["window_start", "window_end", "app_name"])
    assert windows.agg(F.sum("num")).first()[0] == 60  # six sign-ups, each in ten windows


def test_sliding_window_stream_equals_both_batch_forms(spark, rows, tmp_path):
    rng = random.Random(2)
    data = [(f"2024-01-01 00:{rng.randrange(0, 5):02d}:{rng.randrange(60):02d}", rng.choice(["PC", "APP"])) for _ in range(200)]
    df = spark.createDataFrame(data, "t string, app_name string").select(F.col("t").cast("timestamp").alias("ts"), "app_name")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = (
        register.sliding_counts(stream, "ts").writeStream.outputMode("complete").format("memory").queryName("sliding")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    drain([q])
    want = rows(register.sliding_counts(df, "ts"))
    assert rows(spark.table("sliding")) == want
    assert rows(register.sliding_counts_paned(df, "ts"), "window_start", "window_end", "app_name", "num") == want


def page(last, cur, nxt, ip="1.2.3.4", **more):
    return json.dumps({"uid": 1, "ip": ip, "last_page_id": last, "page_id": cur, "next_page_id": nxt, **more})


def test_page_job(spark, rows, log, tmp_path):
    put(log, "1.txt", [page(0, 1, 2)] * 8 + [page(1, 2, 3)] + ["bad", "[1]", "{}", page("", 1, 2)])
    put(log, "2.txt", [page(0, 1, 9, ip="9.9.9.9"), json.dumps({"page_id": 1}), page(1, 5, 6, ip="")])
    ranges = spark.createDataFrame([(16909056, 16909060, "c|0|North|x|y")], "ip_start long, ip_end long, region string")
    lines = line_stream(spark, "files", str(log), per_trigger=1)
    out = tmp_path / "out"
    drain(jobs.page_job(lines, ranges, str(out), once=True))
    assert rows(pages.published_jumps(spark, str(out / "funnel"))) == [
        ("0", "1", "2", 8), ("0", "1", "9", 1), ("1", "2", "3", 1), ("1", "5", "6", 1),
    ]
    assert rows(pages.published_pages(spark, str(out / "funnel")), "page_id", "num", "jump_rate") == [
        ("1", 9, "100%"), ("2", 1, "11%"), ("5", 1, None),
    ]
    assert rows(pages.published_clicks(spark, str(out / "provinces"))) == [("0", 2), ("North", 9)]
    assert rows(pages.top_provinces(pages.published_clicks(spark, str(out / "provinces")))) == [("0", 2), ("North", 9)]


def test_funnel_edges(spark, rows):
    totals = spark.createDataFrame([("1", 8), ("2", 1)], "page_id string, num long")
    assert rows(pages.funnel_rates(totals)) == [(1, 8, "100%"), (2, 1, "12%"), (3, 0, "0%")]
    none = spark.createDataFrame([("3", 4)], "page_id string, num long")
    assert rows(pages.funnel_rates(none)) == [(1, 0, "100%"), (2, 0, "0%"), (3, 4, "0%")]


def test_top_provinces_break_ties_by_name(spark):
    df = spark.createDataFrame([("d", 5), ("a", 5), ("c", 5), ("b", 9)], "province string, num long")
    assert [r["province"] for r in pages.top_provinces(df).collect()] == ["b", "a", "c"]


def test_answer_job_counts_distinct_questions_over_batches(spark, rows, log, tmp_path):
    put(log, "1.txt", ["7\t1\t1\tq1\t1\t2019-07-02", "7\t1\t1\tq2\t0\t2019-07-03", "7\t1\t1", "7\t1\t1\tq9\t1\t"])
    put(log, "2.txt", ["7\t1\t1\tq1\t1\t2019-07-01", "8\t1\t1\tq1\t0\t2019-07-05"])
    drain(jobs.answer_job(line_stream(spark, "files", str(log), per_trigger=1), str(tmp_path / "o"), once=True))
    points = answers.published_points(spark, str(tmp_path / "o" / "points"))
    got = {r["userid"]: r for r in points.collect()}
    r = got["7"]
    assert (r["qz_sum"], r["qz_count"], r["qz_istrue"], r["createtime"]) == (3, 2, 2, "2019-07-01")
    assert abs(r["correct_rate"] - 2 / 3) < 1e-12 and abs(r["mastery_rate"] - 0.2 * 2 / 3) < 1e-12
    assert str(r["correct_percent"]) == "0.67"
    assert len(r["updatetime"]) == 19
    assert got["8"]["mastery_rate"] == 0.0
    lists = answers.published_history(spark, str(tmp_path / "o" / "points"))
    assert rows(lists) == [("7", "1", "1", 0, "q1,q2", "2019-07-01"), ("8", "1", "1", 0, "q1", "2019-07-05")]


def test_answer_job_reads_no_more_in_later_batches(spark, log, tmp_path, monkeypatch):
    """Fifty batches, each of a new point and one that all share: a batch writes two rows, and publishing opens no file."""
    def unread(*_, **__):
        raise AssertionError("published rows were read back")

    for k in range(50):
        put(log, f"{k:02}.txt", [f"{k}\t1\t1\tq{k % 7}\t1\t2019-07-02", f"all\t1\t1\tq{k % 7}\t{k % 2}\t2019-07-02"])
    monkeypatch.setattr(answers, "latest_rows", unread)
    [query] = jobs.answer_job(line_stream(spark, "files", str(log), per_trigger=1), str(tmp_path / "o"), once=True)
    query.awaitTermination()
    assert {p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]} == {2}
    monkeypatch.undo()
    root = tmp_path / "o" / "points"
    sizes = [sum(f.stat().st_size for f in (root / "changes" / f"batch={k}").glob("*.parquet")) for k in range(50)]
    assert max(sizes[10:]) < 1.2 * max(sizes[:10])
    got = {r["userid"]: r for r in answers.published_points(spark, str(root)).collect()}
    assert len(got) == 51 and (got["all"]["qz_sum"], got["all"]["qz_count"], got["all"]["qz_istrue"]) == (50, 7, 25)


def viewing(user, ps, pe, ts, te, **more):
    row = {"uid": user, "cwareid": 1, "videoid": 1, "chapterid": 3, "edutypeid": 4, "subjectid": 5, "sourceType": "APP",
           "speed": 2, "ts": ts, "te": te, "ps": ps, "pe": pe}
    return json.dumps({**row, **more})


def test_learn_job_worked_example_over_two_batches(spark, rows, log, tmp_path):
    put(log, "1.txt", [viewing(1, 30, 100, 1563352128131, 1563352144131), "bad"])
    out = str(tmp_path / "o")

    def run():
        drain(jobs.learn_job(line_stream(spark, "files", str(log), per_trigger=1), out, once=True))
        return latest_rows(spark, f"{out}/videos", learning.VIDEO_KEYS).first()

    r = run()
    assert (r["play_interval"], r["totaltime"], r["effecttime"], r["completetime"]) == ("30-100", 16, 16, 70)
    put(log, "2.txt", [viewing(1, 30, 110, 1564456120128, 1564456140128, sourceType="PC")])
    r = run()
    assert (r["play_interval"], r["totaltime"], r["effecttime"], r["completetime"]) == ("30-110", 36, 18, 80)
    assert rows(latest_rows(spark, f"{out}/dims", ["dim", "key"])) == [
        ("chapterid", "3", 36), ("cwareid", "1", 36), ("edutypeid", "4", 36), ("sourceType", "APP", 16),
        ("sourceType", "PC", 20), ("subjectid", "5", 36),
    ]


def test_learn_stream_equals_batch_batch_by_batch(spark, log, tmp_path):
    """Two micro-batches of many rows: the second one's gain equals the batch form with the first one as history."""
    rng = random.Random(31)
    parts = []
    for n in range(2):
        part = []
        for _ in range(400):
            user, ps, ts = rng.randrange(0, 12), rng.randrange(0, 60), rng.randrange(0, 40) * 500
            part.append(viewing(user, ps, ps + rng.randrange(0, 15), ts, ts + rng.randrange(0, 60_000)))
        put(log, f"{n}.txt", part)
        parts.append(learning.learn_events(spark.createDataFrame([(x,) for x in part], "value string")))
    out = str(tmp_path / "o")
    import os, time
    os.utime(log / "0.txt", (time.time() - 100, time.time() - 100))
    drain(jobs.learn_job(line_stream(spark, "files", str(log), per_trigger=1), out, once=True)[1:])
    keys = learning.VIDEO_KEYS
    got = {r["userid"]: r for r in latest_rows(spark, f"{out}/videos", keys).collect()}
    history = interval_sets(islands(parts[0], keys), keys)
    want = {}
    for df in (learning.watch_time(parts[0]), learning.watch_time(parts[1], history)):
        for r in df.collect():
            old = want.get(r["userid"], (0, 0, 0))
            want[r["userid"]] = tuple(a + b for a, b in zip(old, (r["totaltime"], r["effecttime"], r["completetime"])))
    assert {u: (r["totaltime"], r["effecttime"], r["completetime"]) for u, r in got.items()} == want
    text = {r["userid"]: r["play_interval"] for r in learning.play_intervals(parts[0].union(parts[1])).collect()}
    assert {u: r["play_interval"] for u, r in got.items()} == text


def test_videos_of_a_user_are_worked_off_together(spark):
    """One call per user and batch, over chunks, videos with and without a past, turned-round and empty intervals."""
    import numpy as np
    import pandas as pd

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    rng = random.Random(5)
    keys, state, got, parts = learning.VIDEO_KEYS, State(), {}, []
    for n in range(3):
        part = []
        for _ in range(150):
            video, ps, ts = rng.randrange(2 * n, 2 * n + 4), rng.randrange(-30, 60), rng.randrange(0, 40) * 500
            part.append((7, -1 - video % 2, video, ps, ps + rng.randrange(-4, 15), ts, ts + rng.randrange(-9_000, 60_000)))
        data = [np.array(r[1:], dtype=np.int64) for r in part]
        chunks = iter([pd.DataFrame({"viewing": data[:70]}), pd.DataFrame({"viewing": data[70:]})])
        (out,) = learning._update_user((7, 0), chunks, state)
        assert sorted(zip(out["cwareid"], out["videoid"])) == sorted({r[1:3] for r in part})
        for r in out.itertuples():
            got[r.cwareid, r.videoid] = (r.totaltime, r.effecttime, r.completetime, r.play_interval)
        parts.append(spark.createDataFrame(part, "userid int, cwareid int, videoid int, ps int, pe int, ts long, te long"))
    want, before = {}, None
    for part in parts:
        history = None if before is None else interval_sets(islands(before, keys), keys)
        for r in learning.watch_time(part, history).collect():
            k = r["cwareid"], r["videoid"]
            want[k] = tuple(a + b for a, b in zip(want.get(k, (0, 0, 0)), (r["totaltime"], r["effecttime"], r["completetime"])))
        before = part if before is None else before.union(part)
    text = {(r["cwareid"], r["videoid"]): r["play_interval"] for r in learning.play_intervals(before).collect()}
    assert got == {k: (*v, text[k]) for k, v in want.items()}


def test_archive_job_keeps_every_value(spark, log, tmp_path):
    put(log, "1.txt", ["a", "b"])
    out = tmp_path / "o"
    drain(jobs.archive_job(line_stream(spark, "files", str(log), per_trigger=1), "page_topic", str(out), once=True))
    put(log, "2.txt", ["c", "a"])
    drain(jobs.archive_job(line_stream(spark, "files", str(log), per_trigger=1), "page_topic", str(out), once=True))
    stored = spark.read.text(str(out / "raw"))
    assert sorted(r["value"] for r in stored.collect()) == ["a", "a", "b", "c"]
    assert {r["topic"] for r in stored.collect()} == {"page_topic"}
    assert list((out / "raw").glob("topic=page_topic/dt=*/*.gz"))


def test_archive_day_of_a_time_column(spark, rows):
    df = spark.createDataFrame([("x", 1563352128131)], "value string, at long")
    assert rows(archive.archive_rows(df, "t", "at")) == [("x", "t", "20190717")]
