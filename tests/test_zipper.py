from decimal import Decimal

import pytest

from coursemill.operators import zipper
from coursemill.plans import history

SCHEMA = "uid int, paymoney decimal(20,4), vip_level string, start_time string, end_time string, dn string"
OPEN = "9999-12-31"


def frame(spark, *data):
    return spark.createDataFrame([(u, Decimal(m), "v", s, e, "a") for u, m, s, e in data], SCHEMA)


def state(df):
    return sorted((r["uid"], int(r["paymoney"]), r["start_time"], r["end_time"]) for r in df.collect())


def test_worked_example(spark):
    history = frame(spark, (1001, 100, "2019-01-01", "2019-01-02"), (1001, 200, "2019-01-02", OPEN), (5, 9, "2019-01-01", OPEN))
    day = frame(spark, (1001, 50, "2019-01-03", OPEN), (6, 1, "2019-01-03", OPEN))
    want = [
        (5, 9, "2019-01-01", OPEN),
        (6, 1, "2019-01-03", OPEN),
        (1001, 100, "2019-01-01", "2019-01-02"),
        (1001, 200, "2019-01-02", "2019-01-03"),
        (1001, 250, "2019-01-03", OPEN),
    ]
    merged = zipper.merge_day(history, day, "2019-01-03")
    assert state(merged) == want
    assert state(zipper.merge_day(merged, day, "2019-01-03")) == want  # the same day again


def test_a_corrected_day_replaces_its_first_run(spark):
    history = frame(spark, (1, 10, "2019-01-01", OPEN), (2, 20, "2019-01-01", OPEN))
    first = zipper.merge_day(history, frame(spark, (1, 5, "2019-01-02", OPEN)), "2019-01-02")
    again = zipper.merge_day(first, frame(spark, (2, 7, "2019-01-02", OPEN)), "2019-01-02")
    assert state(again) == [
        (1, 10, "2019-01-01", OPEN), (2, 20, "2019-01-01", "2019-01-02"), (2, 27, "2019-01-02", OPEN),
    ]


def test_sites_are_separate_members(spark):
    history = frame(spark, (1, 10, "2019-01-01", OPEN))
    day = spark.createDataFrame([(1, Decimal(5), "v", "2019-01-02", OPEN, "b")], SCHEMA)
    assert state(zipper.merge_day(history, day, "2019-01-02")) == [(1, 5, "2019-01-02", OPEN), (1, 10, "2019-01-01", OPEN)]


def test_day_changes_need_a_known_level(spark):
    pay = spark.createDataFrame(
        [(1, "10.5", 1, "20190102", "a"), (1, "2", 2, "20190102", "a"), (1, "9", 1, "20190101", "a"), (2, "4", 9, "20190102", "a")],
        "uid int, paymoney string, vip_id int, dt string, dn string",
    )
    vip = spark.createDataFrame([(1, "gold", "a"), (2, "silver", "a")], "vip_id int, vip_level string, dn string")
    got = [tuple(r) for r in zipper.day_changes(pay, vip, "20190102").collect()]
    assert got == [(1, Decimal("12.5000"), "silver", "2019-01-02", OPEN, "a")]


def test_stored_history_rewrites_only_open_rows(spark, tmp_path):
    root = str(tmp_path / "h")
    assert state(history.read_all(spark, root)) == []

    def day(dt, *payers):
        dashed = f"{dt[:4]}-{dt[4:6]}-{dt[6:]}"
        rows = frame(spark, *[(u, m, dashed, OPEN) for u, m in payers])
        history.publish_day(zipper.merge_open(history.open_before(spark, root, dt), rows), root, dt)

    day("20190101", (1, 100), (2, 5))
    day("20190102", (1, 100))
    day("20190103", (1, 50), (3, 9))
    want = [
        (1, 100, "2019-01-01", "2019-01-02"), (1, 200, "2019-01-02", "2019-01-03"), (1, 250, "2019-01-03", OPEN),
        (2, 5, "2019-01-01", OPEN), (3, 9, "2019-01-03", OPEN),
    ]
    assert state(history.read_all(spark, root)) == want
    day("20190103", (1, 50), (3, 9))
    assert state(history.read_all(spark, root)) == want
    day("20190103", (2, 1))  # corrected
    assert state(history.read_all(spark, root)) == [
        (1, 100, "2019-01-01", "2019-01-02"), (1, 200, "2019-01-02", OPEN), (2, 5, "2019-01-01", "2019-01-03"),
        (2, 6, "2019-01-03", OPEN),
    ]
    stored = list((tmp_path / "h").glob("run=*/state=closed"))
    assert len(stored) == 4 and len(list((tmp_path / "h").glob("run=*"))) == 5


def test_late_and_corrected_days_repair_the_days_after_them(spark, tmp_path):
    days = {
        "20190101": [(1, 100), (2, 5)], "20190102": [(1, 100)], "20190103": [(2, 7), (3, 9)], "20190104": [(1, 50), (3, 1)],
    }

    def changes(dt):
        return frame(spark, *[(u, m, f"{dt[:4]}-{dt[4:6]}-{dt[6:]}", OPEN) for u, m in days[dt]])

    def loaded(name, order):
        root = str(tmp_path / name)
        return root, [history.publish_from(spark, root, dt, changes) for dt in order]

    root, merged = loaded("order", sorted(days))
    want = state(history.read_all(spark, root))
    assert merged == [[dt] for dt in sorted(days)] and (1, 250, "2019-01-04", OPEN) in want and len(want) == 7
    late, merged = loaded("late", ["20190101", "20190104", "20190103", "20190102"])
    assert merged[1:] == [["20190104"], ["20190103", "20190104"], ["20190102", "20190103", "20190104"]]
    assert state(history.read_all(spark, late)) == want
    first, _ = loaded("first", ["20190102", "20190103", "20190104", "20190101"])
    assert state(history.read_all(spark, first)) == want
    days["20190102"] = [(2, 1)]  # a correction of the second day reaches the fourth
    history.publish_from(spark, late, "20190102", changes)
    assert {(1, 150, "2019-01-04", OPEN), (2, 13, "2019-01-03", OPEN)} <= set(state(history.read_all(spark, late)))


def test_days_that_are_not_all_merged_are_not_announced(spark, tmp_path):
    root = str(tmp_path / "h")
    rows = {dt: frame(spark, (1, m, f"2019-01-0{dt[-1]}", OPEN)) for dt, m in (("20190101", 1), ("20190102", 2), ("20190103", 4))}
    for dt in ("20190101", "20190103"):
        history.publish_from(spark, root, dt, rows.get)
    before = state(history.read_all(spark, root))

    def lost(dt):
        if dt == "20190103":
            raise RuntimeError("lost")
        return rows[dt]

    with pytest.raises(RuntimeError):
        history.publish_from(spark, root, "20190102", lost)
    assert state(history.read_all(spark, root)) == before
    history.publish_from(spark, root, "20190102", rows.get)
    assert state(history.read_all(spark, root))[-1] == (1, 7, "2019-01-03", OPEN)
