import json

import pytest

from coursemill.__main__ import main
from coursemill.sinks.tables import latest_rows


def test_load_and_report(spark, rows, tmp_path):
    ods, house = tmp_path / "ods", tmp_path / "house"
    ods.mkdir()
    day = {"dt": "20190722", "dn": "a"}
    (ods / "salecourse.log").write_text(json.dumps({"courseid": 1, "coursename": "c", **day}))
    (ods / "courseshoppingcart.log").write_text(json.dumps({"courseid": 1, "orderid": "o", **day}))
    (ods / "coursepay.log").write_text(json.dumps({"orderid": "o", "paymoney": "2", **day}))
    main(["sell-load", "--ods", str(ods), "--warehouse", str(house)])
    main(["sell-detail", "--dt", "20190722", "--warehouse", str(house), "--form", "salted"])
    got = spark.read.parquet(str(house / "dws" / "dws_salecourse_detail"))
    assert rows(got, "courseid", "coursename", "orderid") == [(1, "c", "o")]


def test_replay_and_stream(spark, rows, tmp_path):
    (tmp_path / "register.log").write_text("1\t1\tx\n2\t2\tx\n3\t2\tx\n")
    main(["replay", "--log", str(tmp_path / "register.log"), "--kind", "files", "--target", str(tmp_path / "topic")])
    main(["stream-register", "--kind", "files", "--source", str(tmp_path / "topic"), "--out", str(tmp_path / "out"), "--once"])
    running = str(tmp_path / "out" / "running")
    assert rows(latest_rows(spark, running, ["app_name"])) == [("APP", 2), ("PC", 1)]
    main(["fold", "--results", "register", "--out", str(tmp_path / "out")])
    assert (tmp_path / "out" / "running" / "base" / "published").is_dir()
    assert rows(latest_rows(spark, running, ["app_name"])) == [("APP", 2), ("PC", 1)]


def test_unknown_job_is_refused():
    with pytest.raises(SystemExit):
        main(["fly"])
