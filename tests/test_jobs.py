"""The batch jobs end to end on small logs."""

import json
from decimal import Decimal

import pytest

from coursemill.plans import jobs
from coursemill.plans.warehouse import Warehouse

D1, D2 = "20190722", "20190723"


@pytest.fixture(scope="module")
def ods(tmp_path_factory):
    folder = tmp_path_factory.mktemp("ods")

    def put(log, rows, **common):
        text = "\n".join(json.dumps({**common, **r}) for r in rows)
        (folder / f"{log}.log").write_text(text + "\nbroken {\n", encoding="utf-8")

    a = {"dt": D1, "dn": "webA"}
    put("baseadlog", [{"adid": 1, "adname": "banner"}], dn="webA")
    put("baswewebsite", [{"siteid": 5, "sitename": "site", "siteurl": "u", "delete": 0}], dn="webA")
    put("member", [
        {"uid": 1, "ad_id": 1, "fullname": "Li", "memberlevel": "1", "phone": "13000000001"},
        {"uid": 2, "ad_id": 9, "fullname": "Wu", "memberlevel": "1", "phone": "13000000002"},
        {"uid": 3, "ad_id": 1, "fullname": "He", "memberlevel": "2", "dt": D2},
    ], **a)
    put("memberRegtype", [
        {"uid": 1, "appregurl": "x_y", "regsource": "1", "websiteid": 5, "createtime": "2019"},
        {"uid": 1, "appregurl": "z", "regsource": "2", "websiteid": 6, "createtime": "2018", "appkey": "k"},
    ], **a)
    put("pcentermempaymoney", [
        {"uid": 1, "paymoney": "10.5", "siteid": 5, "vip_id": 1},
        {"uid": 1, "paymoney": "4.5", "siteid": 5, "vip_id": 2},
        {"uid": 2, "paymoney": "7", "siteid": 5, "vip_id": 77},
        {"uid": 1, "paymoney": "3", "siteid": 5, "vip_id": 1, "dt": D2},
    ], **a)
    put("pcenterMemViplevel", [
        {"vip_id": 1, "vip_level": "gold", "start_time": "2019-01-01", "end_time": "2020-01-01", "next_level": "x"},
        {"vip_id": 2, "vip_level": "silver", "start_time": "2018-01-01", "end_time": "2019-06-01", "next_level": "y"},
    ], dn="webA")

    put("QzChapter", [{"chapterid": 1, "chapterlistid": 1, "chaptername": "c", "courseid": 1}], **a)
    put("QzChapterList", [{"chapterlistid": 1, "chapterlistname": "cl", "chapterallnum": 3}], **a)
    put("QzPoint", [{"pointid": 1, "chapterid": 1, "pointname": "p1", "score": "1.25"}, {"pointid": 2, "chapterid": 1, "pointname": "p2"}], **a)
    put("QzPointQuestion", [{"pointid": 1, "questionid": 1, "questtype": 1}, {"pointid": 2, "questionid": 2, "questtype": 1}], **a)
    put("QzSiteCourse", [{"sitecourseid": 1, "siteid": 5, "courseid": 1, "sitecoursename": "sc"}], **a)
    put("QzCourse", [{"courseid": 1, "majorid": 1, "coursename": "co"}], **a)
    put("QzCourseEduSubject", [{"courseeduid": 1, "edusubjectid": 1, "courseid": 1}], **a)
    put("QzWebsite", [{"siteid": 5, "sitename": "site"}], **a)
    put("QzMajor", [{"majorid": 1, "businessid": 1, "siteid": 5, "majorname": "m"}], **a)
    put("QzBusiness", [{"businessid": 1, "businessname": "b"}], **a)
    put("QzPaperView", [{"paperviewid": i, "paperid": 1, "paperviewname": f"view{i}"} for i in (1, 2)], **a)
    put("QzCenterPaper", [{"paperviewid": 1, "centerid": 1, "sequence": "s"}], **a)
    put("QzPaper", [{"paperid": 1, "courseid": 1, "papername": "pa", "totalscore": "100"}], **a)
    put("QzCenter", [{"centerid": 1, "centername": "ce"}], **a)
    put("QzQuestion", [{"questionid": i, "questypeid": 1, "score": "2"} for i in (1, 2)], **a)
    put("QzQuestionType", [{"questypeid": 1, "viewtypename": "v", "description": "d"}], **a)
    put("QzMemberPaperQuestion", [
        {"userid": 10 + i, "paperviewid": 1 + i % 2, "questionid": 1 + i % 2, "score": str(score), "spendtime": 10 * i,
         "question_answer": answer, "chapterid": 1, "sitecourseid": 1, "majorid": 1}
        for i, (score, answer) in enumerate([(100, 1), (60, 0), (60.5, 0), (20, 0), (0, 1), (20, 1)])
    ], **a)

    put("salecourse", [{"courseid": 1, "coursename": "co", "money": "9.5"}], **a)
    put("courseshoppingcart", [{"courseid": 1 + i % 2, "orderid": f"o{i}", "sellmoney": "3", "discount": "1", "createtime": "2019-07-22 00:00:00"} for i in range(6)], **a)
    put("coursepay", [{"orderid": f"o{i}", "paymoney": "2", "discount": "0"} for i in range(4)], **a)
    return str(folder)


@pytest.fixture(scope="module")
def house(tmp_path_factory):
    return Warehouse(str(tmp_path_factory.mktemp("house")), catalog_prefix="jobs_")


def test_member_area(spark, rows, ods, house):
    jobs.load_tables(spark, house, ods, jobs.MEMBER_TABLES)
    for _ in range(2):  # a repeated day replaces itself
        jobs.member_wide(spark, house, D1)
    wide = {r["uid"]: r for r in house.read(spark, "dws.dws_member", D1).collect()}
    assert sorted(wide) == [1, 2]
    one = wide[1]
    assert one["paymoney"] == Decimal("18.0000")  # payments of all days, not once per registration
    assert (one["adname"], one["vip_level"], one["vip_start_time"], one["vip_end_time"]) == ("banner", "silver", "2018-01-01", "2020-01-01")
    assert (one["appregurl"], one["siteid"], one["sitename"]) == ("x_y", 5, "site")  # the row without appkey comes first
    assert (wide[2]["adname"], wide[2]["appregurl"], wide[2]["vip_id"], wide[2]["paymoney"]) == (None, None, None, Decimal("7.0000"))
    jobs.member_wide(spark, house, D2)
    history = jobs.zipper_history(spark, house)
    assert rows(history, "uid", "paymoney", "vip_level", "start_time", "end_time") == [
        (1, Decimal("15.0000"), "silver", "2019-07-22", "2019-07-23"),
        (1, Decimal("18.0000"), "gold", "2019-07-23", "9999-12-31"),
    ]
    jobs.member_reports(spark, house, D1)
    urls = house.read(spark, "ads.ads_register_appregurlnum", D1)
    assert rows(urls, "appregurl", "num", "dn") == [(None, 1, "webA"), ("x_y", 1, "webA")]
    top = house.read(spark, "ads.ads_register_top3memberpay", D1)
    assert rows(top, "uid", "rownum") == [(1, 1), (2, 2)]


def test_question_area(spark, rows, ods, house):
    jobs.load_tables(spark, house, ods, jobs.QZ_TABLES)
    jobs.qz_wide(spark, house, D1)
    fact = house.read(spark, "dws.dws_user_paper_detail", D1)
    assert fact.count() == 12  # six answers, each once per point question of the chapter
    got = fact.where("userid = 10 and pointid = 1").first()
    assert (got["centername"], got["question_description"], got["point_score"], got["courseid"]) == ("ce", "d", Decimal("1.3"), 1)
    jobs.qz_reports(spark, house, D1)
    bands = house.read(spark, "ads.ads_paper_scoresegment_user", D1)
    assert rows(bands, "paperviewid", "score_segment", "userids") == [
        (1, "0-20", "14,14"), (1, "60-80", "12,12"), (1, "80-100", "10,10"), (2, "0-20", "13,13,15,15"), (2, "40-60", "11,11"),
    ]
    passes = house.read(spark, "ads.ads_user_paper_detail", D1)
    assert rows(passes, "paperviewid", "unpasscount", "passcount", "rate") == [(1, 2, 4, Decimal("0.67"))]  # only failures: absent
    errors = house.read(spark, "ads.ads_user_question_detail", D1)
    assert rows(errors, "questionid", "errcount", "rightcount", "rate") == [
        (1, 2, 4, Decimal("0.33")), (2, 4, 2, Decimal("0.67")),
    ]
    top = house.read(spark, "ads.ads_top3_userdetail", D1)
    assert rows(top.where("paperviewid = 2"), "userid", "rk") == [(11, 1), (11, 1), (13, 2), (13, 2), (15, 2), (15, 2)]
    averages = house.read(spark, "ads.ads_paper_avgtimeandscore", D1)
    assert rows(averages, "paperviewid", "avgscore", "avgspendtime") == [
        (1, Decimal("53.5"), Decimal("20.00")), (2, Decimal("33.3"), Decimal("30.00")),
    ]


def test_sales_area(spark, rows, ods, house):
    jobs.load_tables(spark, house, ods, jobs.SELL_TABLES + jobs.SELL_BUCKETED_TABLES)
    results = []
    for form in ("join", "salted", "broadcast", "bucketed"):
        jobs.sell_detail(spark, house, D1, form)
        results.append(rows(house.read(spark, "dws.dws_salecourse_detail", D1), "orderid", "courseid", "coursename", "paymoney"))
    assert results[0] == [
        ("o0", 1, "co", Decimal("2.0000")), ("o1", 2, None, Decimal("2.0000")), ("o2", 1, "co", Decimal("2.0000")),
        ("o3", 2, None, Decimal("2.0000")), ("o4", 1, "co", None), ("o5", 2, None, None),
    ]
    assert all(r == results[0] for r in results)
