import json

import pytest

from coursemill.plans import etl
from coursemill.plans.specs import SPECS
from coursemill.plans.warehouse import Warehouse


def lines(spark, *objects):
    return spark.createDataFrame([(o if isinstance(o, str) else json.dumps(o),) for o in objects], "value string")


def test_there_is_a_spec_for_every_table():
    assert len(SPECS) == 28
    assert len({s.log for s in SPECS.values()}) == 26
    for spec in SPECS.values():
        names = [f.name for f in spec.fields]
        assert len(names) == len(set(names))
        assert names[-len(spec.partition_by):] == list(spec.partition_by)


@pytest.mark.parametrize("table", sorted(SPECS))
def test_empty_object_gives_defaults(spark, table):
    spec = SPECS[table]
    got = etl.clean(lines(spark, {}), spec).first().asDict()
    for f in spec.fields:
        want = {"*": 0, "^": 0}.get(f.kind)
        if f.rule == "redact":
            want = "******"
        if f.rule == "source_label":
            want = "other"
        assert got[f.name] == want, f.name


def test_schema_of_cleaned_rows_is_the_declared_one(spark):
    for spec in SPECS.values():
        declared = spark.createDataFrame([], spec.schema)
        assert etl.clean(lines(spark, {}), spec).dtypes == declared.dtypes


def test_member_is_masked(spark):
    row = {"uid": "7", "fullname": "Wang", "phone": "13012345678", "password": "secret", "dt": "d", "dn": "a"}
    got = etl.clean(lines(spark, row, "bad", "[1]"), SPECS["dwd_member"]).collect()
    assert len(got) == 1
    assert (got[0]["uid"], got[0]["fullname"], got[0]["phone"], got[0]["password"]) == (7, "Wxx", "130*****5678", "******")


def test_other_json_keys(spark):
    got = etl.clean(lines(spark, {"questtype": "4"}), SPECS["dwd_qz_point_question"]).first()
    assert got["questype"] == 4
    got = etl.clean(lines(spark, {"regsource": 4}), SPECS["dwd_member_regtype"]).first()
    assert (got["regsource"], got["regsourcename"]) == ("4", "WeChat")


def test_append_and_overwrite_modes(spark, rows, tmp_path):
    house = Warehouse(str(tmp_path / "w"))
    ods = tmp_path / "ods"
    ods.mkdir()

    def put(log, *objects):
        (ods / f"{log}.log").write_text("\n".join(json.dumps(o) for o in objects) + "\n")

    put("baseadlog", {"adid": 1, "adname": "x", "dn": "a"}, {"adid": 2, "adname": "y", "dn": "b"})
    etl.load(spark, house, SPECS["dwd_base_ad"], str(ods))
    put("baseadlog", {"adid": 3, "adname": "z", "dn": "a"})
    etl.load(spark, house, SPECS["dwd_base_ad"], str(ods))
    ad = house.read(spark, "dwd.dwd_base_ad", schema=SPECS["dwd_base_ad"].schema)
    assert rows(ad) == [(2, "y", "b"), (3, "z", "a")]  # only the site in the new log is replaced

    put("coursepay", {"orderid": "o1", "discount": "1", "paymoney": "2.5", "createtime": "2019-07-22 10:00:00", "dt": "20190722", "dn": "a"})
    for _ in range(2):
        etl.load(spark, house, SPECS["dwd_course_pay"], str(ods))
    pay = house.read(spark, "dwd.dwd_course_pay", "20190722", SPECS["dwd_course_pay"].schema)
    assert pay.count() == 2
    assert house.read(spark, "dwd.dwd_course_pay", "20190723", SPECS["dwd_course_pay"].schema).count() == 0
    assert house.read(spark, "dwd.dwd_course_pay").first()["dt"] == "20190722"
