"""Facts of members kept up to date from appended files."""

import shutil
from decimal import Decimal

from coursemill.plans import facts, member
from coursemill.sinks.tables import latest_version, write_files

SCHEMA = "uid int, paymoney string, siteid int, vip_id int, dt string, dn string"


def add(spark, root, *rows):
    write_files(spark.createDataFrame(list(rows), SCHEMA), f"{root}/table", partition_by=["dt", "dn"])


def fold(spark, root):
    query = facts.fold_appended(
        spark, f"{root}/table", SCHEMA, f"{root}/facts", member.payments, member.paid_by_level
    )
    return sum(p["numInputRows"] for p in query.recentProgress)


def read(spark, root):
    empty = member.paid_by_level(member.payments(spark.createDataFrame([], SCHEMA)))
    return facts.read_facts(spark, f"{root}/facts", empty.schema)


def one_go(spark, root):
    return member.paid_by_level(member.payments(spark.read.schema(SCHEMA).parquet(f"{root}/table")))


def test_a_day_opens_its_own_files_and_the_facts(spark, rows, tmp_path):
    root = str(tmp_path)
    add(spark, root, *[(u, "1.5", 1, 1, "20190720", "01") for u in range(50)])
    assert fold(spark, root) == 50
    add(spark, root, (1, "2", 1, 1, "20190721", "01"), (1, None, 1, 2, "20190721", "01"), (None, "7", 1, None, "20190721", "webB"))
    assert fold(spark, root) == 3
    add(spark, root, (1, "4", 1, 1, "20190719", "01"))  # an older day that comes late
    assert fold(spark, root) == 1
    assert fold(spark, root) == 0  # nothing new: nothing is read and no version is written
    got = read(spark, root)
    assert rows(got) == rows(one_go(spark, root), *got.columns)
    assert rows(got.where("uid = 1"), "dn", "vip_id", "paymoney") == [("01", 1, Decimal("7.5000")), ("01", 2, None)]
    assert got.count() == 52


def test_a_batch_handed_in_again_counts_once(spark, rows, tmp_path):
    root = str(tmp_path)
    add(spark, root, (1, "1", 1, 1, "20190720", "webA"))
    fold(spark, root)
    add(spark, root, (1, "2", 1, 1, "20190721", "webA"))
    shutil.copytree(f"{root}/facts/_checkpoint", f"{root}/before")
    assert fold(spark, root) == 1 and latest_version(spark, f"{root}/facts") == "1"
    # the driver is lost after the version was announced and before the checkpoint knew
    (tmp_path / "facts" / "_checkpoint").rename(tmp_path / "after")
    shutil.copytree(f"{root}/before", f"{root}/facts/_checkpoint")
    fold(spark, root)
    assert rows(read(spark, root), "paymoney") == [(Decimal("3.0000"),)]


def test_a_table_without_files_has_no_facts(spark, tmp_path):
    root = str(tmp_path)
    (tmp_path / "table").mkdir()
    assert fold(spark, root) == 0
    assert read(spark, root).count() == 0


def test_first_registration_of_parts_is_that_of_the_whole(spark, rows):
    kind = "uid int, appkey string, appregurl string, bdp_uuid string, isranreg string, regsource string, regsourcename string, dn string, createtime string, websiteid int"
    data = [(u % 3, None if i % 4 else "k", f"u{i * 7 % 5}", f"b{i}", "0", "1", "PC", "webA", f"c{i % 2}", i) for i in range(20) for u in range(4)]
    whole = member.registrations(spark.createDataFrame(data, kind))
    parts = [member.first_registrations(whole.where(f"websiteid % 3 = {k}")) for k in range(3)]
    merged = member.first_registrations(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    want = member.first_registrations(whole)
    assert rows(merged) == rows(want, *merged.columns)
