"""The batch jobs in the order the warehouse runs them: logs, cleaned tables, wide tables, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from coursemill.operators import zipper
from coursemill.plans import facts, history, member, qz, sellcourse
from coursemill.plans.etl import load
from coursemill.plans.specs import SPECS
from coursemill.plans.warehouse import Warehouse

# Load order of the cleaned tables per subject area.
MEMBER_TABLES = (
    "dwd_base_ad dwd_base_website dwd_member dwd_member_regtype dwd_pcentermempaymoney dwd_vip_level"
).split()
QZ_TABLES = (
    "dwd_qz_chapter dwd_qz_chapter_list dwd_qz_point dwd_qz_point_question dwd_qz_site_course dwd_qz_course "
    "dwd_qz_course_edusubject dwd_qz_website dwd_qz_major dwd_qz_business dwd_qz_paper_view dwd_qz_center_paper "
    "dwd_qz_paper dwd_qz_center dwd_qz_question dwd_qz_question_type dwd_qz_member_paper_question"
).split()
SELL_TABLES = "dwd_course_pay dwd_course_shopping_cart dwd_sale_course".split()
SELL_BUCKETED_TABLES = "dwd_course_pay_cluster dwd_course_shopping_cart_cluster".split()

_DAY_SITE = ("dt", "dn")


def load_tables(spark: SparkSession, house: Warehouse, ods: str, tables: list[str]) -> None:
    for table in tables:
        load(spark, house, SPECS[table], ods)


def _dwd(spark: SparkSession, house: Warehouse, table: str) -> DataFrame:
    return house.read(spark, f"dwd.{table}", schema=SPECS[table].schema)


def _replace_day(house: Warehouse, df: DataFrame, table: str, order_by: Sequence[Column | str] = ()) -> None:
    """Write a day's result over the same day of the table, in few files: running a day again does not double it."""
    house.write(df, table, _DAY_SITE, overwrite=True, compact=True, order_by=order_by)


# facts of members: cleaned table, the columns taken from it, how they are reduced
_MEMBER_FACTS = {
    "registered": ("dwd_member_regtype", member.registrations, member.first_registrations),
    "paid": ("dwd_pcentermempaymoney", member.payments, member.paid_by_level),
}


def member_facts(spark: SparkSession, house: Warehouse) -> dict[str, DataFrame]:
    """First registration and money per level of every member, brought up to date from the files added since the last run."""
    kept = {}
    for name, (table, columns, reduce) in _MEMBER_FACTS.items():
        schema, root = SPECS[table].schema, house.path(f"dws.dws_member_{name}")
        facts.fold_appended(spark, house.path(f"dwd.{table}"), schema, root, columns, reduce)
        empty = reduce(columns(spark.createDataFrame([], schema)))
        kept[name] = facts.read_facts(spark, root, empty.schema)
    return kept


def member_wide(spark: SparkSession, house: Warehouse, dt: str) -> None:
    """Wide member table of a day, then the day's merge into the payment history, with the later days' where it comes late.

    Registrations and payments of all time count, but only those that were not seen before are read (``member_facts``).
    """
    rows, ads, sites, pay, vip = (
        _dwd(spark, house, name)
        for name in "dwd_member dwd_base_ad dwd_base_website dwd_pcentermempaymoney dwd_vip_level".split()
    )
    kept = member_facts(spark, house)
    wide = member.wide_from_facts(rows, kept["registered"], ads, sites, kept["paid"], vip, dt)
    _replace_day(house, wide, "dws.dws_member")
    root = house.path("dws.dws_member_zipper")
    history.publish_from(spark, root, dt, lambda day: zipper.day_changes(pay, vip, day))


def zipper_history(spark: SparkSession, house: Warehouse) -> DataFrame:
    return history.read_all(spark, house.path("dws.dws_member_zipper"))


def member_reports(spark: SparkSession, house: Warehouse, dt: str) -> None:
    """Six counts and the top payers of a day. The day's slice is cached for the seven of them and then released."""
    wide = house.read(spark, "dws.dws_member", dt).persist()
    try:
        for report, attribute in member.COUNT_REPORTS.items():
            _replace_day(house, member.member_counts(wide, dt, attribute), f"ads.ads_{report}")
        _replace_day(house, member.top_payers(wide, dt), "ads.ads_register_top3memberpay", member.PAYERS_ORDER)
    finally:
        wide.unpersist()


_DIMS = {
    "chapter": qz.chapter_dim,
    "course": qz.course_dim,
    "major": qz.major_dim,
    "paper": qz.paper_dim,
    "question": qz.question_dim,
}


def qz_wide(spark: SparkSession, house: Warehouse, dt: str) -> None:
    """Five dimensions, then the fact from the dimensions as stored."""
    tables = {name.removeprefix("dwd_qz_"): _dwd(spark, house, name) for name in QZ_TABLES}
    for name, make in _DIMS.items():
        _replace_day(house, make(tables, dt), f"dws.dws_qz_{name}")
    dims = {name: house.read(spark, f"dws.dws_qz_{name}") for name in _DIMS}
    fact = qz.answer_fact(tables["member_paper_question"], dims, dt)
    _replace_day(house, fact, "dws.dws_user_paper_detail")


# Report tables of the question bank.
_QZ_REPORTS = {
    "ads.ads_paper_avgtimeandscore": qz.paper_averages,
    "ads.ads_paper_maxdetail": qz.paper_extremes,
    "ads.ads_top3_userdetail": lambda fact, dt: qz.paper_top_users(fact, dt),
    "ads.ads_low3_userdetail": lambda fact, dt: qz.paper_top_users(fact, dt, descending=False),
    "ads.ads_paper_scoresegment_user": qz.paper_score_bands,
    "ads.ads_user_paper_detail": qz.paper_pass_rates,
    "ads.ads_user_question_detail": qz.question_error_rates,
}
# reports with an order, which their files keep
_QZ_ORDERS = {
    "ads.ads_paper_avgtimeandscore": qz.averages_order,
    "ads.ads_paper_scoresegment_user": lambda: qz.BANDS_ORDER,
    "ads.ads_user_question_detail": qz.errors_order,
}


def qz_reports(spark: SparkSession, house: Warehouse, dt: str) -> None:
    """Seven reports. Each scans only its own few columns of the wide fact, so nothing is cached."""
    fact = house.read(spark, "dws.dws_user_paper_detail", dt)
    for table, make in _QZ_REPORTS.items():
        _replace_day(house, make(fact, dt), table, _QZ_ORDERS.get(table, tuple)())


def sell_detail(spark: SparkSession, house: Warehouse, dt: str, form: str = "join") -> None:
    """Sales detail of a day; ``form`` is join, salted, broadcast or bucketed and changes no row."""
    forms = {
        "join": sellcourse.sell_detail,
        "salted": sellcourse.sell_detail_salted,
        "broadcast": sellcourse.sell_detail_broadcast,
        "bucketed": sellcourse.sell_detail_bucketed,
    }
    course = _dwd(spark, house, "dwd_sale_course")
    if form == "bucketed":
        cart = house.read_bucketed(spark, "dwd.dwd_course_shopping_cart_cluster")
        pay = house.read_bucketed(spark, "dwd.dwd_course_pay_cluster")
    else:
        cart = _dwd(spark, house, "dwd_course_shopping_cart")
        pay = _dwd(spark, house, "dwd_course_pay")
    _replace_day(house, forms[form](course, cart, pay, dt), "dws.dws_salecourse_detail")
