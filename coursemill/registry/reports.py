"""Wide tables, history, dimensions, fact, reports and sales detail, each with its check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from coursemill.operators import zipper
from coursemill.operators.grouping import two_phase_count
from coursemill.operators.joins import salted_join
from coursemill.plans import facts, history, member, qz, sellcourse
from coursemill.plans.warehouse import Warehouse
from coursemill.registry.book import add, query
from coursemill.registry.views import DT, QZ_TABLES, VIEWS, ctes, table, view
from coursemill.session import shuffle_files_removed, workspace
from coursemill.sinks.tables import write_files

# ---------------------------------------------------------------- member

_MEMBER_VIEWS = ("member", "registration", "ad", "website", "pay", "vip")


def _wide(ids_from_facts: bool):
    def run(spark, sf):
        m, r, a, w, p, v = (view(spark, sf, name) for name in _MEMBER_VIEWS)
        w = w.withColumnRenamed("site_delete", "delete")
        return member.wide_member(m, r, a, w, p, v, DT, ids_from_facts=ids_from_facts)

    return run


def _wide_check(ids_from_facts: bool) -> str:
    siteid = "r.websiteid" if ids_from_facts else "w.siteid"
    vip_id = "p.vip_id" if ids_from_facts else "v.vip_id"
    money = "coalesce(f.paymoney, 0)" if ids_from_facts else "f.paymoney"
    return ctes(*_MEMBER_VIEWS) + f""",
      r1 as (select *, row_number() over (partition by uid, dn order by appkey, appregurl, bdp_uuid) as n from registration),
      pv as (select p.uid, p.dn, {vip_id} as vip_id, p.paymoney, v.vip_level, v.start_time, v.end_time, v.last_modify_time,
               v.max_free, v.min_free, v.next_level, v.operator
             from pay p left join vip v on p.vip_id = v.vip_id and p.dn = v.dn),
      f1 as (select *, row_number() over (partition by uid, dn
               order by vip_id nulls first, max_free nulls first, min_free nulls first) as n from pv),
      f as (select uid, dn, cast(sum(cast(paymoney as decimal(10,4))) as decimal(20,4)) as paymoney,
              max(vip_level) as vip_level, min(start_time) as vip_start_time, max(end_time) as vip_end_time,
              max(last_modify_time) as vip_last_modify_time, max(next_level) as vip_next_level from pv group by uid, dn)
    select m.uid, m.ad_id, m.fullname, m.iconurl, m.lastlogin, m.mailaddr, m.memberlevel, m.password,
      cast({money} as decimal(20,4)) as paymoney, m.phone, m.qq, m.register, m.regupdatetime, m.unitname, m.userip,
      m.zipcode, r.appkey, r.appregurl, r.bdp_uuid, r.createtime as reg_createtime, r.isranreg, r.regsource,
      r.regsourcename, a.adname, {siteid} as siteid, w.sitename, w.siteurl, w.site_delete,
      w.createtime as site_createtime, w.creator as site_creator, g.vip_id, f.vip_level, f.vip_start_time,
      f.vip_end_time, f.vip_last_modify_time, g.max_free as vip_max_free, g.min_free as vip_min_free,
      f.vip_next_level, g.operator as vip_operator, m.dt, m.dn
    from member m
      left join r1 r on m.uid = r.uid and m.dn = r.dn and r.n = 1
      left join ad a on m.ad_id = a.adid and m.dn = a.dn
      left join website w on r.websiteid = w.siteid and r.dn = w.dn
      left join f on m.uid = f.uid and m.dn = f.dn
      left join f1 g on m.uid = g.uid and m.dn = g.dn and g.n = 1
    where m.dt = '{DT}'"""


add("wide_customer", _wide(False), _wide_check(False))
add("wide_customer_api", _wide(True), _wide_check(True))


def _appended_facts(spark, name, rows, columns, reduce):
    """Facts of a table that is appended to on three days, each folded in before the next one comes."""
    root = workspace(spark, name)
    rows = rows.withColumn("dt", F.concat(F.lit("2019072"), F.pmod(F.xxhash64(*rows.columns), F.lit(3)).cast("string")))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    for day in ("20190720", "20190721", "20190722"):
        write_files(rows.where(F.col("dt") == day), f"{root}/table", partition_by=["dt", "dn"], compact=True)
        facts.fold_appended(spark, f"{root}/table", schema, f"{root}/facts", columns, reduce)
    return facts.read_facts(spark, f"{root}/facts", reduce(columns(rows)).schema)


@query("wide_customer_appended", _wide_check(True))
def wide_customer_appended(spark, sf):
    """The wide table from facts that were kept up to date over three days; it equals the one built in one go."""
    m, r, a, w, p, v = (view(spark, sf, name) for name in _MEMBER_VIEWS)
    registered = _appended_facts(spark, "registered", r, member.registrations, member.first_registrations)
    paid = _appended_facts(spark, "paid", p, member.payments, member.paid_by_level)
    w = w.withColumnRenamed("site_delete", "delete")
    return member.wide_from_facts(m, registered, a, w, paid, v, DT, ids_from_facts=True)


def _counts(attribute: str):
    def run(spark, sf):
        return member.member_counts(view(spark, sf, "dws_member"), DT, attribute)

    return run


for _report, _attribute in member.COUNT_REPORTS.items():
    add(
        _report,
        _counts(_attribute),
        ctes("dws_member")
        + f"select {_attribute}, count(uid) as num, dt, dn from dws_member where dt = '{DT}' group by {_attribute}, dt, dn",
    )


@query(
    "top3_by_group",
    ctes("dws_member")
    + f"""select uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level, paymoney, rownum, dt, dn
      from (select *, cast(row_number() over (partition by dn, memberlevel order by paymoney desc, uid) as int) as rownum
            from dws_member where dt = '{DT}') where rownum < 4""",
)
def top3_by_group(spark, sf):
    return member.top_payers(view(spark, sf, "dws_member"), DT)


# The history is built from every payment: each year is one day of the table, and the last year is merged in.
_DAYS = """
select cast(o_custkey as int) as uid, cast(o_totalprice as decimal(10,2)) as paymoney,
  cast(o_orderkey % 30 as int) as vip_id, substr(cast(cast(o_orderdate as date) as string), 1, 4) as year,
  case when o_custkey % 3 = 0 then 'webB' else 'webA' end as dn
from {orders}"""
VIEWS["yearly_pay"] = _DAYS


def _zipper_inputs(spark, sf):
    """History rows of all years but the last, already chained, and the last year's payments as the new day."""
    pay, vip = view(spark, sf, "yearly_pay"), view(spark, sf, "vip")
    years = pay.groupBy("uid", "dn", "year").agg(F.sum("paymoney").alias("m"), F.max("vip_id").alias("v"))
    latest = table(spark, sf, "orders").agg(F.max(F.year("o_orderdate")).cast("string").alias("y")).first()["y"]
    old = years.where(F.col("year") < latest)
    chain = W.partitionBy("uid", "dn").orderBy("year")
    start = F.concat("year", F.lit("-01-01"))
    before = old.select(
        "uid",
        F.sum("m").over(chain).cast("decimal(20,4)").alias("paymoney"),
        F.concat(F.lit("level "), (F.col("v") % 8).cast("string")).alias("vip_level"),
        start.alias("start_time"),
        F.coalesce(F.lead(start).over(chain), F.lit("9999-12-31")).alias("end_time"),
        "dn",
    )
    today = pay.where(F.col("year") == latest).withColumn("dt", F.lit(f"{latest}0101"))
    return before, today, vip, latest


_ZIPPER_CHECK = ctes("yearly_pay", "vip") + """,
  last as (select max(year) as y from yearly_pay),
  y as (select uid, dn, year, sum(paymoney) as m, max(vip_id) as v from yearly_pay, last where year < last.y group by uid, dn, year),
  h as (select uid, dn, year || '-01-01' as start_time, 'level ' || cast(v % 8 as string) as vip_level,
          sum(m) over (partition by uid, dn order by year) as paymoney from y),
  d as (select p.uid, p.dn, last.y || '-01-01' as start_time, max(v.vip_level) as vip_level, sum(p.paymoney) as paymoney
        from yearly_pay p join last on p.year = last.y join vip v on p.vip_id = v.vip_id and p.dn = v.dn
        group by p.uid, p.dn, last.y),
  u as (select *, false as today from h union all by name select *, true as today from d)
select uid, dn, vip_level, start_time,
  coalesce(lead(start_time) over w, '9999-12-31') as end_time,
  cast(case when today then paymoney + coalesce(lag(paymoney) over w, 0) else paymoney end as decimal(20,4)) as paymoney
from u window w as (partition by uid, dn order by start_time)"""


@query("scd2_zipper", _ZIPPER_CHECK)
def scd2_zipper(spark, sf):
    before, today, vip, latest = _zipper_inputs(spark, sf)
    day = zipper.day_changes(today, vip, f"{latest}0101")
    return zipper.merge_day(before, day, f"{latest}-01-01")


@query("scd2_zipper_rerun", _ZIPPER_CHECK)
def scd2_zipper_rerun(spark, sf):
    """The stored form: older years as one run, then the last year merged twice, which must count once."""
    before, today, vip, latest = _zipper_inputs(spark, sf)
    day, root = zipper.day_changes(today, vip, f"{latest}0101"), workspace(spark, "zipper")
    history.publish_day(before, root, "00000000")
    for _ in range(2):
        open_rows = history.open_before(spark, root, f"{latest}0101")
        history.publish_day(zipper.merge_open(open_rows, day), root, f"{latest}0101")
    return history.read_all(spark, root)


@query(
    "scd2_zipper_late",
    ctes("yearly_pay", "vip") + """,
  last as (select cast(max(year) as int) as y from yearly_pay),
  d as (select p.uid, p.dn, greatest(cast(p.year as int), last.y - 3) || '-01-01' as start_time,
          max(v.vip_level) as vip_level, sum(p.paymoney) as paymoney
        from yearly_pay p, last join vip v on p.vip_id = v.vip_id and p.dn = v.dn
        group by p.uid, p.dn, greatest(cast(p.year as int), last.y - 3))
select uid, dn, vip_level, start_time, coalesce(lead(start_time) over w, '9999-12-31') as end_time,
  cast(sum(paymoney) over w as decimal(20,4)) as paymoney
from d window w as (partition by uid, dn order by start_time)""",
)
def scd2_zipper_late(spark, sf):
    """Four days of payments, of which the third comes after the fourth: the history is that of days in their order."""
    pay, vip = view(spark, sf, "yearly_pay"), view(spark, sf, "vip")
    latest = table(spark, sf, "orders").agg(F.max(F.year("o_orderdate")).alias("y")).first()["y"]
    days = [f"{year}0101" for year in range(latest - 3, latest + 1)]
    pay = pay.withColumn("dt", F.greatest(F.concat("year", F.lit("0101")), F.lit(days[0])))
    root = workspace(spark, "zipper")
    for day in (days[0], days[1], days[3], days[2]):
        history.publish_from(spark, root, day, lambda d: zipper.day_changes(pay, vip, d))
    return history.read_all(spark, root)


# ---------------------------------------------------------------- question bank


def _cols(alias: str, columns: str) -> str:
    parts = []
    for text in columns.split():
        old, _, new = text.partition(":")
        if new != "-":
            parts.append(f"{alias}.{old}" + (f" as {new}" if new else ""))
    return ", ".join(parts)


def _without(columns: str, *names: str) -> str:
    return " ".join(c for c in columns.split() if c not in names)


_CHAPTER_SQL = f"""select {_cols("a", qz._CHAPTER)}, b.chapterlistname, b.chapterallnum,
  {_cols("c", _without(qz._POINT, "chapterid", "dn"))}, d.questionid, d.questype
  from qz_chapter a join qz_chapter_list b on a.chapterlistid = b.chapterlistid and a.dn = b.dn and b.dt = '{DT}'
  join qz_point c on a.chapterid = c.chapterid and a.dn = c.dn and c.dt = '{DT}'
  join qz_point_question d on c.pointid = d.pointid and c.dn = d.dn and d.dt = '{DT}' where a.dt = '{DT}'"""
_COURSE_SQL = f"""select {_cols("a", qz._SITE_COURSE)}, b.majorid, b.coursename, b.isadvc, b.chapterlistid, b.pointlistid,
  c.courseeduid, c.edusubjectid
  from qz_site_course a join qz_course b on a.courseid = b.courseid and a.dn = b.dn and b.dt = '{DT}'
  join qz_course_edusubject c on a.courseid = c.courseid and a.dn = c.dn and c.dt = '{DT}' where a.dt = '{DT}'"""
_MAJOR_SQL = f"""select {_cols("a", qz._MAJOR)}, {_cols("b", _without(qz._WEBSITE, "siteid", "dn"))}, c.businessname
  from qz_major a join qz_website b on a.siteid = b.siteid and a.dn = b.dn and b.dt = '{DT}'
  join qz_business c on a.businessid = c.businessid and a.dn = c.dn and c.dt = '{DT}' where a.dt = '{DT}'"""
_PAPER_SQL = f"""select {_cols("a", qz._PAPER_VIEW)}, b.sequence, b.centerid, {_cols("c", _without(qz._CENTER, "centerid", "dn"))},
  {_cols("d", _without(qz._PAPER, "paperid", "dn"))}
  from qz_paper_view a left join qz_center_paper b on a.paperviewid = b.paperviewid and a.dn = b.dn and b.dt = '{DT}'
  left join qz_center c on b.centerid = c.centerid and b.dn = c.dn and c.dt = '{DT}'
  join qz_paper d on a.paperid = d.paperid and a.dn = d.dn and d.dt = '{DT}' where a.dt = '{DT}'"""
_QUESTION_SQL = f"""select {_cols("a", qz._QUESTION)}, {_cols("b", _without(qz._QUESTION_TYPE, "questypeid", "dn"))}
  from qz_question a join qz_question_type b on a.questypeid = b.questypeid and a.dn = b.dn and b.dt = '{DT}'
  where a.dt = '{DT}'"""

_DIMS = {
    "chapter": (qz.chapter_dim, ("chapter", "chapter_list", "point", "point_question"), _CHAPTER_SQL),
    "course": (qz.course_dim, ("site_course", "course", "course_edusubject"), _COURSE_SQL),
    "major": (qz.major_dim, ("major", "website", "business"), _MAJOR_SQL),
    "paper": (qz.paper_dim, ("paper_view", "center_paper", "center", "paper"), _PAPER_SQL),
    "question": (qz.question_dim, ("question", "question_type"), _QUESTION_SQL),
}


def _qz(spark, sf, names):
    return {name: view(spark, sf, f"qz_{name}") for name in names}


def _dim(make, names):
    def run(spark, sf):
        return make(_qz(spark, sf, names), DT)

    return run


for _name, (_make, _names, _sql) in _DIMS.items():
    add(f"dim_star_{_name}", _dim(_make, _names), ctes(*[f"qz_{n}" for n in _names]) + _sql)

_FACT_SQL = (
    ctes(*[f"qz_{n}" for n in QZ_TABLES])
    + ", "
    + ", ".join(f"dim_{name} as ({sql})" for name, (_, _, sql) in _DIMS.items())
    + f""" select {_cols("f", qz._FACT)}, {_cols("a", _without(qz._FACT_COURSE, "sitecourseid", "dn"))},
      {_cols("b", _without(qz._FACT_MAJOR, "majorid", "dn"))}, {_cols("c", _without(qz._FACT_PAPER, "paperviewid", "dn"))},
      {_cols("d", _without(qz._FACT_QUESTION, "questionid", "dn"))}, {_cols("e", _without(qz._FACT_CHAPTER, "chapterid", "dn"))}
      from qz_member_paper_question f
      join dim_course a on f.sitecourseid = a.sitecourseid and f.dn = a.dn
      join dim_major b on f.majorid = b.majorid and f.dn = b.dn
      join dim_paper c on f.paperviewid = c.paperviewid and f.dn = c.dn
      join dim_question d on f.questionid = d.questionid and f.dn = d.dn
      join dim_chapter e on f.chapterid = e.chapterid and f.dn = e.dn
      where f.dt = '{DT}'"""
)


# dimensions that are joins of growing tables; a question only meets its few types, and its table is by far the largest
_STORED = ("chapter", "course", "major", "paper")


@query("fact_star", _FACT_SQL)
def fact_star(spark, sf):
    """The fact from dimensions as stored, as in the job ``qz_wide``.

    The fact reads some of them several times, and its plan is made anew after each of its stages, by the driver and in its
    memory. A stored dimension is one scan in it, and its joins are run once.
    """
    t, root = _qz(spark, sf, QZ_TABLES), workspace(spark, "star")
    dims = {name: make(t, DT) for name, (make, _, _) in _DIMS.items()}
    dims |= {name: _stored(dims[name], f"{root}/{name}") for name in _STORED}
    return qz.answer_fact(t["member_paper_question"], dims, DT)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with shuffle_files_removed(df.sparkSession):
        write_files(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_DETAIL = ctes("paper_detail")
_RANK_COLS = (
    "userid, paperviewid, paperviewname, chaptername, pointname, sitecoursename, coursename, majorname, shortname, "
    "sitename, papername, score"
)


def _report(name: str, make, check: str) -> None:
    add(name, lambda spark, sf: make(view(spark, sf, "paper_detail"), DT), _DETAIL + check)


# averages in whole numbers: tenths of a score, rounded half up to 5 places and then to 1, as a decimal average is
_report(
    "avg_by_group",
    qz.paper_averages,
    f"""select paperviewid, paperviewname, cast(cast((k5 + 5000) // 10000 as double) / 10 as decimal(4,1)) as avgscore,
      cast(cast((200 * t + n) // (2 * n) as double) / 100 as decimal(10,2)) as avgspendtime, dt, dn
      from (select *, (20000 * s + n) // (2 * n) as k5 from (
        select paperviewid, paperviewname, dt, dn, cast(count(*) as bigint) as n, cast(sum(spendtime) as bigint) as t,
          cast(sum(score) * 10 as bigint) as s from paper_detail where dt = '{DT}' group by paperviewid, paperviewname, dt, dn))""",
)
_report(
    "minmax_by_group",
    qz.paper_extremes,
    f"""select paperviewid, paperviewname, max(score) as maxscore, min(score) as minscore, dt, dn from paper_detail
      where dt = '{DT}' group by paperviewid, paperviewname, dt, dn""",
)
for _name, _desc in (("dense_top3", True), ("dense_low3", False)):
    _report(
        _name,
        (lambda desc: lambda fact, dt: qz.paper_top_users(fact, dt, descending=desc))(_desc),
        f"""select {_RANK_COLS}, rk, dt, dn from (select *, cast(dense_rank() over (partition by paperviewid
          order by score {"desc" if _desc else "asc"}) as int) as rk from paper_detail where dt = '{DT}') where rk < 4""",
    )
_report(
    "score_segments",
    qz.paper_score_bands,
    f"""select paperviewid, paperviewname, score_segment, cast(0 as bigint) as part,
      string_agg(cast(userid as string), ',' order by userid) as userids, dt, dn from (
        select *, case when score >= 0 and score <= 20 then '0-20' when score > 20 and score <= 40 then '20-40'
          when score > 40 and score <= 60 then '40-60' when score > 60 and score <= 80 then '60-80'
          when score > 80 and score <= 100 then '80-100' end as score_segment from paper_detail where dt = '{DT}')
      group by paperviewid, paperviewname, score_segment, dt, dn""",
)
_report(
    "score_segments_parts",
    lambda fact, dt: qz.paper_score_bands(fact, dt, parts=3),
    f"""select paperviewid, paperviewname, score_segment, part, string_agg(cast(userid as string), ',' order by userid) as userids, dt, dn from (
        select *, (row_number() over (partition by paperviewid, paperviewname, score_segment, dt, dn order by userid) - 1) * 3
          // count(*) over (partition by paperviewid, paperviewname, score_segment, dt, dn) as part
        from (select *, case when score >= 0 and score <= 20 then '0-20' when score > 20 and score <= 40 then '20-40'
          when score > 40 and score <= 60 then '40-60' when score > 60 and score <= 80 then '60-80'
          when score > 80 and score <= 100 then '80-100' end as score_segment from paper_detail where dt = '{DT}'))
      group by paperviewid, paperviewname, score_segment, part, dt, dn""",
)
_report(
    "pass_rate",
    qz.paper_pass_rates,
    f"""select a.paperviewid, a.paperviewname, a.unpasscount, b.passcount, cast(cast(
        (200 * b.passcount + a.unpasscount + b.passcount) // (2 * (a.unpasscount + b.passcount)) as double) / 100
        as decimal(4,2)) as rate, a.dt, a.dn
      from (select paperviewid, paperviewname, dt, dn, count(*) as unpasscount from paper_detail
            where dt = '{DT}' and score between 0 and 60 group by paperviewid, paperviewname, dt, dn) a
      join (select paperviewid, dn, count(*) as passcount from paper_detail where dt = '{DT}' and score > 60
            group by paperviewid, dn) b on a.paperviewid = b.paperviewid and a.dn = b.dn""",
)
_report(
    "error_rate",
    qz.question_error_rates,
    f"""select a.questionid, a.errcount, b.rightcount, cast(cast(
        (200 * a.errcount + a.errcount + b.rightcount) // (2 * (a.errcount + b.rightcount)) as double) / 100
        as decimal(4,2)) as rate, a.dt, a.dn
      from (select questionid, dt, dn, count(*) as errcount from paper_detail
            where dt = '{DT}' and user_question_answer = '0' group by questionid, dt, dn) a
      join (select questionid, dn, count(*) as rightcount from paper_detail where dt = '{DT}' and user_question_answer = '1'
            group by questionid, dn) b on a.questionid = b.questionid and a.dn = b.dn""",
)

# ---------------------------------------------------------------- course sales

_SELL_SQL = (
    ctes("sale_course", "cart", "course_pay")
    + f"""select b.courseid, a.coursename, a.status, a.pointlistid, a.majorid, a.chapterid, a.chaptername, a.edusubjectid,
      a.edusubjectname, a.teacherid, a.teachername, a.coursemanager, a.money, b.orderid, b.discount as cart_discount,
      b.sellmoney, b.createtime as cart_createtime, c.discount as pay_discount, c.paymoney, c.createtime as pay_createtime,
      b.dt, b.dn
      from cart b left join sale_course a on a.courseid = b.courseid and a.dt = b.dt and a.dn = b.dn
      left join course_pay c on b.orderid = c.orderid and b.dt = c.dt and b.dn = c.dn where b.dt = '{DT}'"""
)


def _sell_inputs(spark, sf):
    return [view(spark, sf, name) for name in ("sale_course", "cart", "course_pay")]


@query("sell_detail_join", _SELL_SQL)
def sell_detail_join(spark, sf):
    return sellcourse.sell_detail(*_sell_inputs(spark, sf), DT)


@query("sell_detail_salted", _SELL_SQL)
def sell_detail_salted(spark, sf):
    return sellcourse.sell_detail_salted(*_sell_inputs(spark, sf), DT)


@query("sell_detail_salted_hot", _SELL_SQL)
def sell_detail_salted_hot(spark, sf):
    """With a share low enough that the hot courses of an even table are salted, too."""
    return sellcourse.sell_detail_salted(*_sell_inputs(spark, sf), DT, salts=16, hot_share=0.0002)


@query("sell_detail_salted_all", _SELL_SQL)
def sell_detail_salted_all(spark, sf):
    return sellcourse.sell_detail_salted(*_sell_inputs(spark, sf), DT, salts=16, hot_share=None)


@query("sell_detail_broadcast", _SELL_SQL)
def sell_detail_broadcast(spark, sf):
    return sellcourse.sell_detail_broadcast(*_sell_inputs(spark, sf), DT)


def bucketed_sales(spark, sf, unnamed=None):
    """Cart and payments stored as bucketed tables, and the catalog. Cart lines that are ``unnamed`` lose their order."""
    course, cart, pay = _sell_inputs(spark, sf)
    if unnamed is not None:
        cart = cart.withColumn("orderid", F.when(~unnamed, F.col("orderid")))
    root = workspace(spark, "sales")
    house = Warehouse(root, catalog_prefix=f"t{root.rsplit('-', 1)[1]}_")
    for name, df in (("dwd.course_shopping_cart_cluster", cart), ("dwd.course_pay_cluster", pay)):
        house.append_bucketed(df, name, "orderid", ("dt", "dn"))
    return (
        course,
        house.read_bucketed(spark, "dwd.course_shopping_cart_cluster"),
        house.read_bucketed(spark, "dwd.course_pay_cluster"),
    )


@query("sell_detail_bucketed", _SELL_SQL)
def sell_detail_bucketed(spark, sf):
    return sellcourse.sell_detail_bucketed(*bucketed_sales(spark, sf), DT)


@query(
    "sell_detail_bucketed_unnamed",
    _SELL_SQL.replace(
        "from cart b",
        "from (select * replace (case when courseid % 2 = 1 then orderid end as orderid) from cart) b",
    ),
)
def sell_detail_bucketed_unnamed(spark, sf):
    """Half of the cart without an order, which all lies in one bucket and goes round the join."""
    return sellcourse.sell_detail_bucketed(*bucketed_sales(spark, sf, unnamed=F.col("courseid") % 2 == 0), DT)


@query(
    "salted_null_keys",
    """select o_orderkey, o_totalprice, c_name, c_custkey
    from (select o_orderkey, o_totalprice, case when o_orderkey % 2 = 0 then o_custkey end as c_custkey from orders) left join customer using (c_custkey)""",
)
def salted_null_keys(spark, sf):
    """Half of the orders without a customer and no customer hot: the null keys alone are spread."""
    key = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("c_custkey")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", key)
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return salted_join(customers, orders, ["c_custkey"], "right", spread_by=["o_orderkey"], hot_share=0.01)


@query("two_phase_salted", "select l_partkey, count(*) as num from lineitem group by l_partkey")
def two_phase_salted(spark, sf):
    return two_phase_count(
        table(spark, sf, "lineitem"), ["l_partkey"], "num", spread_by=["l_orderkey", "l_linenumber"]
    )
