"""The driver's tables seen as warehouse tables and messages.

Each view is one SELECT that both Spark SQL and the checking engine understand, over whole tables. Spark runs the real
jobs on the view; the check runs its own SQL on the same view.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

from coursemill.plans.specs import SPECS, Field

DT = "20190722"


def _dt(key: str) -> str:
    return f"case when {key} % 11 = 10 then '20190721' else '{DT}' end"


def _text(name: str, i: int, key: str) -> str:
    return f"case when {key} % 19 = {i % 19} then null else '{name}-' || cast({key} % {11 + i} as string) end"


def _raw(field: Field, i: int, key: str) -> str:
    """Text of a log field, as it stands in the JSON line: some are absent, some malformed."""
    if field.name == "dt":
        return _dt(key)
    if field.name == "dn":
        return f"case when {key} % 3 = 0 then 'webB' else 'webA' end"
    if field.kind in ("*", "?"):
        return (
            f"case when {key} % 13 = {i % 13} then null when {key} % 17 = {i % 17} then 'abc' "
            f"when {key} % 29 = {i % 29} then cast({key} % 50 as string) || '.7' "
            f"else cast({key} % 100000 + {i} as string) end"
        )
    if field.kind in ("^", "$"):
        return (
            f"case when {key} % 13 = {i % 13} then null "
            f"else cast({key} % 90 as string) || '.' || cast({key} % 100 as string) end"
        )
    if field.kind == "@":
        return f"case when {key} % 13 = 1 then 'never' else '2019-07-' || cast(10 + {key} % 20 as string) end"
    return _text(field.name, i, key)


def _typed(field: Field, i: int, key: str) -> str:
    """Value of a column of the cleaned layer."""
    if field.name == "dt":
        return f"'{DT}'"
    if field.name == "dn":
        return "'webA'"
    if field.kind in ("*", "?"):
        return f"cast({key} % {23 + i} as int)"
    if field.kind in ("^", "$"):
        return f"cast({key} % 90 as {field.type})"
    return _text(field.name, i, key)


def _view(table: str, base: str, key: str, make, overrides: dict[str, str], by_key: bool) -> str:
    items = {}
    for i, field in enumerate(SPECS[table].fields):
        if by_key and field.rule == "redact":
            continue
        name = field.key if by_key else field.name
        items.setdefault(name, overrides.get(name) or make(field, i, key))
    return "select " + ", ".join(f"{sql} as {name}" for name, sql in items.items()) + f" from {{{base}}}"


# table of the cleaned layer -> base table, its key, texts that need a certain form
_LOGS = {
    "dwd_member_regtype": ("orders", "o_orderkey", {"regsource": "cast(o_orderkey % 6 as string)"}),
    "dwd_member": (
        "customer",
        "c_custkey",
        {
            "fullname": "case when c_custkey % 9 = 0 then null else c_name end",
            "phone": "case when c_custkey % 9 = 1 then null else cast(13000000000 + c_custkey * 7919 as string) end",
        },
    ),
    "dwd_base_ad": ("part", "p_partkey", {}),
    "dwd_base_website": ("supplier", "s_suppkey", {}),
    "dwd_pcentermempaymoney": ("orders", "o_orderkey", {"paymoney": "cast(cast(o_totalprice as decimal(12,2)) as string)"}),
    "dwd_vip_level": ("nation", "n_nationkey", {}),
    "dwd_qz_chapter": ("part", "p_partkey", {}),
    "dwd_qz_chapter_list": ("customer", "c_custkey", {}),
    "dwd_qz_point": ("part", "p_partkey", {}),
    "dwd_qz_point_question": ("lineitem", "l_orderkey * 8 + l_linenumber", {}),
    "dwd_qz_site_course": ("supplier", "s_suppkey", {}),
    "dwd_qz_course": ("customer", "c_custkey", {}),
    "dwd_qz_course_edusubject": ("part", "p_partkey", {}),
    "dwd_qz_website": ("supplier", "s_suppkey", {}),
    "dwd_qz_major": ("nation", "n_nationkey", {}),
    "dwd_qz_business": ("region", "r_regionkey", {}),
    "dwd_qz_paper_view": ("customer", "c_custkey", {}),
    "dwd_qz_center_paper": ("orders", "o_orderkey", {}),
    "dwd_qz_paper": ("part", "p_partkey", {}),
    "dwd_qz_center": ("supplier", "s_suppkey", {}),
    "dwd_qz_question": ("orders", "o_orderkey", {}),
    "dwd_qz_question_type": ("nation", "n_nationkey", {}),
    "dwd_qz_member_paper_question": ("lineitem", "l_orderkey * 8 + l_linenumber", {}),
    "dwd_sale_course": ("part", "p_partkey", {"money": "cast(cast(p_retailprice as decimal(12,2)) as string)"}),
    "dwd_course_pay": ("orders", "o_orderkey", {"orderid": "cast(o_orderkey as string)"}),
    "dwd_course_pay_cluster": ("orders", "o_orderkey", {"orderid": "cast(o_orderkey as string)"}),
    "dwd_course_shopping_cart": ("lineitem", "l_orderkey * 8 + l_linenumber", {"orderid": "cast(l_orderkey as string)"}),
    "dwd_course_shopping_cart_cluster": (
        "lineitem", "l_orderkey * 8 + l_linenumber", {"orderid": "cast(l_orderkey as string)"},
    ),
}

# question-bank tables with the keys that make their joins meet: some rows of each side find no partner
_QZ = {
    "chapter": ("dwd_qz_chapter", "part", "p_partkey", {"chapterid": "cast(p_partkey as int)", "chapterlistid": "p_size % 30"}),
    "chapter_list": ("dwd_qz_chapter_list", "nation", "n_nationkey", {"chapterlistid": "n_nationkey"}),
    "point": (
        "dwd_qz_point", "part", "p_partkey",
        {"pointid": "cast(p_partkey as int)", "chapterid": "cast(p_partkey - p_partkey % 2 as int)"},
    ),
    "point_question": (
        "dwd_qz_point_question", "part", "p_partkey",
        {"pointid": "cast(p_partkey as int)", "questionid": "cast(p_partkey as int)"},
    ),
    "site_course": (
        "dwd_qz_site_course", "supplier", "s_suppkey",
        {"sitecourseid": "cast(s_suppkey as int)", "courseid": "cast(s_suppkey as int)"},
    ),
    "course": ("dwd_qz_course", "supplier", "s_suppkey", {"courseid": "cast(s_suppkey as int)"}),
    "course_edusubject": ("dwd_qz_course_edusubject", "supplier", "s_suppkey", {"courseid": "cast(s_suppkey as int)"}),
    "major": (
        "dwd_qz_major", "nation", "n_nationkey",
        {"majorid": "n_nationkey", "siteid": "n_nationkey % 6", "businessid": "n_regionkey"},
    ),
    "website": ("dwd_qz_website", "region", "r_regionkey", {"siteid": "r_regionkey"}),
    "business": ("dwd_qz_business", "region", "r_regionkey", {"businessid": "r_regionkey"}),
    "paper_view": (
        "dwd_qz_paper_view", "customer", "c_custkey",
        {"paperviewid": "cast(c_custkey as int)", "paperid": "c_nationkey"},
    ),
    "center_paper": (
        "dwd_qz_center_paper", "customer", "c_custkey",
        {"paperviewid": "cast(c_custkey * 2 as int)", "centerid": "c_nationkey"},
    ),
    "center": ("dwd_qz_center", "nation", "n_nationkey", {"centerid": "n_nationkey * 2"}),
    "paper": ("dwd_qz_paper", "nation", "n_nationkey", {"paperid": "n_nationkey"}),
    "question": (
        "dwd_qz_question", "orders", "o_orderkey",
        {"questionid": "cast(o_orderkey as int)", "questypeid": "cast(o_orderkey % 6 as int)"},
    ),
    "question_type": ("dwd_qz_question_type", "region", "r_regionkey", {"questypeid": "r_regionkey"}),
    "member_paper_question": (
        "dwd_qz_member_paper_question", "lineitem", "(l_orderkey * 8 + l_linenumber)",
        {
            "userid": "cast(l_orderkey as int)",
            "paperviewid": "cast(l_suppkey as int)",
            "chapterid": "cast(l_partkey as int)",
            "sitecourseid": "cast(l_suppkey as int)",
            "questionid": "cast(l_orderkey as int)",
            "majorid": "l_linenumber * 3 % 28",
            "question_answer": "case l_returnflag when 'A' then 0 when 'R' then 1 else 2 end",
            "dn": "case when l_linenumber = 7 then 'webB' else 'webA' end",
        },
    ),
}
QZ_TABLES = tuple(_QZ)

_MEMBER_DN = "case when {k} % 3 = 0 then 'webB' else 'webA' end"


def _both_sites(key: str, name: str, shift: int, cols: str, base: str) -> str:
    """A lookup table with rows for two sites; ids of the second one are shifted, so some members find no partner."""
    return (
        f"select {key} as {name}, {cols}, 'webA' as dn from {{{base}}} union all "
        f"select {key} + {shift} as {name}, {cols}, 'webB' as dn from {{{base}}}"
    )


VIEWS: dict[str, str] = {}
for _table, (_base, _key, _over) in _LOGS.items():
    VIEWS[f"log_{_table}"] = _view(_table, _base, f"({_key})" if " " in _key else _key, _raw, _over, True)
for _name, (_table, _base, _key, _over) in _QZ.items():
    VIEWS[f"qz_{_name}"] = _view(_table, _base, _key, _typed, _over, False)

VIEWS["member"] = f"""
select cast(c_custkey as int) as uid, c_nationkey as ad_id, substr(c_name, 1, 1) || 'xx' as fullname,
  'icon-' || cast(c_custkey % 50 as string) as iconurl, '2019-07-' || cast(10 + c_custkey % 20 as string) as lastlogin,
  'mail-' || cast(c_custkey % 77 as string) as mailaddr, c_mktsegment as memberlevel, '******' as password,
  '130*****' || cast(1000 + c_custkey % 9000 as string) as phone, cast(c_custkey * 31 as string) as qq,
  '2018-0' || cast(1 + c_custkey % 9 as string) || '-01' as register, '2019-01-01' as regupdatetime,
  'unit-' || cast(c_nationkey as string) as unitname, '10.0.0.' || cast(c_custkey % 250 as string) as userip,
  cast(100000 + c_custkey % 800000 as string) as zipcode, '{DT}' as dt,
  {_MEMBER_DN.format(k="c_custkey")} as dn
from {{customer}}"""
VIEWS["registration"] = f"""
select cast(o_custkey as int) as uid, o_orderstatus as appkey, 'http://go-' || cast(o_orderkey % 40 as string) as appregurl,
  'bdp-' || cast(o_orderkey as string) as bdp_uuid, cast(cast(o_orderdate as date) as string) as createtime,
  'domain' as domain, cast(o_orderkey % 2 as string) as isranreg, cast(o_orderkey % 6 as string) as regsource,
  case o_orderkey % 6 when 1 then 'PC' when 2 then 'Mobile' when 3 then 'App' when 4 then 'WeChat' else 'other' end
    as regsourcename,
  cast(o_orderkey % 7 as int) as websiteid, '{DT}' as dt, {_MEMBER_DN.format(k="o_custkey")} as dn
from {{orders}}"""
VIEWS["ad"] = _both_sites("n_nationkey", "adid", 10, "'ad ' || n_name as adname", "nation")
VIEWS["website"] = _both_sites(
    "r_regionkey", "siteid", 3,
    "r_name as sitename, 'http://' || r_name as siteurl, r_regionkey % 2 as site_delete, "
    "'2017-01-0' || cast(r_regionkey + 1 as string) as createtime, 'admin' as creator",
    "region",
)
VIEWS["pay"] = f"""
select cast(o_custkey as int) as uid, cast(cast(o_totalprice as decimal(10,2)) as string) as paymoney,
  cast(o_orderkey % 5 as int) as siteid, cast(o_orderkey % 30 as int) as vip_id,
  replace(cast(cast(o_orderdate as date) as string), '-', '') as dt, {_MEMBER_DN.format(k="o_custkey")} as dn
from {{orders}}"""
VIEWS["vip"] = _both_sites(
    "n_nationkey", "vip_id", 8,
    "'level ' || cast(n_nationkey % 8 as string) as vip_level, "
    "'2018-0' || cast(1 + n_nationkey % 9 as string) || '-01' as start_time, "
    "'2020-0' || cast(1 + n_nationkey % 9 as string) || '-01' as end_time, "
    "'2019-0' || cast(1 + n_nationkey % 9 as string) || '-01' as last_modify_time, "
    "cast(n_nationkey * 10 as string) as max_free, cast(n_nationkey as string) as min_free, "
    "'level ' || cast(n_nationkey % 8 + 1 as string) as next_level, 'op ' || n_name as operator",
    "nation",
)
VIEWS["dws_member"] = f"""
select cast(o_orderkey as int) as uid, cast(o_custkey % 25 as int) as ad_id, o_orderpriority as memberlevel,
  cast(cast(o_orderdate as date) as string) as register, 'http://go_' || cast(o_custkey % 50 as string) as appregurl,
  cast(o_orderkey % 6 as string) as regsource, case o_orderstatus when 'F' then 'PC' when 'O' then 'App' else 'other' end as regsourcename,
  case when o_custkey % 13 = 0 then null else 'ad_' || cast(o_custkey % 25 as string) end as adname,
  cast(o_custkey % 5 as string) as siteid, case when o_custkey % 17 = 0 then null else 'site ' || cast(o_custkey % 5 as string) end as sitename,
  'vip' || cast(o_orderkey % 7 as string) as vip_level, cast(o_totalprice as decimal(10,4)) as paymoney,
  '{DT}' as dt, {_MEMBER_DN.format(k="o_orderkey")} as dn
from {{orders}}"""
VIEWS["paper_detail"] = f"""
select cast(l_orderkey as int) as userid, cast(l_partkey as int) as paperviewid,
  'paper ' || cast(l_partkey as string) as paperviewname, 'chapter ' || cast(l_partkey % 30 as string) as chaptername,
  'point ' || cast(l_linenumber as string) as pointname, 'site course' as sitecoursename,
  'course ' || cast(l_suppkey as string) as coursename, 'major ' || cast(l_suppkey % 9 as string) as majorname,
  'm' as shortname, 'site ' || cast(l_suppkey % 5 as string) as sitename, 'p' || cast(l_partkey as string) as papername,
  cast(cast(l_quantity as decimal(4,1)) * 2 + cast(l_linenumber as decimal(4,1)) / 2 as decimal(4,1)) as score,
  cast(floor(l_extendedprice) as int) as spendtime, cast(l_suppkey as int) as questionid,
  case l_returnflag when 'A' then '0' when 'R' then '1' else null end as user_question_answer,
  '{DT}' as dt, 'webA' as dn
from {{lineitem}}"""
VIEWS["sale_course"] = f"""
select cast(p_partkey as int) as courseid, p_name as coursename, p_brand as status, p_size as pointlistid,
  p_size % 7 as majorid, p_size % 11 as chapterid, 'chapter ' || cast(p_size % 11 as string) as chaptername,
  p_size % 3 as edusubjectid, 'subject ' || cast(p_size % 3 as string) as edusubjectname, p_size % 13 as teacherid,
  'teacher ' || cast(p_size % 13 as string) as teachername, p_type as coursemanager,
  cast(p_retailprice as decimal(10,4)) as money, '{DT}' as dt, case when p_partkey % 5 = 0 then 'webB' else 'webA' end as dn
from {{part}}"""
VIEWS["cart"] = f"""
select cast(l_partkey as int) as courseid, cast(l_orderkey as string) as orderid, 'name' as coursename,
  cast(l_discount as decimal(10,4)) as discount, cast(l_extendedprice as decimal(10,4)) as sellmoney,
  cast(cast(l_shipdate as date) as string) as createtime, '{DT}' as dt, 'webA' as dn
from {{lineitem}}"""
VIEWS["course_pay"] = f"""
select cast(o_orderkey as string) as orderid, cast(o_custkey % 10 as decimal(10,4)) as discount,
  cast(o_totalprice as decimal(10,4)) as paymoney, cast(cast(o_orderdate as date) as string) as createtime, '{DT}' as dt,
  case when o_orderstatus = 'P' then 'webB' else 'webA' end as dn
from {{orders}}"""
VIEWS["page_fields"] = """
select cast(user_id as string) as uid, 'app' as app_id, 'dev-' || cast(user_id % 9 as string) as device_id,
  '10.' || cast(user_id % 256 as string) || '.' || cast(event_id % 256 as string) || '.' || cast(event_id % 250 as string) as ip,
  case when event_id % 23 = 0 then '' else cast(user_id % 4 as string) end as last_page_id,
  case when event_id % 29 = 0 then null else cast((user_id + event_id) % 5 as string) end as page_id,
  cast(event_id % 6 as string) as next_page_id
from {events}"""
VIEWS["ip_ranges"] = """
select cast(167772160 + n_nationkey * 655360 as bigint) as ip_start,
  cast(167772160 + n_nationkey * 655360 + 589823 as bigint) as ip_end,
  'country|0|' || n_name || '|city' || cast(n_nationkey as string) || '|isp' as region
from {nation}"""
VIEWS["nested_ranges"] = """
select cast(167772160 + n_nationkey * 655360 as bigint) as ip_start,
  cast(167772160 + n_nationkey * 655360 + 589823 as bigint) as ip_end, 'country|0|' || n_name as region from {nation}
union all
select cast(167772160 + r_regionkey * 3276800 as bigint), cast(167772160 + r_regionkey * 3276800 + 3276799 as bigint),
  'country|0|' || r_name from {region}
union all
select cast(167772160 + (s_suppkey % 256) * 65536 + s_suppkey % 7 * 1000 as bigint),
  cast(167772160 + (s_suppkey % 256) * 65536 + s_suppkey % 7 * 1000 + s_suppkey % 3 * 40000 as bigint),
  'country|0|' || s_name from {supplier}"""
VIEWS["answer_fields"] = """
select cast(l_suppkey as string) as userid, cast(l_linenumber as string) as courseid,
  cast(l_partkey % 5 as string) as pointid, cast(l_partkey % 10 as string) as questionid,
  case l_returnflag when 'R' then '1' else '0' end as istrue, cast(cast(l_shipdate as date) as string) as createtime
from {lineitem}"""
VIEWS["learn_fields"] = """
select cast(l_suppkey as int) as userid, l_linenumber as cwareid, cast(l_partkey % 3 as int) as videoid,
  cast(l_partkey % 40 as int) as chapterid, cast(l_orderkey % 6 as int) as edutypeid,
  cast(l_suppkey % 12 as int) as subjectid, l_returnflag as sourcetype, 1 as speed,
  cast(1563352128131 + l_orderkey * 1000 + l_linenumber as bigint) as ts,
  cast(1563352128131 + l_orderkey * 1000 + l_linenumber + cast(floor(l_quantity) as bigint) * 730 as bigint) as te,
  cast(l_partkey % 900 as int) as ps,
  cast(l_partkey % 900 + case when l_orderkey % 31 = 0 then 0 else floor(l_quantity) end as int) as pe
from {lineitem}"""


def _bases(sql: str) -> list[str]:
    return sorted({name for _, name, _, _ in Formatter().parse(sql) if name})


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    return spark.sql(sql, **{base: table(spark, sf, base) for base in _bases(sql)})


def ctes(*names: str) -> str:
    """``with`` clause of the named views for the check's SQL."""
    parts = []
    for name in names:
        sql = VIEWS[name]
        parts.append(f"{name} as ({sql.format(**{b: b for b in _bases(sql)})})")
    return "with " + ", ".join(parts) + " "
