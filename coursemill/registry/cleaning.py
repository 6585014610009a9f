"""Cleaning queries: every log spec, the scalar rules and the line sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursemill.functions import columns as c
from coursemill.operators.grouping import word_count
from coursemill.plans import etl
from coursemill.plans.specs import SPECS, Field, LogSpec
from coursemill.plans.warehouse import Warehouse
from coursemill.registry.book import add, query
from coursemill.registry.views import ctes, table, view
from coursemill.session import workspace
from coursemill.sinks.tables import replay_lines
from coursemill.sources.lines import json_fields, read_lines, tsv_fields


def json_lines(rows: DataFrame, with_broken: bool = True) -> DataFrame:
    """Rows as JSON lines; next to each good line stands a broken one that a reader must drop."""
    text = F.to_json(F.struct(*rows.columns))
    good = rows.select(text.alias("value"))
    if not with_broken:
        return good
    kind = F.pmod(F.xxhash64("value"), F.lit(9))
    broken = (
        F.when(kind == 0, F.expr("left(value, length(value) - 1)"))
        .when(kind == 1, F.concat(F.lit("["), "value", F.lit("]")))
        .when(kind == 2, F.lit("null"))
        .when(kind == 3, F.lit(""))
        .when(kind == 4, F.concat("value", F.lit(" xyz")))
        .when(kind == 5, F.concat("value", F.lit("]")))
        .when(kind == 6, F.concat("value", "value"))
        .when(kind == 7, F.concat("value", F.lit(',"more":{"a":1}')))
        .otherwise(F.concat(F.lit("bad "), "value"))
    )
    return good.select(F.explode(F.array("value", broken)).alias("value"))


def _text_times(df: DataFrame, spec: LogSpec) -> DataFrame:
    for f in spec.fields:
        if f.kind == "@":
            df = df.withColumn(f.name, F.col(f.name).cast("string"))
    return df


def _clean_query(spec: LogSpec):
    def run(spark, sf):
        return _text_times(etl.clean(json_lines(view(spark, sf, f"log_{spec.table}")), spec), spec)

    return run


def _bucketed_query(spec: LogSpec):
    def run(spark, sf):
        root = workspace(spark, "bucketed")
        house = Warehouse(root, catalog_prefix=root.rsplit("-", 1)[1].join(("t", "_")))
        replay_lines(json_lines(view(spark, sf, f"log_{spec.table}")), "files", f"{root}/ods/{spec.log}.log")
        etl.load(spark, house, spec, f"{root}/ods")
        stored = house.read_bucketed(spark, f"dwd.{spec.table}")
        return _text_times(stored.select(*[f.name for f in spec.fields]), spec)

    return run


def _check_field(f: Field) -> str:
    if f.rule == "source_label":
        return (
            f"case {f.key} when '1' then 'PC' when '2' then 'Mobile' when '3' then 'App' when '4' then 'WeChat' "
            f"else 'other' end as {f.name}"
        )
    if f.rule == "mask_name":
        return f"left({f.key}, 1) || 'xx' as {f.name}"
    if f.rule == "mask_phone":
        return f"left({f.key}, 3) || '*****' || substr({f.key}, 8, 4) as {f.name}"
    if f.rule == "redact":
        return f"'******' as {f.name}"
    if f.kind == "*":
        return f"coalesce(cast(trunc(try_cast({f.key} as decimal(38,10))) as int), 0) as {f.name}"
    if f.kind == "?":
        return f"case when {f.key} not like '%.%' then try_cast({f.key} as int) end as {f.name}"
    if f.kind == "^":
        return f"coalesce(try_cast({f.key} as decimal(10,1)), 0.0) as {f.name}"
    if f.kind == "$":
        return f"try_cast({f.key} as decimal(10,4)) as {f.name}"
    if f.kind == "@":
        return f"cast(try_cast({f.key} as timestamp) as string) as {f.name}"
    return f"{f.key} as {f.name}"


for _spec in SPECS.values():
    _view = f"log_{_spec.table}"
    _sql = ctes(_view) + "select " + ", ".join(_check_field(f) for f in _spec.fields) + f" from {_view}"
    _run = _bucketed_query(_spec) if _spec.mode == "bucketed" else _clean_query(_spec)
    add(f"etl_{_spec.table.removeprefix('dwd_')}", _run, _sql)


@query(
    "etl_load_member",
    ctes("log_dwd_member")
    + "select "
    + ", ".join(_check_field(f) for f in SPECS["dwd_member"].fields)
    + " from log_dwd_member",
)
def etl_load_member(spark, sf):
    """Log file to partitioned table and back."""
    spec, root = SPECS["dwd_member"], workspace(spark, "load")
    replay_lines(json_lines(view(spark, sf, "log_dwd_member")), "files", f"{root}/ods/{spec.log}.log")
    house = Warehouse(f"{root}/tables")
    etl.load(spark, house, spec, f"{root}/ods")
    return house.read(spark, f"dwd.{spec.table}", schema=spec.schema).select(*[f.name for f in spec.fields])


@query(
    "etl_json_events",
    """select event_id, event_type, coalesce(try_cast(props->>'$.k' as int), 0) as k,
       coalesce(try_cast(props->>'$.missing' as int), 0) as missing from events""",
)
def etl_json_events(spark, sf):
    lines = table(spark, sf, "events").select("event_id", "event_type", F.col("props").alias("value"))
    fields = json_fields(lines, ["k", "missing"], ["event_id", "event_type"])
    return fields.select(
        "event_id", "event_type", c.int_or_zero("k").alias("k"), c.int_or_zero("missing").alias("missing")
    )


@query(
    "mask_customer",
    """select c_custkey, left(c_name, 1) || 'xx' as fullname,
       left(cast(13000000000 + c_custkey * 7919 as string), 3) || '*****'
         || substr(cast(13000000000 + c_custkey * 7919 as string), 8, 4) as phone,
       '******' as password from customer""",
)
def mask_customer(spark, sf):
    phone = (F.lit(13000000000) + F.col("c_custkey") * 7919).cast("string")
    return table(spark, sf, "customer").select(
        "c_custkey",
        c.mask_name("c_name").alias("fullname"),
        c.mask_phone(phone).alias("phone"),
        F.lit(c.REDACTED).alias("password"),
    )


@query(
    "label_codes",
    """select o_orderkey,
       case left(o_orderpriority, 1) when '1' then 'PC' when '2' then 'Mobile' when '3' then 'App'
         when '4' then 'WeChat' else 'other' end as regsourcename,
       case left(o_orderpriority, 1) when '1' then 'PC' when '2' then 'APP' else 'Other' end as app_name
       from orders""",
)
def label_codes(spark, sf):
    code = F.substring("o_orderpriority", 1, 1)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        c.label(code, c.REGISTER_SOURCES, c.REGISTER_SOURCE_OTHER).alias("regsourcename"),
        c.label(code, c.APP_PLATFORMS, c.APP_PLATFORM_OTHER).alias("app_name"),
    )


@query(
    "round_half_up",
    """select l_orderkey, l_linenumber, cast(
         cast((cast(cast(l_extendedprice as decimal(12,2)) * 100 as bigint) + 5) // 10 as double) / 10
       as decimal(10,1)) as price from lineitem""",
)
def round_half_up(spark, sf):
    text = F.col("l_extendedprice").cast("decimal(12,2)").cast("string")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", c.score_1dp(text).alias("price"))


@query(
    "clean_string",
    """select doc_id, regexp_replace(regexp_replace(cast(doc_id as string) || text, '^[0-9]+', ''), '[.]+', '', 'g')
       as cleaned from documents""",
)
def clean_string(spark, sf):
    text = F.concat(F.col("doc_id").cast("string"), "text")
    return table(spark, sf, "documents").select("doc_id", c.clean_text(text).alias("cleaned"))


@query(
    "word_count",
    """select word, count(*) as n from (
         select unnest(string_split(regexp_replace(text, ' +$', ''), ' ')) as word from documents
         where not regexp_full_match(text, ' +')
       ) group by word""",
)
def words(spark, sf):
    return word_count(table(spark, sf, "documents"), "text")


@query(
    "redate_orders",
    """select o_orderkey, cast(cast(o_orderdate as date) as string) as day from orders""",
)
def redate_orders(spark, sf):
    compact = F.regexp_replace(F.col("o_orderdate").cast("date").cast("string"), "-", "")
    return table(spark, sf, "orders").select("o_orderkey", c.dashed_date(compact).alias("day"))


@query(
    "tsv_arity",
    """select cast(user_id as string) as uid, cast(event_id as string) as code, event_type as third
       from events where event_type not in ('error', 'view')""",
)
def tsv_arity(spark, sf):
    return tsv_fields(register_lines(spark, sf, code=F.col("event_id").cast("string")), ["uid", "code", "third"])


def register_lines(spark, sf, code=None):
    """Events as sign-up lines: errors lack a field, views have one too many, clicks end in empty fields."""
    code = code if code is not None else F.expr(
        "case event_type when 'signup' then '1' when 'purchase' then '2' else '3' end"
    )
    kind = F.col("event_type")
    uid = F.col("user_id").cast("string")
    tail = F.when(kind == "view", "view\tmore").when(kind == "click", "click\t\t").otherwise(kind)
    value = F.when(kind == "error", F.concat_ws("\t", uid, code)).otherwise(F.concat_ws("\t", uid, code, tail))
    return table(spark, sf, "events").select("ts", value.alias("value"))


@query(
    "replay_roundtrip",
    """select cast(user_id as string) || chr(9) || cast(event_id as string) || case event_type when 'error' then ''
         when 'view' then chr(9) || 'view' || chr(9) || 'more' when 'click' then chr(9) || 'click' || chr(9) || chr(9)
         else chr(9) || event_type end as value from events""",
)
def replay_roundtrip(spark, sf):
    target = workspace(spark, "replay")
    replay_lines(register_lines(spark, sf, code=F.col("event_id").cast("string")), "files", target)
    return read_lines(spark, target)
