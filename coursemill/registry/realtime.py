"""Real-time jobs: each job as a batch query, and as a stream over the same lines worked off to the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from coursemill.operators.intervals import interval_sets, islands, uncovered_pieces
from coursemill.operators.joins import add_full_outer
from coursemill.registry.book import add, query
from coursemill.registry.cleaning import json_lines, register_lines
from coursemill.registry.views import ctes, table, view
from coursemill.session import workspace
from coursemill.sinks.tables import (
    additive_totals,
    data_files,
    fold_changes,
    latest_rows,
    publish_changes,
    publish_snapshot,
    read_snapshot,
    replace_table,
    replay_lines,
    write_files,
)
from coursemill.sources.streams import line_stream
from coursemill.streaming import answers, archive, learning, pages, register
from coursemill.streaming.runner import start


def _log_stream(spark, log, batches=1):
    """Stream of a written log folder in ``batches`` micro-batches, however many files it has."""
    return line_stream(spark, "files", log, per_trigger=-(-data_files(spark, log) // batches))


def _streamed(spark, name, lines, transform, publish, mode, batches=3):
    """Write ``lines`` as a log folder, stream it in several micro-batches, publish below a fresh folder."""
    root = workspace(spark, name)
    replay_lines(lines, "files", f"{root}/log")
    stream = transform(_log_stream(spark, f"{root}/log", batches))
    start(stream, publish(f"{root}/out"), checkpoint=f"{root}/checkpoint", mode=mode).awaitTermination()
    return f"{root}/out"


# ---------------------------------------------------------------- sign-ups

_APP = "case event_type when 'signup' then 'PC' when 'purchase' then 'APP' else 'Other' end"
_VALID = "event_type not in ('error', 'view')"
_RUNNING_SQL = f"select {_APP} as app_name, count(*) as num from events where {_VALID} group by 1"


@query("running_counts", _RUNNING_SQL)
def running_counts(spark, sf):
    return register.running_counts(register.register_events(register_lines(spark, sf)))


@query("stream_running_counts", _RUNNING_SQL)
def stream_running_counts(spark, sf):
    out = _streamed(
        spark, "register", register_lines(spark, sf),
        lambda s: register.running_counts(register.register_events(s)),
        lambda root: lambda rows, batch: publish_changes(rows, root, batch), "update",
    )
    return latest_rows(spark, out, ["app_name"])


_SLIDING_SQL = f"""
  select strftime(s, '%Y-%m-%d %H:%M:%S') as window_start, strftime(s + interval 60 second, '%Y-%m-%d %H:%M:%S') as window_end,
    app_name, count(*) as num
  from (select {_APP} as app_name, make_timestamp(((epoch_ms(ts) // 6000) * 6 - 6 * b) * 1000000) as s
        from events, (select unnest(generate_series(0, 9)) as b) where {_VALID})
  group by s, app_name"""


def _window_text(df):
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("window_start", "window_end")})


def _timed_sign_ups(spark, sf):
    return register.register_events(register_lines(spark, sf), ("ts",))


@query("sliding_window", _SLIDING_SQL)
def sliding_window(spark, sf):
    return _window_text(register.sliding_counts_paned(_timed_sign_ups(spark, sf), "ts"))


@query("sliding_window_direct", _SLIDING_SQL)
def sliding_window_direct(spark, sf):
    return _window_text(register.sliding_counts(_timed_sign_ups(spark, sf), "ts"))


@query("stream_sliding_window", _SLIDING_SQL)
def stream_sliding_window(spark, sf):
    """Windows by event time over a stream of timed lines; each micro-batch records the windows it changed."""
    root = workspace(spark, "sliding")
    lines = register_lines(spark, sf).repartition(6)
    lines.write.parquet(f"{root}/log")
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 3).parquet(f"{root}/log")
    counts = register.sliding_counts(register.register_events(stream, ("ts",)), "ts")
    publish = lambda rows, batch: publish_changes(rows, f"{root}/out", batch)
    start(counts, publish, checkpoint=f"{root}/checkpoint").awaitTermination()
    return _window_text(latest_rows(spark, f"{root}/out", ["window_start", "window_end", "app_name"]))


# ---------------------------------------------------------------- pages

_PAGES = ctes("page_fields") + """, p as (select * from page_fields
  where coalesce(last_page_id, '') <> '' and coalesce(page_id, '') <> '' and coalesce(next_page_id, '') <> '')"""


def page_lines(spark, sf):
    return json_lines(view(spark, sf, "page_fields"))


def _page_events(spark, sf):
    return pages.page_events(page_lines(spark, sf))


_JUMPS_SQL = _PAGES + "select last_page_id, page_id, next_page_id, count(*) as num from p group by all"
_RATES_SQL = _PAGES + """, n as (select
    count(*) filter (page_id = '1') as n1, count(*) filter (page_id = '2') as n2, count(*) filter (page_id = '3') as n3 from p)
  select 1 as page_id, n1 as num, '100%' as jump_rate from n
  union all select 2, n2, case when n1 = 0 then '0%' else cast(cast(round_even(n2 / n1 * 100, 0) as bigint) as string) || '%' end from n
  union all select 3, n3, case when n2 = 0 then '0%' else cast(cast(round_even(n3 / n2 * 100, 0) as bigint) as string) || '%' end from n"""


@query("page_jumps", _JUMPS_SQL)
def page_jumps(spark, sf):
    return pages.page_jumps(_page_events(spark, sf))


@query("funnel_rates", _RATES_SQL)
def funnel_rates(spark, sf):
    return pages.funnel_rates(pages.page_totals(pages.page_jumps(_page_events(spark, sf))))


def _page_stream(spark, sf):
    return _streamed(
        spark, "pages", page_lines(spark, sf), lambda s: pages.page_jumps(pages.page_events(s)),
        pages.publish_jumps, "update",
    )


@query("stream_page_jumps", _JUMPS_SQL)
def stream_page_jumps(spark, sf):
    return pages.published_jumps(spark, _page_stream(spark, sf))


@query(
    "stream_page_rates",
    _RATES_SQL.replace("select 1 as page_id", ", r as (select 1 as page_id", 1)
    + """) select t.page_id, t.num, r.jump_rate from (select page_id, count(*) as num from p group by page_id) t
      left join r on t.page_id = cast(r.page_id as string)""",
)
def stream_page_rates(spark, sf):
    return pages.published_pages(spark, _page_stream(spark, sf))


_LOOKUP = _PAGES + ctes("ip_ranges").replace("with ", ", ", 1) + """, q as (select p.ip, coalesce(split_part(r.region, '|', 3), '0') as province from
  (select *, cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536
     + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint) as n from p) p
  left join ip_ranges r on p.n between r.ip_start and r.ip_end)"""
_CLICKS_SQL = _LOOKUP + "select province, count(*) as num from q group by province"
_TOP_SQL = _CLICKS_SQL + " order by num desc, province limit 3"


@query("range_lookup", _LOOKUP + "select ip, province from q")
def range_lookup(spark, sf):
    return pages.province_of_ip(_page_events(spark, sf), view(spark, sf, "ip_ranges")).select("ip", "province")


_NESTED_LOOKUP = _PAGES + ctes("nested_ranges").replace("with ", ", ", 1) + """, n as (select distinct ip,
    cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536
     + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint) as n from p),
  f as (select n.ip, split_part(r.region, '|', 3) as province,
    row_number() over (partition by n.ip order by r.ip_start desc, r.ip_end, r.region) as place
    from n join nested_ranges r on n.n between r.ip_start and r.ip_end)
select p.ip, coalesce(f.province, '0') as province from p left join f on p.ip = f.ip and f.place = 1"""


@query("range_lookup_nested", _NESTED_LOOKUP)
def range_lookup_nested(spark, sf):
    """Networks of suppliers inside those of nations inside those of regions: one province per click, the innermost."""
    return pages.province_of_ip(_page_events(spark, sf), view(spark, sf, "nested_ranges"), nested=True).select("ip", "province")


@query("province_clicks", _CLICKS_SQL)
def province_clicks(spark, sf):
    return pages.province_clicks(_page_events(spark, sf), view(spark, sf, "ip_ranges"))


@query("province_top3", _TOP_SQL)
def province_top3(spark, sf):
    return pages.top_provinces(province_clicks(spark, sf))


@query("stream_province_top3", _TOP_SQL)
def stream_province_top3(spark, sf):
    ranges = view(spark, sf, "ip_ranges")
    out = _streamed(
        spark, "provinces", page_lines(spark, sf),
        lambda s: pages.page_events(s).select("ip"), lambda root: pages.publish_clicks(root, ranges), "append",
    )
    return pages.top_provinces(pages.published_clicks(spark, out))


@query("full_outer_merge", "select event_type, user_id, count(*) as num from events group by event_type, user_id")
def full_outer_merge(spark, sf):
    """Totals of the negative and of the other values, merged per key."""
    events, keys = table(spark, sf, "events"), ["event_type", "user_id"]
    low = F.coalesce(F.col("value") < 20, F.lit(False))
    history = events.where(low).groupBy(*keys).agg(F.count(F.lit(1)).alias("num"))
    batch = events.where(~low).groupBy(*keys).agg(F.count(F.lit(1)).alias("num"))
    return add_full_outer(history, batch, keys, "num")


# ---------------------------------------------------------------- answers

_MASTERY_SQL = ctes("answer_fields") + """
  select userid, courseid, pointid, qz_sum, qz_count, qz_istrue, createtime, cast(qz_istrue as double) / qz_sum as correct_rate,
    qz_count / 10.0::double * (cast(qz_istrue as double) / qz_sum) as mastery_rate,
    cast(cast((200 * qz_istrue + qz_sum) // (2 * qz_sum) as double) / 100 as decimal(4,2)) as correct_percent
  from (select userid, courseid, pointid, count(*) as qz_sum, count(distinct questionid) as qz_count,
          count(*) filter (istrue = '1') as qz_istrue, min(createtime) as createtime
        from answer_fields group by userid, courseid, pointid)"""


def answer_lines(spark, sf):
    rows = view(spark, sf, "answer_fields")
    good = F.concat_ws("\t", *[F.col(c) for c in answers.ANSWER_FIELDS])
    short = F.concat_ws("\t", "userid", "courseid", "pointid")
    long = F.concat_ws("\t", good, F.lit("more"))
    open_end = F.concat_ws("\t", "userid", "courseid", "pointid", "questionid", "istrue", F.lit(""))
    return rows.select(F.explode(F.array(good, short, long, open_end)).alias("value"))


@query("mastery", _MASTERY_SQL)
def mastery(spark, sf):
    return answers.mastery(answers.question_totals(answers.answer_events(answer_lines(spark, sf))))


def _streamed_points(spark, sf):
    return _streamed(
        spark, "answers", answer_lines(spark, sf),
        lambda s: answers.point_totals(answers.answer_events(s)), answers.publish_points, "update",
    )


@query("stream_mastery", _MASTERY_SQL)
def stream_mastery(spark, sf):
    return answers.published_points(spark, _streamed_points(spark, sf)).drop("updatetime")


_HISTORY_SQL = ctes("answer_fields") + """
  select userid, courseid, pointid, cast(0 as bigint) as part, string_agg(distinct questionid, ',' order by questionid) as questionids,
    min(createtime) as createtime from answer_fields group by userid, courseid, pointid"""


@query("stream_question_history", _HISTORY_SQL)
def stream_question_history(spark, sf):
    """The question lists as the answer job publishes them."""
    return answers.published_history(spark, _streamed_points(spark, sf))


@query("question_history", _HISTORY_SQL)
def question_history(spark, sf):
    return answers.question_history(answers.question_totals(answers.answer_events(answer_lines(spark, sf))))


@query(
    "question_history_parts",
    ctes("answer_fields")
    + """, q as (select distinct userid, courseid, pointid, questionid from answer_fields),
      r as (select *, (row_number() over w - 1) * 2 // count(questionid) over (partition by userid, courseid, pointid) as part
        from q window w as (partition by userid, courseid, pointid order by questionid nulls last)),
      f as (select userid, courseid, pointid, min(createtime) as createtime from answer_fields group by userid, courseid, pointid)
      select userid, courseid, pointid, cast(case when questionid is null then 0 else part end as bigint) as part,
        coalesce(string_agg(questionid, ',' order by questionid), '') as questionids, any_value(f.createtime) as createtime
      from r join f using (userid, courseid, pointid) group by 1, 2, 3, 4""",
)
def question_history_parts(spark, sf):
    """The same in two ordered slices per point."""
    return answers.question_history(answers.question_totals(answers.answer_events(answer_lines(spark, sf))), parts=2)


@query("fold_additive", "select l_partkey, l_suppkey, count(*) as num from lineitem group by l_partkey, l_suppkey")
def fold_additive(spark, sf):
    """Additive upsert with a fold between the batches and one after a batch that came later than the fold's listing."""
    root, keys = workspace(spark, "fold"), ["l_partkey", "l_suppkey"]
    lines = table(spark, sf, "lineitem")
    amount = lambda b: lines.where(F.col("l_linenumber") % 3 == b).groupBy(*keys).agg(F.count(F.lit(1)).alias("num"))
    publish_changes(amount(0), root, 0)
    fold_changes(spark, root, keys, additive=True)
    publish_changes(amount(1), root, 1)
    totals = additive_totals(spark, root, keys, 1)
    publish_changes(amount(2), root, 2)  # lands while batches up to 1 are folded
    publish_snapshot(totals, f"{root}/base", "1")
    return additive_totals(spark, root, keys)


# ---------------------------------------------------------------- watch time

_SECS = "cast((te - ts) // 1000 as bigint)"
_LEARN = ctes("learn_fields")
_DIM_SQL = _LEARN + " union all ".join(
    f"""select '{d}' as dim, cast({d.lower()} as string) as key, cast(sum({_SECS}) as bigint) as totaltime
        from learn_fields group by {d.lower()}"""
    for d in learning.DIMENSIONS
)


def learn_lines(spark, sf):
    rows = view(spark, sf, "learn_fields")
    return json_lines(rows.withColumnRenamed("userid", "uid").withColumnRenamed("sourcetype", "sourceType"))


def _learn_events(spark, sf):
    return learning.learn_events(learn_lines(spark, sf))


@query("learn_by_dim", _DIM_SQL)
def learn_by_dim(spark, sf):
    return learning.seconds_by_dimension(_learn_events(spark, sf))


@query("stream_learn_by_dim", _DIM_SQL)
def stream_learn_by_dim(spark, sf):
    out = _streamed(
        spark, "learn", learn_lines(spark, sf),
        lambda s: learning.seconds_by_dimension(learning.learn_events(s)),
        lambda root: lambda rows, batch: publish_changes(rows, root, batch), "update",
    )
    return latest_rows(spark, out, ["dim", "key"])


_ISLANDS = _LEARN + """,
  m as (select userid, cwareid, videoid, ps, pe, max(pe) over (partition by userid, cwareid, videoid order by ps, pe
          rows between unbounded preceding and 1 preceding) as far from learn_fields where ps <= pe),
  n as (select *, sum(case when far < ps then 1 else 0 end) over (partition by userid, cwareid, videoid order by ps, pe
          rows unbounded preceding) as island from m),
  i as (select userid, cwareid, videoid, island, min(ps) as ps, max(pe) as pe from n group by all)"""


def _viewings(spark, sf):
    return view(spark, sf, "learn_fields").withColumnRenamed("sourcetype", "sourceType")


@query("interval_islands", _ISLANDS + "select userid, cwareid, videoid, ps, pe from i")
def interval_islands(spark, sf):
    return islands(_viewings(spark, sf), learning.VIDEO_KEYS)


@query(
    "play_intervals",
    _ISLANDS
    + """select userid, cwareid, videoid, string_agg(ps || '-' || pe, ',' order by ps) as play_interval
      from i group by userid, cwareid, videoid""",
)
def play_intervals(spark, sf):
    return learning.play_intervals(_viewings(spark, sf))


@query(
    "uncovered_seconds",
    _LEARN
    + """, s as (select distinct userid, cwareid, videoid, sourcetype = 'N' as old, unnest(generate_series(ps, pe - 1)) as sec
        from learn_fields),
      h as (select userid, cwareid, videoid, sec from s where old),
      k as (select distinct userid, cwareid, videoid from learn_fields where sourcetype <> 'N')
      select k.userid, k.cwareid, k.videoid, count(x.sec) as new_seconds from k
      left join (select userid, cwareid, videoid, sec from s where not old except select * from h) x
        on k.userid = x.userid and k.cwareid = x.cwareid and k.videoid = x.videoid
      group by k.userid, k.cwareid, k.videoid""",
)
def uncovered_seconds(spark, sf):
    """Seconds that one part of the viewings adds to what the other part had covered."""
    rows, keys = _viewings(spark, sf), learning.VIDEO_KEYS
    history = interval_sets(islands(rows.where(F.col("sourceType") == "N"), keys), keys)
    pairs = rows.where(F.col("sourceType") != "N").select(*keys, "ps", "pe").distinct()
    pieces = uncovered_pieces(pairs, keys, history)
    return pieces.groupBy(*keys).agg(F.sum("new_seconds").alias("new_seconds"))


_WATCH_SQL = _LEARN + f""",
  r as (select *, {_SECS} as secs, greatest(ps, max(pe) over w) as lo, row_number() over v as n from learn_fields
        window w as (partition by userid, cwareid, videoid order by ps, pe, ts, te rows between unbounded preceding and 1 preceding),
          v as (partition by userid, cwareid, videoid order by ps, pe, ts, te)),
  x as (select *, greatest(0, pe - coalesce(lo, ps)) as new from r)
  select userid, cwareid, videoid, cast(sum(secs) as bigint) as totaltime,
    cast(sum(case when n = 1 then secs else coalesce(secs * new // nullif(pe - ps, 0), 0) end) as bigint) as effecttime,
    cast(sum(new) as bigint) as completetime
  from x group by userid, cwareid, videoid"""


@query("watch_time", _WATCH_SQL)
def watch_time(spark, sf):
    return learning.watch_time(_viewings(spark, sf))


@query("stream_watch_time", _WATCH_SQL)
def stream_watch_time(spark, sf):
    """The stateful form; all rows of a video arrive in one micro-batch, where it must equal the batch form."""
    out = _streamed(
        spark, "watch", learn_lines(spark, sf), lambda s: learning.watch_time_stream(learning.learn_events(s)),
        learning.publish_videos, "update", batches=1,
    )
    return latest_rows(spark, out, learning.VIDEO_KEYS).drop("play_interval")


_BATCHES_SQL = _ISLANDS + f""",
  v as (select *, edutypeid % 3 as b, {_SECS} as secs from learn_fields),
  r as (select *, row_number() over w as n, min(b) over (partition by userid, cwareid, videoid) as b0,
          greatest(ps, coalesce(max(pe) over (w rows between unbounded preceding and 1 preceding), ps)) as lo
        from v window w as (partition by userid, cwareid, videoid, b order by ps, pe, ts, te)),
  s as (select userid, cwareid, videoid, sec, min(b) as first_b
        from (select userid, cwareid, videoid, b, unnest(generate_series(ps, pe - 1)) as sec from v) group by all),
  g as (select *, row_number() over () as id from r),
  c as (select g.id, count(*) as new from (select id, userid, cwareid, videoid, b, unnest(generate_series(lo, pe - 1)) as sec from g) g
        join s on s.userid = g.userid and s.cwareid = g.cwareid and s.videoid = g.videoid and s.sec = g.sec and s.first_b = g.b
        group by g.id),
  x as (select g.*, coalesce(c.new, 0) as new from g left join c on c.id = g.id),
  t as (select userid, cwareid, videoid, string_agg(ps || '-' || pe, ',' order by ps) as play_interval
        from i group by userid, cwareid, videoid)
  select x.userid, x.cwareid, x.videoid, any_value(t.play_interval) as play_interval, cast(sum(secs) as bigint) as totaltime,
    cast(sum(case when n = 1 and b = b0 then secs else coalesce(secs * new // nullif(pe - ps, 0), 0) end) as bigint) as effecttime,
    cast(sum(new) as bigint) as completetime
  from x join t on t.userid = x.userid and t.cwareid = x.cwareid and t.videoid = x.videoid group by all"""


@query("stream_watch_time_batches", _BATCHES_SQL)
def stream_watch_time_batches(spark, sf):
    """Three micro-batches whose viewings overlap, each worked off by a query that starts from the checkpoint of the one
    before it, so the order is fixed and the state of a video is read back."""
    root, rows = workspace(spark, "watch"), view(spark, sf, "learn_fields")
    for batch in range(3):
        part = rows.where(F.col("edutypeid") % 3 == batch)
        part = part.withColumnRenamed("userid", "uid").withColumnRenamed("sourcetype", "sourceType")
        replay_lines(json_lines(part), "files", f"{root}/log")
        lines = _log_stream(spark, f"{root}/log")
        videos = learning.watch_time_stream(learning.learn_events(lines))
        start(videos, learning.publish_videos(f"{root}/out"), checkpoint=f"{root}/checkpoint").awaitTermination()
    return latest_rows(spark, f"{root}/out", learning.VIDEO_KEYS)


# ---------------------------------------------------------------- sinks

_PARTS = "strftime(ts, '%Y%m%d')"


@query(
    "archive_roundtrip",
    f"select props as value, 'page_topic' as topic, cast({_PARTS} as int) as dt from events",
)
def archive_roundtrip(spark, sf):
    events = table(spark, sf, "events")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    lines = events.select(F.col("props").alias("value"), millis.alias("at"))
    base = workspace(spark, "archive")
    archive.write_archive(archive.archive_rows(lines, "page_topic", "at"), base)
    return spark.read.text(base)


@query("stream_archive", "select props as value, 'page_topic' as topic from events")
def stream_archive(spark, sf):
    root = workspace(spark, "archive_stream")
    replay_lines(table(spark, sf, "events").select(F.col("props").alias("value")), "files", f"{root}/log")
    lines = _log_stream(spark, f"{root}/log", batches=3)
    rows = archive.archive_rows(lines, "page_topic")
    archive.start_archive(rows, f"{root}/base", f"{root}/checkpoint").awaitTermination()
    return spark.read.text(f"{root}/base").select("value", "topic")


_HALVES = "case when l_linenumber <= 3 then 0 else 1 end"


@query(
    "upsert_snapshot",
    f"""select l_partkey, l_suppkey, num from (
        select l_partkey, l_suppkey, {_HALVES} as b, count(*) as num,
          row_number() over (partition by l_partkey, l_suppkey order by {_HALVES} desc) as n
        from lineitem group by l_partkey, l_suppkey, {_HALVES}) where n = 1""",
)
def upsert_snapshot(spark, sf):
    """Replace upsert: of two batches the later value of a key wins."""
    root = workspace(spark, "upsert")
    _two_batches(spark, sf, root)
    return latest_rows(spark, root, ["l_partkey", "l_suppkey"])


@query("upsert_additive", "select l_partkey, l_suppkey, count(*) as num from lineitem group by l_partkey, l_suppkey")
def upsert_additive(spark, sf):
    """Additive upsert; the second batch is delivered twice and still counts once."""
    root = workspace(spark, "additive")
    _two_batches(spark, sf, root, repeat=True)
    return additive_totals(spark, root, ["l_partkey", "l_suppkey"])


def _two_batches(spark, sf, root, repeat=False):
    lines = table(spark, sf, "lineitem").withColumn("b", F.when(F.col("l_linenumber") <= 3, 0).otherwise(1))
    for batch in (0, 1, 1) if repeat else (0, 1):
        part = lines.where(F.col("b") == batch).groupBy("l_partkey", "l_suppkey").agg(F.count(F.lit(1)).alias("num"))
        publish_changes(part, root, batch)


@query(
    "overwrite_partitions",
    """select o_orderkey, o_totalprice + case when o_orderstatus = 'F' then 1 else 0 end as o_totalprice, o_orderstatus
       from orders""",
)
def overwrite_partitions(spark, sf):
    """All statuses are written, then one is replaced: the others stay."""
    root = workspace(spark, "overwrite")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    write_files(orders, root, partition_by=["o_orderstatus"], codec="snappy")
    changed = orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    write_files(changed, root, partition_by=["o_orderstatus"], overwrite=True, compact=True)
    return spark.read.parquet(root)


@query(
    "replace_small_table",
    "select o_orderstatus, count(*) as num from orders group by o_orderstatus",
)
def replace_small_table(spark, sf):
    root, orders = workspace(spark, "replace"), table(spark, sf, "orders")
    replace_table(orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("num")), root)
    replace_table(orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("num")), root)
    return read_snapshot(spark, root)


@query(
    "table_scan",
    "select l_orderkey, l_linenumber, l_quantity as score, l_returnflag as dt from lineitem where l_returnflag = 'R'",
)
def table_scan(spark, sf):
    """One partition of a stored table with a renamed column subset; the other partitions are not opened."""
    root = workspace(spark, "scan")
    write_files(table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "dt"), root, partition_by=["dt"])
    stored = spark.read.parquet(root).where(F.col("dt") == "R")
    return stored.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("score"), "dt")
