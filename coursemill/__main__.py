"""Run a job: ``python -m coursemill <job> --help``, or the same file through ``spark-submit``."""

from __future__ import annotations

import argparse

from coursemill.plans import jobs
from coursemill.plans.specs import ORDER_BUCKETS
from coursemill.plans.warehouse import Warehouse
from coursemill.session import build_session
from coursemill.sinks.tables import replay_lines
from coursemill.sources.lines import read_lines
from coursemill.sources.streams import line_stream
from coursemill.streaming import jobs as streams

LOADS = {
    "member-load": jobs.MEMBER_TABLES,
    "qz-load": jobs.QZ_TABLES,
    "sell-load": jobs.SELL_TABLES,
    "sell-load-bucketed": jobs.SELL_BUCKETED_TABLES,
}
DAYS = {
    "member-wide": jobs.member_wide,
    "member-reports": jobs.member_reports,
    "qz-wide": jobs.qz_wide,
    "qz-reports": jobs.qz_reports,
}
# Topic of each real-time job.
TOPICS = {
    "register": "register_topic",
    "page": "page_topic",
    "answer": "qz_log",
    "learn": "course_learn",
    "archive": "page_topic",
}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="coursemill", description=__doc__)
    jobs_ = parser.add_subparsers(dest="job", required=True)
    for name in (*LOADS, *DAYS, "sell-detail"):
        p = jobs_.add_parser(name)
        p.add_argument("--warehouse", required=True)
        if name in LOADS:
            p.add_argument("--ods", required=True, help="folder of the <log>.log files")
            if name == "sell-load-bucketed":
                p.add_argument("--buckets", type=int, default=ORDER_BUCKETS, help="of new tables, and tasks of their join")
        else:
            p.add_argument("--dt", required=True, help="day as yyyyMMdd")
        if name == "sell-detail":
            p.add_argument("--form", default="join", choices=["join", "salted", "broadcast", "bucketed"])
    for name in TOPICS:
        p = jobs_.add_parser(f"stream-{name}")
        p.add_argument("--kind", default="kafka", choices=["kafka", "files"])
        p.add_argument("--source", default=TOPICS[name], help="topic, or folder of text files")
        p.add_argument("--servers")
        p.add_argument("--per-trigger", type=int)
        p.add_argument("--out", required=True)
        p.add_argument("--once", action="store_true", help="work off what is there and stop")
        if name == "page":
            p.add_argument("--ranges", required=True, help="Parquet of ip_start, ip_end, region")
    p = jobs_.add_parser("fold", help="fold the recorded batches of a real-time job; run it every hour or so")
    p.add_argument("--results", required=True, choices=list(streams.RESULTS))
    p.add_argument("--out", required=True, help="output folder of the job")
    p = jobs_.add_parser("replay")
    p.add_argument("--log", required=True)
    p.add_argument("--kind", default="kafka", choices=["kafka", "files"])
    p.add_argument("--target", required=True)
    p.add_argument("--servers")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(app=f"coursemill-{args.job}")
    if args.job == "replay":
        replay_lines(read_lines(spark, args.log), args.kind, args.target, servers=args.servers)
    elif args.job == "fold":
        streams.fold_job(spark, args.results, args.out)
    elif args.job.startswith("stream-"):
        for query in _stream(spark, args):
            query.awaitTermination()
    else:
        house = Warehouse(args.warehouse, buckets=getattr(args, "buckets", ORDER_BUCKETS))
        if args.job in LOADS:
            jobs.load_tables(spark, house, args.ods, LOADS[args.job])
        elif args.job in DAYS:
            DAYS[args.job](spark, house, args.dt)
        else:
            jobs.sell_detail(spark, house, args.dt, args.form)


def _stream(spark, args):
    name = args.job.removeprefix("stream-")
    lines = line_stream(spark, args.kind, args.source, servers=args.servers, per_trigger=args.per_trigger)
    if name == "register":
        return streams.register_job(lines, args.out, args.once)
    if name == "page":
        return streams.page_job(lines, spark.read.parquet(args.ranges), args.out, args.once)
    if name == "answer":
        return streams.answer_job(lines, args.out, args.once)
    if name == "learn":
        return streams.learn_job(lines, args.out, args.once)
    return streams.archive_job(lines, TOPICS[name], args.out, args.once)


if __name__ == "__main__":
    main()
