"""Command line: ``spark-submit run_weblens.py <job> <arguments>``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from weblens import schemas
from weblens.operators.clean import SITE
from weblens.operators.kv import CounterTable
from weblens.plans import access, reports
from weblens.session import build_session
from weblens.sources.readers import read_csv, read_table
from weblens.sources.writers import write_csv
from weblens.streaming.clicks import file_lines, kafka_lines, start_click_counters


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="weblens")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *positional: str, **options) -> None:
        sub = jobs.add_parser(name)
        for argument in positional:
            sub.add_argument(argument)
        for option, default in options.items():
            if default == []:
                sub.add_argument(f"--{option}", action="append", default=[])
            elif default is False:
                sub.add_argument(f"--{option}", action="store_true")
            else:
                sub.add_argument(f"--{option}", default=default,
                                 type=str if default is None else type(default))

    job("clean-access", "source", "target", "ranges_csv", site=SITE, rejects=None, arranged=False)
    job("daily-stats", "source", "target", "day")
    job("page-views", "source", "target")
    job("word-count", "source", "target")
    job("group-topk", "source", "target", k=3, strategy="bounded")
    job("taxi", "source", "target", n=5, single_file=False)
    job("emp-dept", "emp_table", "dept_table", "target", "table")
    job("salaries", "emp_table", "target")
    job("clicks-kafka", "servers", "topics", "tables", "checkpoint", "stream_id", kafka_option=[])
    job("clicks-files", "folder", "tables", "checkpoint", "stream_id")
    job("fold-clicks", "tables", "before", sweep=False)
    return parser


def click_tables(spark: SparkSession, folder: str) -> tuple[CounterTable, CounterTable]:
    """The counters per course and per referrer under ``folder``, with the markers they share."""
    return tuple(CounterTable(spark, f"{folder}/{name}", commits=f"{folder}/commits")
                 for name in ("course_click_count", "course_search_click_count"))


def _stream(spark: SparkSession, lines, args) -> None:
    start_click_counters(lines, *click_tables(spark, args.tables), args.checkpoint, args.stream_id).awaitTermination()


def run(spark: SparkSession, argv: list[str]) -> None:
    args = _parser().parse_args(argv)
    if args.job == "clean-access":
        ranges = read_csv(spark, args.ranges_csv, schemas.IP_RANGE)
        print(access.clean_access_log(spark, args.source, args.target, ranges, args.site,
                                      args.rejects, args.arranged))
    elif args.job == "daily-stats":
        access.daily_stats_job(spark, args.source, args.target, args.day)
    elif args.job == "page-views":
        print(reports.page_view_job(spark, args.source, args.target))
    elif args.job == "word-count":
        print(reports.word_count_job(spark, args.source, args.target))
    elif args.job == "group-topk":
        reports.group_topk_job(spark, args.source, args.target, args.k, args.strategy)
    elif args.job == "taxi":
        reports.taxi_job(spark, args.source, args.target, args.n, args.single_file)
    elif args.job == "emp-dept":
        reports.emp_dept_job(spark, read_table(spark, args.emp_table),
                             read_table(spark, args.dept_table), args.target, args.table)
    elif args.job == "salaries":
        write_csv(reports.salary_report(read_table(spark, args.emp_table)), args.target)
    elif args.job == "clicks-kafka":
        options = dict(o.split("=", 1) for o in args.kafka_option)
        _stream(spark, kafka_lines(spark, args.servers, args.topics.split(","), options), args)
    elif args.job == "clicks-files":
        _stream(spark, file_lines(spark, args.folder), args)
    elif args.job == "fold-clicks":
        for table in click_tables(spark, args.tables):
            table.fold(args.before)
            if args.sweep:
                table.sweep()


def main() -> None:
    import sys
    run(build_session("weblens"), sys.argv[1:])
