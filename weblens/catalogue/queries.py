"""One query per operator: ``name -> function(spark, sf_dir) -> DataFrame``.

Queries about files, tables and streams write to a fresh folder under ``spark.checkpoint.dir`` and return
what is read back; all others are one lazy plan over the given tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weblens import schemas
from weblens.catalogue import fixtures as fx
from weblens.functions.aggregates import self_avg, self_avg_in_pandas
from weblens.functions.numbers import format_double, register_sql_functions
from weblens.functions.text import composite_key, referrer_host
from weblens.functions.times import normalize_clf_time, normalize_click_time
from weblens.operators import clean, stats, topn
from weblens.operators.geo import with_region
from weblens.operators.joins import join_emp_dept
from weblens.functions.aggregates import observed
from weblens.operators.kv import CellTable, CounterTable, lookup, scan_prefix
from weblens.plans.access import store_daily_stats
from weblens.plans.reports import emp_dept_job, salary_report
from weblens.session import configure, scratch_dir
from weblens.sources import readers, writers
from weblens.streaming import clicks as cs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "20240105"
EMPTIED_DAY = "20240107"


def query(fn: Query) -> Query:
    """Register under the function's name, less a final underscore that sets it apart from an import."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


def _events(spark, sf_dir):
    return fx.table(spark, sf_dir, "events")


def _heavy(spark, sf_dir, table: str):
    """A table whose rows are expensive to parse."""
    return readers.spread(fx.table(spark, sf_dir, table))


def _access(spark, sf_dir) -> DataFrame:
    """Clean access rows, straight from the lines."""
    lines = fx.access_lines(_heavy(spark, sf_dir, "events"))
    return clean.clean_access(lines, fx.ip_ranges(spark)).good


def _access_fields(spark, sf_dir) -> DataFrame:
    """Clean access rows without the region, for what does not ask for it."""
    parsed = clean.parse_access(fx.access_lines(_heavy(spark, sf_dir, "events")))
    return clean.accepted(parsed, clean.ACCESS_FIELDS)


def _stored_access(spark, sf_dir) -> str:
    path = scratch_dir(spark, "access")
    writers.write_partitioned(_access(spark, sf_dir), path, "day")
    return path


def _views(spark, sf_dir):
    return clean.clean_page_views(fx.page_view_lines(_heavy(spark, sf_dir, "events"))).good


def _trips(spark, sf_dir):
    return fx.taxi_trips(_events(spark, sf_dir))


def _pairs(spark, sf_dir, value="l_extendedprice"):
    lines = fx.key_value_lines(_heavy(spark, sf_dir, "lineitem"), value)
    return clean.clean_key_value(lines).good


def _lines(spark, sf_dir):
    return fx.document_lines(_heavy(spark, sf_dir, "documents"))


def _emp(spark, sf_dir):
    return fx.emp(fx.table(spark, sf_dir, "customer"))


def _dept(spark, sf_dir):
    return fx.dept(fx.table(spark, sf_dir, "nation"))


def _clicks(spark, sf_dir):
    return clean.clean_clicks(fx.click_lines(_heavy(spark, sf_dir, "events")).select("value")).good


# --- sources ------------------------------------------------------------------------------------

@query
def src_text(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    fx.access_lines(_events(spark, sf_dir)).write.text(path)
    return readers.read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("value")).alias("chars"))


@query
def src_csv(spark, sf_dir):
    path = scratch_dir(spark, "trips")
    _trips(spark, sf_dir).write.csv(path)
    return readers.read_csv(spark, path, schemas.TAXI)


@query
def src_parquet_partitioned(spark, sf_dir):
    """The partition column is not given a schema and still is a string."""
    access = readers.read_partitioned(spark, _stored_access(spark, sf_dir))
    return access.groupBy("day").agg(F.count(F.lit(1)).alias("rows"))


DATABASE = "weblens_queries"


def _new_table(spark: SparkSession, name: str) -> str:
    """The name of a table to be, in a database of the session that lies in the shared folder."""
    if not spark.catalog.databaseExists(DATABASE):
        spark.sql(f"CREATE DATABASE {DATABASE} LOCATION '{scratch_dir(spark, 'db')}'")
    return f"{DATABASE}.{name}_{uuid.uuid4().hex}"


def _catalog_emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The employees as a stored table, bucketed by department."""
    table = _new_table(spark, "emp")
    writers.write_bucketed(_emp(spark, sf_dir), table, "deptno", 8)
    return readers.read_table(spark, table)


@query
def src_catalog(spark, sf_dir):
    return _catalog_emp(spark, sf_dir)


@query
def src_collection(spark, sf_dir):
    """A collection of the program, five rows, as a lookup table for the events."""
    sections = [("view", "video"), ("purchase", "video"), ("click", "article"),
                ("signup", "user"), ("error", "none")]
    table = readers.from_rows(spark, sections, ["event_type", "section"])
    return (_events(spark, sf_dir).join(F.broadcast(table), "event_type")
            .groupBy("section").agg(F.count(F.lit(1)).alias("n")))


@query
def typed_projection(spark, sf_dir):
    """Columns named by position, then brought to the declared record type."""
    columns = _emp(spark, sf_dir).select("ename", F.floor("sal").cast("int"))
    return readers.as_record(columns, schemas.PERSON, ["name", "grade"])


# --- sinks --------------------------------------------------------------------------------------

@query
def sink_text(spark, sf_dir):
    path = writers.write_text(stats.pv_uv_daily(_views(spark, sf_dir)), scratch_dir(spark, "pv_uv"))
    return readers.read_lines(spark, path)


@query
def sink_parquet_partitioned(spark, sf_dir):
    return readers.read_partitioned(spark, _stored_access(spark, sf_dir), schemas.CLEAN_ACCESS)


@query
def sink_parquet(spark, sf_dir):
    path = scratch_dir(spark, "emp_dept")
    writers.write_parquet(join_emp_dept(_emp(spark, sf_dir), _dept(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query
def sink_table_partitioned(spark, sf_dir):
    table = _new_table(spark, "emp_dept")
    emp_dept_job(spark, _emp(spark, sf_dir), _dept(spark, sf_dir), scratch_dir(spark, "emp_dept"),
                 table)
    return readers.read_table(spark, table)


@query
def sink_csv(spark, sf_dir):
    path = scratch_dir(spark, "taxi")
    writers.write_csv(stats.taxi_topn(_trips(spark, sf_dir)), path)
    return (spark.read.option("header", True)
            .schema("id INT, hour STRING, count BIGINT, rank INT").csv(path))


def _stored_stats(spark, folder) -> DataFrame:
    tables = [writers.read_stats(spark, folder, name).withColumn("stat_table", F.lit(table))
              for name, table in writers.STAT_TABLES.items()]
    video, city, traffic = tables
    return (video.unionByName(city, allowMissingColumns=True)
            .unionByName(traffic, allowMissingColumns=True)
            .select("stat_table", "day", "cms_id", "city", "times", "times_rank", "traffics"))


@query
def sink_stats(spark, sf_dir):
    folder = scratch_dir(spark, "stats")
    store_daily_stats(_access(spark, sf_dir), folder)
    return _stored_stats(spark, folder)


@query
def sink_replace_day(spark, sf_dir):
    """All days are stored, then one of them again, then another one without its videos, which clears it: every table
    keeps the rows of the other days."""
    folder = scratch_dir(spark, "stats")
    access = readers.read_partitioned(spark, _stored_access(spark, sf_dir), schemas.CLEAN_ACCESS)
    store_daily_stats(access, folder)
    store_daily_stats(access, folder, DAY)
    store_daily_stats(access.filter("cmsType <> 'video'"), folder, EMPTIED_DAY)
    return (_stored_stats(spark, folder).groupBy("stat_table", "day")
            .agg(F.count(F.lit(1)).alias("rows")))


# --- cleaning and projections -------------------------------------------------------------------

@query
def clean_access(spark, sf_dir):
    return _access(spark, sf_dir)


@query
def clean_access_rejects(spark, sf_dir):
    parsed = clean.parse_access(fx.access_lines(_heavy(spark, sf_dir, "events")))
    return clean.rejected(parsed).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def ip_region(spark, sf_dir):
    ips = _events(spark, sf_dir).select("event_id", fx.user_ip().alias("ip"))
    return with_region(ips, fx.ip_ranges(spark))


@query
def parse_page_views(spark, sf_dir):
    return _views(spark, sf_dir)


@query
def parse_key_value(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query
def parse_clicks(spark, sf_dir):
    return _clicks(spark, sf_dir)


@query
def normalize_clf_time_(spark, sf_dir):
    times = fx.clf_times(_heavy(spark, sf_dir, "events"))
    return times.select("raw", normalize_clf_time("raw").alias("normalised"))


@query
def normalize_click_time_(spark, sf_dir):
    times = fx.click_times(_heavy(spark, sf_dir, "events"))
    return times.select("raw", normalize_click_time("raw").alias("normalised"))


@query
def referrer_host_(spark, sf_dir):
    return (_events(spark, sf_dir).select(fx.referer().alias("referer"))
            .select("referer", referrer_host("referer").alias("host"))
            .groupBy("referer", "host").agg(F.count(F.lit(1)).alias("n")))


@query
def filter_day_type(spark, sf_dir):
    """Prunes to one partition and pushes the type filter into the scan."""
    access = readers.read_partitioned(spark, _stored_access(spark, sf_dir), schemas.CLEAN_ACCESS)
    return stats.of_day_and_type(access, DAY)


@query
def project_columns(spark, sf_dir):
    return _emp(spark, sf_dir).select("deptno", "sal")


@query
def preview(spark, sf_dir):
    return _emp(spark, sf_dir).orderBy("empno").limit(10)


# --- joins --------------------------------------------------------------------------------------

@query
def join_catalog_dept(spark, sf_dir):
    """Employees from a stored table, bucketed by department, with the departments."""
    return join_emp_dept(_catalog_emp(spark, sf_dir), _dept(spark, sf_dir))


@query
def pv_uv_full_join(spark, sf_dir):
    return stats.pv_uv_full_join(_views(spark, sf_dir))


# --- aggregates and windows ---------------------------------------------------------------------

@query
def pv_daily(spark, sf_dir):
    return stats.pv_daily(_views(spark, sf_dir))


@query
def uv_daily(spark, sf_dir):
    return stats.uv_daily(_views(spark, sf_dir))


@query
def pv_uv_daily(spark, sf_dir):
    return stats.pv_uv_daily(_views(spark, sf_dir))


@query
def pv_uv_stamped(spark, sf_dir):
    """Load form of the PV/UV table; the load time itself is left out, as it never repeats."""
    rows = stats.stamped_pv_uv(stats.pv_uv_daily(_views(spark, sf_dir)))
    return rows.select("id", "date", "pv", "uv", (F.col("millis") > 0).alias("stamped"))


@query
def distinct_rows(spark, sf_dir):
    return stats.distinct_visitors(_views(spark, sf_dir))


def _video_counts(access):
    return stats.unit_counts(stats.of_day_and_type(access, None))


@query
def video_access_topn(spark, sf_dir):
    return stats.video_access_topn(_video_counts(_access_fields(spark, sf_dir)))


@query
def video_access_topn_sql(spark, sf_dir):
    return stats.video_access_topn_sql(_access_fields(spark, sf_dir))


@query
def video_traffic_topn(spark, sf_dir):
    return stats.video_traffic_topn(_video_counts(_access_fields(spark, sf_dir)))


@query
def city_topn(spark, sf_dir):
    return stats.city_topn(_video_counts(_access(spark, sf_dir)))


@query
def taxi_hourly_counts(spark, sf_dir):
    return stats.hourly_counts(_trips(spark, sf_dir))


@query
def taxi_topn(spark, sf_dir):
    return stats.taxi_topn(_trips(spark, sf_dir))


@query
def taxi_topn_sql(spark, sf_dir):
    return stats.taxi_topn_sql(_trips(spark, sf_dir))


def _joined(lists: DataFrame) -> DataFrame:
    return lists.select("key", F.array_join(F.col("values").cast("array<string>"), ",")
                        .alias("values"))


@query
def topk_collect(spark, sf_dir):
    return _joined(topn.topk_collect(_pairs(spark, sf_dir)))


@query
def topk_collect_ties(spark, sf_dir):
    """All top values are equal: duplicates have to be kept."""
    return _joined(topn.topk_collect(_pairs(spark, sf_dir, "l_quantity")))


@query
def topk_salted(spark, sf_dir):
    return _joined(topn.topk_salted(_pairs(spark, sf_dir)))


@query
def topk_bounded(spark, sf_dir):
    return _joined(topn.topk_bounded(_pairs(spark, sf_dir)))


@query
def topk_secondary_sort(spark, sf_dir):
    return topn.topk_secondary_sort(_pairs(spark, sf_dir))


# --- words --------------------------------------------------------------------------------------

@query
def word_count_raw(spark, sf_dir):
    return stats.word_count_raw(_lines(spark, sf_dir))


@query
def word_count(spark, sf_dir):
    return stats.word_count(_lines(spark, sf_dir))


@query
def word_count_dual(spark, sf_dir):
    return stats.word_count_dual(_lines(spark, sf_dir))


@query
def line_token_totals(spark, sf_dir):
    return stats.line_token_totals(_lines(spark, sf_dir))


@query
def line_token_totals_observed(spark, sf_dir):
    """The totals as a side effect of writing the word counts."""
    seen = Observation()
    lines = stats.observe_line_token_totals(_lines(spark, sf_dir), seen)
    writers.write_parquet(stats.word_count(lines), scratch_dir(spark, "words"))
    totals = observed(seen, lambda: stats.line_token_totals(_lines(spark, sf_dir)))
    return spark.createDataFrame([(totals["lines"], totals["tokens"])],
                                 "lines BIGINT, tokens BIGINT")


# --- user functions and aggregates --------------------------------------------------------------

@query
def udf_str_len(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql("SELECT ename, strLen(ename) AS el FROM {emp}", emp=_emp(spark, sf_dir))


@query
def udf_format_double(spark, sf_dir):
    return _emp(spark, sf_dir).select("empno", format_double("sal", 1).alias("formatSal"))


@query
def self_avg_(spark, sf_dir):
    return (_emp(spark, sf_dir).groupBy("deptno")
            .agg(F.round(self_avg("sal"), 6).alias("avg")))


@query
def self_avg_pandas(spark, sf_dir):
    averages = self_avg_in_pandas(_emp(spark, sf_dir), "deptno", "sal")
    return averages.select("deptno", F.round("avg", 6).alias("avg"))


@query
def udf_udaf_report(spark, sf_dir):
    report = salary_report(_emp(spark, sf_dir))
    return report.withColumns({c: F.round(c, 6) for c in ("selfAvgSal", "sal")})


# --- streams and counter tables -----------------------------------------------------------------

def _click_tables(spark, folder):
    return tuple(CounterTable(spark, f"{folder}/{name}", commits=f"{folder}/commits") for name in ("course", "referrer"))


def _feeds(spark, sf_dir, folder):
    """Write the click lines as two successive deliveries into one folder, yielding after each."""
    lines = fx.click_lines(_events(spark, sf_dir))
    for late in (False, True):
        lines.filter(F.col("late") == late).select("value").write.mode("append").text(folder)
        yield late


def _stream(spark, sf_dir) -> tuple[CounterTable, CounterTable]:
    folder = scratch_dir(spark, "clicks")
    courses, referrers = _click_tables(spark, folder)
    for _ in _feeds(spark, sf_dir, f"{folder}/lines"):
        cs.start_click_counters(
            cs.file_lines(spark, f"{folder}/lines"), courses, referrers,
            f"{folder}/checkpoint", "clicks", once=True).awaitTermination()
    return courses, referrers


@query
def stream_course_clicks(spark, sf_dir):
    courses, _ = _stream(spark, sf_dir)
    return courses.totals().select("row_key", F.col("value").alias("clicks"))


@query
def stream_referrer_clicks(spark, sf_dir):
    _, referrers = _stream(spark, sf_dir)
    return referrers.totals().select("row_key", F.col("value").alias("clicks"))


@query
def stream_running_totals(spark, sf_dir):
    """Day windows as streaming state, upserted into a cell table by every batch."""
    folder = scratch_dir(spark, "running")
    totals = CellTable(spark, f"{folder}/totals")
    for _ in _feeds(spark, sf_dir, f"{folder}/lines"):
        cs.start_running_totals(cs.file_lines(spark, f"{folder}/lines"), totals,
                                f"{folder}/checkpoint", once=True).awaitTermination()
    return totals.totals().select("row_key", F.col("value").alias("clicks"))


def _deltas(spark, sf_dir, late: bool) -> DataFrame:
    lines = fx.click_lines(_events(spark, sf_dir)).filter(F.col("late") == late).select("value")
    return cs.course_deltas(cs.click_counts(clean.clean_clicks(lines).good))


def _counters(spark, sf_dir) -> CounterTable:
    """Both deliveries, the second one replayed."""
    table = CounterTable(spark, scratch_dir(spark, "counters"))
    table.increment(_deltas(spark, sf_dir, False), "feed", 0)
    for _ in range(2):
        table.increment(_deltas(spark, sf_dir, True), "feed", 1)
    return table


@query
def kv_increment(spark, sf_dir):
    return _counters(spark, sf_dir).totals()


@query
def kv_fold(spark, sf_dir):
    """The days up to the middle of the month are folded after the first delivery, again after the second, and both
    deliveries are replayed after that: the totals are those of one write each."""
    table = CounterTable(spark, scratch_dir(spark, "counters"))
    for batch, late in enumerate((False, True)):
        table.increment(_deltas(spark, sf_dir, late), "feed", batch)
        table.fold("20240116")
    table.increment(_deltas(spark, sf_dir, False), "feed", 0)
    table.sweep()
    return table.totals().select("row_key", F.col("value").alias("clicks"))


@query
def stream_batch_counts(spark, sf_dir):
    """Lines and rejects that the stream stored with its batches, over a backlog read one file at a time."""
    folder = scratch_dir(spark, "clicks")
    courses, referrers = _click_tables(spark, folder)
    fx.click_lines(_events(spark, sf_dir)).select("value").repartition(6).write.text(f"{folder}/lines")
    cs.start_click_counters(cs.file_lines(spark, f"{folder}/lines", max_files=2), courses, referrers,
                            f"{folder}/checkpoint", "clicks", once=True).awaitTermination()
    return courses.markers.batches().agg(F.count(F.lit(1)).alias("batches"), F.sum("lines").alias("lines"),
                                         F.sum("rejects").alias("rejects"))


@query
def kv_upsert(spark, sf_dir):
    """The clicks per course of all days, then of the late days only: the later value wins."""
    table = CellTable(spark, scratch_dir(spark, "cells"))
    counts = cs.click_counts(_clicks(spark, sf_dir))
    late = counts.filter(F.substring("day", 7, 2) > "15")
    for version, rows in enumerate([counts, late]):
        cells = rows.groupBy("courseId").agg(F.sum("clicks").alias("value"))
        table.put(cells.select(composite_key(F.lit("course"), "courseId").alias("row_key"),
                               "value"), version)
    return table.totals()


@query
def kv_lookup(spark, sf_dir):
    """Every user on every day they did anything; on some they clicked no course."""
    keys = (_events(spark, sf_dir)
            .select(composite_key(F.date_format("ts", "yyyyMMdd"), "user_id").alias("row_key")))
    return lookup(_counters(spark, sf_dir), keys)


@query
def kv_prefix_scan(spark, sf_dir):
    return scan_prefix(_counters(spark, sf_dir), DAY)


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access lines to text files, cleaned into daily Parquet, read back pruned: top items per city."""
    from weblens.plans.access import clean_access_log

    configure(spark)
    folder = scratch_dir(spark, "flagship")
    fx.access_lines(_events(spark, sf_dir)).write.text(f"{folder}/raw")
    clean_access_log(spark, f"{folder}/raw", f"{folder}/clean", fx.ip_ranges(spark))
    access = readers.read_partitioned(spark, f"{folder}/clean", schemas.CLEAN_ACCESS)
    return stats.city_topn(stats.unit_counts(stats.of_day_and_type(access, None)))
