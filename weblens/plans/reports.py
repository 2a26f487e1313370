"""The other batch jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from weblens import schemas
from weblens.functions.aggregates import observed
from weblens.functions.numbers import register_sql_functions
from weblens.operators import clean, stats, topn
from weblens.operators.joins import join_emp_dept
from weblens.sources.readers import read_csv, read_lines, read_table, spread
from weblens.sources.writers import write_csv, write_parquet, write_table, write_text

TOPK = {
    "collect": topn.topk_collect,
    "salted": topn.topk_salted,
    "bounded": topn.topk_bounded,
    "secondary_sort": topn.topk_secondary_sort,
}


def page_view_job(spark: SparkSession, source: str, target: str) -> str:
    """PV and UV per day as text lines; returns the folder written."""
    views = clean.clean_page_views(spread(read_lines(spark, source))).good
    return write_text(stats.pv_uv_daily(views), target)


def word_count_job(spark: SparkSession, source: str, target: str) -> dict[str, int]:
    """Raw and normalised word counts; returns the line and token totals seen on the way."""
    seen = Observation()
    lines = stats.observe_line_token_totals(spread(read_lines(spark, source)), seen)
    write_parquet(stats.word_count_dual(lines), target)
    return observed(seen, lambda: stats.line_token_totals(read_lines(spark, source)))


def group_topk_job(spark: SparkSession, source: str, target: str, k: int = 3,
                   strategy: str = "bounded") -> None:
    pairs = clean.clean_key_value(spread(read_lines(spark, source))).good
    write_parquet(TOPK[strategy](pairs, k), target)


def taxi_job(spark: SparkSession, source: str, target: str, n: int = 5, single_file: bool = False) -> None:
    write_csv(stats.taxi_topn(read_csv(spark, source, schemas.TAXI), n), target, single_file)


EMP_DEPT_VIEW = "weblens_emp_dept"


def emp_dept_job(spark: SparkSession, emp: DataFrame, dept: DataFrame, target: str,
                 table: str) -> None:
    """Join, then store as files and as a table partitioned by ``deptno``.

    The join is cached as a view with a name of its own while the two outputs are written.
    """
    view = f"{EMP_DEPT_VIEW}_{uuid.uuid4().hex}"
    join_emp_dept(emp, dept).createOrReplaceTempView(view)
    spark.catalog.cacheTable(view)
    try:
        write_parquet(read_table(spark, view), target)
        write_table(read_table(spark, view), table, "deptno")
    finally:
        spark.catalog.uncacheTable(view)
        spark.catalog.dropTempView(view)


SALARY_SQL = """
SELECT deptno, strLen(deptno) AS el, self_avg(sum(sal), count(sal)) AS selfAvgSal,
       AVG(sal) AS sal, format_double(AVG(sal), 1) AS formatSal
FROM {emp} GROUP BY deptno"""


def salary_report(emp: DataFrame) -> DataFrame:
    """Average salaries per department by the registered SQL functions."""
    spark = emp.sparkSession
    register_sql_functions(spark)
    return spark.sql(SALARY_SQL, emp=emp.select("deptno", "sal"))
