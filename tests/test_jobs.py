"""Whole jobs through the command line."""

import glob

import pytest

from weblens import cli, schemas
from weblens.operators.kv import increment_together
from weblens.plans import access, reports
from weblens.sources.writers import read_stats
from weblens.operators.clean import SITE


@pytest.fixture()
def run(spark):
    return lambda *argv: cli.run(spark, [str(a) for a in argv])


def test_access_jobs(spark, run, tmp_path, capsys):
    lines = [f"2017-05-1{d} 10:00:00\t{SITE}video/{i}\t10\t10.0.0.{i}" for d in (0, 1)
             for i in (1, 1, 2)] + ["junk"]
    (tmp_path / "log").write_text("\n".join(lines))
    (tmp_path / "ranges.csv").write_text(f"{10 << 24},{(10 << 24) + 1},home\n")
    run("clean-access", tmp_path / "log", tmp_path / "clean", tmp_path / "ranges.csv",
        "--rejects", tmp_path / "rejects")
    assert "{'lines': 7, 'rejects': 1}" in capsys.readouterr().out
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == [
        ("junk", "missing_field")]
    run("daily-stats", tmp_path / "clean", tmp_path / "stats", "20170511")
    city = read_stats(spark, str(tmp_path / "stats"), "city")
    assert {(r.day, r.cms_id, r.city, r.times, r.times_rank) for r in city.collect()} == {
        ("20170511", 1, "home", 2, 1), ("20170511", 2, None, 1, 1)}


def test_overlapping_ranges_stop_the_job(spark, tmp_path):
    (tmp_path / "log").write_text("x")
    ranges = spark.createDataFrame([(1, 5, "a"), (5, 9, "b")], schemas.IP_RANGE)
    with pytest.raises(ValueError, match="overlap"):
        access.clean_access_log(spark, str(tmp_path / "log"), str(tmp_path / "out"), ranges)


def test_page_views(spark, run, tmp_path):
    (tmp_path / "log").write_text("2013-05-19 1\tu\tg\n2013-05-19 2\tu\tg\n2013-05-20 1\t\tg\n")
    run("page-views", tmp_path / "log", tmp_path / "out")
    (folder,) = glob.glob(str(tmp_path / "out" / "*"))
    assert sorted(r.value for r in spark.read.text(folder).collect()) == [
        "2013-05-19,2,1", "2013-05-20,0,1"]


def test_word_count(spark, run, tmp_path, capsys):
    (tmp_path / "wc.txt").write_text("a b\nA, b\n")
    run("word-count", tmp_path / "wc.txt", tmp_path / "out")
    assert "{'lines': 2, 'tokens': 4}" in capsys.readouterr().out
    rows = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {("raw", "a", 1), ("raw", "A,", 1), ("raw", "b", 2), ("normalised", "a", 2),
                    ("normalised", "b", 2)}


@pytest.mark.parametrize("strategy", reports.TOPK)
def test_group_topk(spark, run, tmp_path, strategy):
    (tmp_path / "kv").write_text("a 1\na 3\na 2\nb 9\nbroken\n")
    run("group-topk", tmp_path / "kv", tmp_path / "out", "--k", 2, "--strategy", strategy)
    rows = spark.read.parquet(str(tmp_path / "out"))
    if strategy == "secondary_sort":
        assert {tuple(r) for r in rows.collect()} == {("a", 3, 1), ("a", 2, 2), ("b", 9, 1)}
    else:
        assert {r.key: r["values"] for r in rows.collect()} == {"a": [3, 2], "b": [9]}


def test_taxi(run, tmp_path):
    (tmp_path / "t.csv").write_text("1,a,b,08:00:00\n2,a,b,08:00:01\n2,a,b,08:30:00\n3,a,b,07:00:00\n")
    run("taxi", tmp_path / "t.csv", tmp_path / "out", "--n", 1)
    (file,) = glob.glob(str(tmp_path / "out" / "*.csv"))
    assert open(file).read().split() == ["id,hour,count,rank", "3,07,1,1", "2,08,2,1"]


def test_emp_dept_and_salaries(spark, run, tmp_path):
    spark.createDataFrame([(1, 10, 1000.0), (2, 10, 2000.1), (3, 20, 500.0), (4, 99, 1.0)],
                          "empno INT, deptno INT, sal DOUBLE").createOrReplaceTempView("t_emp")
    spark.createDataFrame([(10, "x"), (20, "y")], "deptno INT, dname STRING") \
        .createOrReplaceTempView("t_dept")
    run("emp-dept", "t_emp", "t_dept", tmp_path / "out", "t_emp_dept")
    expected = {("x", 1, 10, 1000.0), ("x", 2, 10, 2000.1), ("y", 3, 20, 500.0)}
    files = spark.read.parquet(str(tmp_path / "out"))
    assert files.columns == ["dname", "empno", "deptno", "sal"]
    assert {tuple(r) for r in files.collect()} == expected
    table = spark.table("t_emp_dept")
    assert table.columns == ["dname", "empno", "sal", "deptno"]
    assert {(r.dname, r.empno, r.deptno, r.sal) for r in table.collect()} == expected
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(reports.EMP_DEPT_VIEW)]
    spark.sql("DROP TABLE t_emp_dept")
    run("salaries", "t_emp", tmp_path / "salaries")
    rows = spark.read.option("header", True).csv(str(tmp_path / "salaries")).collect()
    assert {r["deptno"]: r["formatSal"] for r in rows}["10"] == "1500.1"


def test_parser_knows_the_streaming_jobs():
    args = cli._parser().parse_args(["clicks-kafka", "h:1", "a,b", "/t", "/c", "s1", "--kafka_option", "kafka.group.id=g",
                                     "--kafka_option", "maxOffsetsPerTrigger=1000"])
    assert args.kafka_option == ["kafka.group.id=g", "maxOffsetsPerTrigger=1000"]
    assert (args.job, args.topics, args.stream_id) == ("clicks-kafka", "a,b", "s1")


def test_fold_clicks(spark, run, tmp_path):
    tables = cli.click_tables(spark, str(tmp_path))
    rows = spark.createDataFrame([("20181209_1", 2), ("20181210_1", 3)], "row_key STRING, delta BIGINT")
    increment_together({table: rows for table in tables}, "s", 0)
    run("fold-clicks", tmp_path, "20181210", "--sweep")
    for table in tables:
        assert {r.row_key: r.value for r in table.totals().collect()} == {"20181209_1": 2, "20181210_1": 3}
        assert not [f for f in (tmp_path / table.path).rglob("log/**/key_day=20181209/*.parquet")]
