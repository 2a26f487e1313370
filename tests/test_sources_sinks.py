"""Files, tables, collections, and the calls made to JDBC."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from weblens import schemas
from weblens.operators.joins import join_emp_dept
from weblens.plans import access as access_plan
from weblens.session import scratch_dir
from weblens.sources import jdbc, readers, writers

PEOPLE = [("ann", 99), ("bob", 98), ("cleo", 95)]


@pytest.fixture()
def days(spark):
    return spark.range(300).select(
        F.col("id"), F.concat(F.lit("2024010"), (F.col("id") % 3 + 1).cast("string")).alias("day"))


def files(path, day):
    return glob.glob(f"{path}/day={day}/*.parquet")


def test_text_round_trip(spark, lines, tmp_path):
    path = str(tmp_path / "in")
    lines("a\tb", "", "c").write.text(path)
    assert sorted(r.value for r in readers.read_lines(spark, path).collect()) == ["", "a\tb", "c"]


def test_text_sink_uses_a_new_folder(spark, tmp_path):
    df = spark.createDataFrame([("2013-05-19", 2, None)], "date STRING, pv BIGINT, uv BIGINT")
    first = writers.write_text(df, str(tmp_path), stamp=1)
    second = writers.write_text(df, str(tmp_path))
    assert first != second and os.path.basename(second).isdigit()
    assert spark.read.text(first).first().value == "2013-05-19,2,"


def test_spread_only_moves_scans_with_few_splits(spark, lines, tmp_path):
    path = str(tmp_path / "in")
    lines(*"abcdefgh").repartition(1).write.text(path)
    one_split = readers.read_lines(spark, path)
    assert readers.spread(one_split).rdd.getNumPartitions() == 4
    enough = spark.range(0, 100, 1, 4)
    assert readers.spread(enough) is enough


def test_csv_schema(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,30.1,104.2,08:01:02\nx,30.1,104.2,08:01:02\n")
    rows = readers.read_csv(spark, str(tmp_path / "t.csv"), schemas.TAXI).collect()
    assert [tuple(r) for r in rows] == [(1, "30.1", "104.2", "08:01:02"),
                                        (None, "30.1", "104.2", "08:01:02")]


def test_small_sorted_csv_is_one_file_in_order(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(200).repartition(7).select((199 - F.col("id")).alias("n")).orderBy("n")
    writers.write_csv(df, path)
    (file,) = glob.glob(f"{path}/*.csv")
    assert open(file).read().split() == ["n", *map(str, range(200))]
    many = spark.range(50, numPartitions=5)
    writers.write_csv(many, path)
    assert len(glob.glob(f"{path}/*.csv")) == 5
    writers.write_csv(many, path, single_file=True)
    (file,) = glob.glob(f"{path}/*.csv")
    assert open(file).read().split() == ["id", *map(str, range(50))]


def test_partitioned_parquet(spark, days, tmp_path):
    path = str(tmp_path / "p")
    writers.write_partitioned(days.repartition(5), path, "day")
    back = readers.read_partitioned(spark, path)
    assert dict(back.dtypes)["day"] == "string" and back.count() == 300
    for day in ("20240101", "20240102", "20240103"):
        (file,) = files(path, day)
        assert file.endswith(".gz.parquet")
    writers.write_partitioned(days.filter("day = '20240101'"), path, "day")
    assert readers.read_partitioned(spark, path).count() == 100


def test_arranged_input_is_written_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.range(0, 400, 1, 4).select(
        "id", F.when(F.col("id") < 200, "a").otherwise("b").alias("day"))
    writers.write_partitioned(rows, path, "day", arranged=True)
    assert len(files(path, "a")) == 2 and len(files(path, "b")) == 2
    assert spark.read.parquet(path).count() == 400


def test_a_large_partition_value_is_split_over_files(spark, tmp_path):
    path, key = str(tmp_path / "p"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(0, 200_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") < 199_000, "hot").otherwise("cold").alias("day"))
        writers.write_partitioned(rows, path, "day")
    finally:
        spark.conf.set(key, before)
    assert len(files(path, "hot")) > 4 and len(files(path, "cold")) == 1
    assert spark.read.parquet(path).count() == 200_000


def test_pruning_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "a")
    rows = [("u", kind, 1, 1, "ip", None, "t", day)
            for kind in ("video", "article") for day in ("20170510", "20170511")]
    writers.write_partitioned(spark.createDataFrame(rows, schemas.CLEAN_ACCESS), path, "day")
    from weblens.operators.stats import of_day_and_type
    df = of_day_and_type(readers.read_partitioned(spark, path, schemas.CLEAN_ACCESS), "20170511")
    plan = df.select("cmsId")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "EqualTo(cmsType,video)" in plan
    assert "ReadSchema: struct<cmsType:string,cmsId:bigint>" in plan
    assert df.count() == 1


def test_replacing_a_day_keeps_the_others(spark, tmp_path):
    rows = [("u", "video", i % 4, i, "ip", "A", "t", day)
            for day in ("20170510", "20170511") for i in range(20)]
    access = spark.createDataFrame(rows, schemas.CLEAN_ACCESS)
    target = str(tmp_path / "stats")

    def stored():
        return {name: sorted(tuple(r) for r in writers.read_stats(spark, target, name).collect())
                for name in writers.STAT_TABLES}

    access_plan.store_daily_stats(access, target)
    everything = stored()
    assert {k: len(v) for k, v in everything.items()} == {"video": 8, "city": 6, "traffic": 8}
    access_plan.store_daily_stats(access, target, "20170511")
    assert stored() == everything
    access_plan.store_daily_stats(access.filter("cmsId < 2"), target, "20170510")
    assert len(stored()["video"]) == 6


def test_a_run_that_fails_leaves_all_old_days(spark, tmp_path, monkeypatch):
    """A failure after any step, and a reader between any two, meet the old rows or the new ones, never both."""
    rows = [("u", "video", i, 1, "ip", "A", "t", day) for day in ("20170510", "20170511") for i in range(3)]
    access, target = spark.createDataFrame(rows, schemas.CLEAN_ACCESS), str(tmp_path / "stats")
    access_plan.store_daily_stats(access, target)

    def stored():
        return {name: sorted(tuple(r) for r in writers.read_stats(spark, target, name).collect()) for name in writers.STAT_TABLES}
    old, seen, write, mark = stored(), [], writers.write_partitioned, writers.append_marker
    fewer = access.filter("cmsId = 0")
    for steps in range(4):
        def fail(*args, left=[steps], then=write, **options):
            if not left[0]:
                raise OSError("lost")
            left[0] -= 1
            then(*args, **options)
            seen.append(stored())
        monkeypatch.setattr(writers, "write_partitioned", fail)
        monkeypatch.setattr(writers, "append_marker", lambda *args: fail(*args, left=[0]))
        with pytest.raises(OSError):
            access_plan.store_daily_stats(fewer, target, "20170511")
        assert stored() == old
    monkeypatch.setattr(writers, "write_partitioned", write)
    monkeypatch.setattr(writers, "append_marker", mark)
    assert seen and all(s == old for s in seen)
    access_plan.store_daily_stats(fewer, target, "20170511")
    assert {name: [r for r in stored()[name] if r[0] == "20170511"] for name in writers.STAT_TABLES} == {
        "video": [("20170511", 0, 1)], "city": [("20170511", 0, "A", 1, 1)], "traffic": [("20170511", 0, 1)]}
    assert [r for r in stored()["video"] if r[0] == "20170510"] == [r for r in old["video"] if r[0] == "20170510"]
    kept = stored()
    assert writers.sweep_stats(spark, target) == 3 and stored() == kept


def test_a_bucketed_table_is_joined_without_moving_it(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS weblens_buckets LOCATION '{tmp_path}'")
    table, key = "weblens_buckets.emp", "spark.sql.autoBroadcastJoinThreshold"
    emp = spark.range(1000).select(F.col("id").alias("empno"), (F.col("id") % 30).alias("deptno"))
    writers.write_bucketed(emp, table, "deptno", 8)
    stored = readers.read_table(spark, table)
    dept = spark.range(25).select(F.col("id").alias("deptno"), F.concat(F.lit("d"), "id").alias("dname"))
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    try:
        joined = join_emp_dept(stored, dept)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        counted = stored.groupBy("deptno").count()._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == emp.filter("deptno < 25").count()
    finally:
        spark.conf.set(key, before)
    assert "SelectedBucketsCount: 8 out of 8" in plan and plan.count("Exchange hashpartitioning") == 1
    assert "Exchange" not in counted
    statistics = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}["Statistics"]
    assert "1000 rows" in statistics
    assert {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {table} deptno").collect()}["distinct_count"] in ("29", "30", "31")
    spark.sql("DROP DATABASE weblens_buckets CASCADE")


def test_tables(spark, days):
    spark.sql("CREATE DATABASE IF NOT EXISTS weblens_test")
    writers.write_table(days.select("day", "id"), "weblens_test.days", "day")
    table = readers.read_table(spark, "weblens_test.days")
    assert table.columns == ["id", "day"] and table.count() == 300
    writers.write_table(days.limit(3), "weblens_test.days", "day")
    assert readers.read_table(spark, "weblens_test.days").count() == 3
    spark.sql("DROP DATABASE weblens_test CASCADE")


def test_collections(spark):
    assert readers.from_rows(spark, PEOPLE).columns == ["_1", "_2"]
    named = readers.from_rows(spark, PEOPLE, ["name", "grade"])
    assert dict(named.dtypes) == {"name": "string", "grade": "bigint"}
    typed = readers.as_record(readers.from_rows(spark, PEOPLE), schemas.PERSON, ["name", "grade"])
    assert typed.schema.simpleString() == schemas.PERSON.simpleString()
    assert [tuple(r) for r in typed.collect()] == PEOPLE
    graded = readers.from_rows(spark, [(1, "ann", 99.2)], schemas.GRADED_PERSON)
    assert graded.schema == schemas.GRADED_PERSON


def test_as_record_orders_columns_and_rejects_missing_ones(spark):
    from pyspark.errors import AnalysisException
    df = readers.from_rows(spark, [(99, "ann")], "grade INT, name STRING")
    assert tuple(readers.as_record(df, schemas.PERSON).first()) == ("ann", 99)
    with pytest.raises(AnalysisException):
        readers.as_record(df.select("name"), schemas.StructType(
            [schemas.StructField("grade", schemas.IntegerType(), False)])).collect()


def test_scratch_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark), scratch_dir(spark)
    assert one != two and one.startswith(base)


# --- JDBC: no database is started, the calls are recorded ---------------------------------------

class Recorder:
    """Stands in for a reader or writer: remembers every call and returns itself."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call


class FakeSession:
    def __init__(self):
        self.read = Recorder()


class FakeFrame:
    def __init__(self):
        self.write = Recorder()


URL, PROPS = "jdbc:x://host/db", {"user": "u"}


def test_jdbc_reads():
    spark = FakeSession()
    jdbc.read_jdbc(spark, URL, "t_dept", PROPS)
    jdbc.read_jdbc_range(spark, URL, "t_dept", "deptno", 10, 30, 4, PROPS)
    jdbc.read_jdbc_predicates(spark, URL, "t_dept", ["deptno < 20", "deptno >= 20"], PROPS)
    assert spark.read.calls == [
        ("jdbc", (URL, "t_dept"), {"properties": PROPS}),
        ("jdbc", (URL, "t_dept"), {"column": "deptno", "lowerBound": 10, "upperBound": 30,
                                   "numPartitions": 4, "properties": PROPS}),
        ("jdbc", (URL, "t_dept"), {"predicates": ["deptno < 20", "deptno >= 20"],
                                   "properties": PROPS})]


def test_jdbc_writes():
    df = FakeFrame()
    jdbc.overwrite_jdbc(df, URL, "t_dept", PROPS)
    jdbc.append_jdbc(df, URL, "pv_uv", PROPS, connections=2)
    names = [(name, args) for name, args, _ in df.write.calls]
    assert names == [
        ("mode", ("overwrite",)), ("option", ("batchsize", jdbc.BATCH_ROWS)),
        ("option", ("numPartitions", 16)), ("jdbc", (URL, "t_dept")),
        ("mode", ("append",)), ("option", ("batchsize", jdbc.BATCH_ROWS)),
        ("option", ("numPartitions", 2)), ("jdbc", (URL, "pv_uv"))]


def test_jdbc_replaces_days_in_all_tables_before_appending():
    events, frames = [], {name: FakeFrame() for name in writers.STAT_TABLES}
    jdbc.replace_days_jdbc(frames, ["20170511"], URL, lambda sql, args: events.append((sql, args)))
    assert events == [(f"DELETE FROM {t} WHERE day = ?", ["20170511"])
                      for t in writers.STAT_TABLES.values()]
    for name, frame in frames.items():
        assert frame.write.calls[0][:2] == ("mode", ("append",))
        assert frame.write.calls[-1][1] == (URL, writers.STAT_TABLES[name])
