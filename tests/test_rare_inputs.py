"""Inputs the fixtures lack: new checkpoints, emptied days, empty logs, invalid ranges, large n."""

import pytest
from pyspark.sql import functions as F

from weblens.operators.geo import with_region
from weblens.operators.kv import CellTable
from weblens.operators.topn import top_n
from weblens.plans import access, reports
from weblens.sources.writers import STAT_TABLES, read_stats
from weblens.streaming import clicks as cs


def values(table):
    return {r["row_key"]: r["value"] for r in table.totals().collect()}


def test_new_stream_wins_and_keeps_the_other_cells(spark, tmp_path):
    table = CellTable(spark, str(tmp_path / "t"))

    def cells(**kw):
        return spark.createDataFrame(list(kw.items()) or [], "row_key STRING, value BIGINT")
    table.put(cells(a=1, b=2), 7, "one")
    table.put(cells(a=5), 0, "two")
    table.put(cells(), 0, "two")
    assert values(table) == {"a": 5, "b": 2}
    table.put(cells(a=6), 1, "two")
    table.put(cells(a=6), 1, "two")
    assert values(table) == {"a": 6, "b": 2}


def test_running_totals_drop_no_click(spark, tmp_path):
    line = '1.1.1.1\t{}\t"GET /class/9.html HTTP/1.1"\t200\t-'
    times = ["2024-01-05 00:00:00", "junk", "2023-01-01 10:00:00", "2024-01-05 01:00:00"]
    table = CellTable(spark, str(tmp_path / "totals"))
    for k, day in enumerate((times[:1], times[1:])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.txt").write_text("\n".join(line.format(t) for t in day) + "\n")
        cs.start_running_totals(cs.file_lines(spark, str(tmp_path / "in")), table, str(tmp_path / "c"), once=True).awaitTermination()
    assert values(table) == {"20240105_9": 2, "19700101_9": 1, "20230101_9": 1}


def test_rerun_clears_an_empty_day(spark, tmp_path):
    schema = "url STRING, cmsType STRING, cmsId BIGINT, traffic BIGINT, ip STRING, city STRING, time STRING, day STRING"
    row = ("u", "video", 1, 5, "1.1.1.1", "x", "t", "20240105")
    other = ("u", "video", 2, 5, "1.1.1.1", "x", "t", "20240106")
    access.store_daily_stats(spark.createDataFrame([row, other], schema), str(tmp_path))
    fixed = spark.createDataFrame([("u", "article", *row[2:]), other], schema)
    for day in ("20240105", None):
        access.store_daily_stats(fixed, str(tmp_path), day)
        for name in STAT_TABLES:
            assert [r["day"] for r in read_stats(spark, str(tmp_path), name).collect()] == ["20240106"]


@pytest.mark.parametrize("text, lines", [("", 0), ("bad\nworse\n", 2)])
def test_empty_and_all_rejected(spark, tmp_path, text, lines):
    (tmp_path / "log.txt").write_text(text)
    ranges = spark.createDataFrame([(0, 9, "a")], "lo BIGINT, hi BIGINT, region STRING")
    assert access.clean_access_log(spark, str(tmp_path / "log.txt"), str(tmp_path / "out"), ranges) == {"lines": lines, "rejects": lines}
    counted = reports.word_count_job(spark, str(tmp_path / "log.txt"), str(tmp_path / "words"))
    assert counted["lines"] == lines


@pytest.mark.parametrize("rows, problem", [
    ([(0, 9, "a"), (5, 12, "b")], "overlap"), ([(9, 3, "a")], "not within"), ([(None, 3, "a")], "not within"), ([(3, None, "a")], "not within"),
    ([(0, 2 ** 32, "a")], "not within"), ([(0, 2 ** 62, "a")], "not within"), ([(0, 9, "a"), (0, 9, "a")], "overlap")])
def test_invalid_ranges_fail_the_query(spark, rows, problem):
    ips = spark.createDataFrame([("0.0.0.5",)], "ip STRING")
    found = with_region(ips, spark.createDataFrame(rows, "lo BIGINT, hi BIGINT, region STRING"))
    with pytest.raises(Exception, match=problem):
        found.collect()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_region_next_to_a_map(spark, threshold):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    ips = spark.createDataFrame([("0.0.0.5", {"k": 1}), ("nowhere", {}), ("9.9.9.9", None)], "ip STRING, m MAP<STRING, INT>")
    ranges = spark.createDataFrame([(0, 9, "a")], "lo BIGINT, hi BIGINT, region STRING")
    out = with_region(ips, ranges).collect()
    spark.conf.set(key, before)
    assert {r["ip"]: r["region"] for r in out} == {"0.0.0.5": "a", "nowhere": None, "9.9.9.9": None}


def test_top_n_is_cut_before_the_shuffle_for_any_n(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("key"), "id")
    plan = top_n(df, ["key"], [F.desc("id")], 5000, "rank")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
