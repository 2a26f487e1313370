"""Parsing of good, odd and broken lines."""

import random

import pytest
from pyspark.sql import Observation, functions as F

from weblens import schemas
from weblens.operators import clean, geo

SITE = clean.SITE


@pytest.fixture()
def ranges(spark):
    return spark.createDataFrame(
        [(0x0A000000, 0x0A0000FF, "lan"), (0x0A010000, 0x0A03FFFF, "wide"),
         (0xCA608600, 0xCA6086FF, "city")], schemas.IP_RANGE)


def access(*fields):
    return "\t".join(fields)


TIME = "2017-05-11 14:09:14"


def test_access_line(lines, ranges):
    good, rejects = clean.clean_access(
        lines(access(TIME, SITE + "video/4500", "304", "10.0.0.7")), ranges)
    assert good.schema.simpleString() == schemas.CLEAN_ACCESS.simpleString()
    assert tuple(good.first()) == (
        SITE + "video/4500", "video", 4500, 304, "10.0.0.7", "lan", TIME, "20170511")
    assert rejects.count() == 0


@pytest.mark.parametrize("path, kind, number", [
    ("video/1/more", "video", 1), ("video/1/", "video", 1), ("video", "", 0), ("video/", "", 0),
    ("", "", 0), ("/", "", 0), ("code/007", "code", 7), ("/5/x", "", 5)])
def test_access_paths(lines, ranges, path, kind, number):
    line = access(TIME, SITE + path, "1", "1.1.1.1")
    row = clean.clean_access(lines(line), ranges).good.first()
    assert (row.cmsType, row.cmsId, row.city) == (kind, number, None)


@pytest.mark.parametrize("line, reason", [
    (access(TIME, SITE + "video/1", "5"), "missing_field"),
    (access(TIME, SITE + "video/1", "5", ""), "missing_field"),
    ("", "missing_field"),
    (access(TIME, SITE + "video/1", "5x", "1.1.1.1"), "bad_traffic"),
    (access(TIME, SITE + "video/1", " 5", "1.1.1.1"), "bad_traffic"),
    (access(TIME, "http://elsewhere.org/video/1", "5", "1.1.1.1"), "no_site_prefix"),
    (access(TIME, SITE + "video/x1", "5", "1.1.1.1"), "bad_id"),
    (access(TIME, SITE + "video//1", "5", "1.1.1.1"), "bad_id"),
    (access("2017-05-1", SITE + "video/1", "5", "1.1.1.1"), "short_time")])
def test_access_rejects(lines, ranges, line, reason):
    good, rejects = clean.clean_access(lines(line), ranges)
    assert good.count() == 0
    assert [tuple(r) for r in rejects.collect()] == [(line, reason)]


def test_access_site_may_stand_inside_the_url(lines, ranges):
    line = access(TIME, "see " + SITE + "video/3", "5", "1.1.1.1")
    assert clean.clean_access(lines(line), ranges).good.first().cmsId == 3


def test_rejects_are_counted_while_writing(lines, ranges):
    parsed = clean.parse_access(lines("x", access(TIME, SITE, "1", "1.1.1.1"), "y"))
    seen = Observation()
    good = clean.accepted_access(clean.observe_rejects(parsed, seen), ranges)
    assert good.count() == 1
    assert seen.get == {"lines": 3, "rejects": 2}


def test_lines_are_parsed_once(lines):
    """No condition on parsed fields may travel below the parser and repeat its work."""
    good = (clean.accepted(clean.parse_page_views(lines("")), schemas.PAGE_VIEW)
            .filter(F.col("url") != ""))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Generate inline")
    assert "Filter" in above and "Filter" not in below


# --- page views ---------------------------------------------------------------------------------

def test_page_views(lines):
    good, rejects = clean.clean_page_views(lines(
        "2013-05-19 13:00:00\t http://u \t g1 \tx\ty",
        "2013-05-19 13:00:00\t\tg1\tx",
        "2013-05-19 13:00:00\thttp://u\t\tx",
        "2013-05-19 13:00:00\thttp://u\t\t",
        "2013-05-19 13:00:00\thttp://u",
        " \thttp://u\tg1",
        "2013\thttp://u\tg1"))
    assert sorted(tuple(r) for r in good.collect()) == [
        ("2013-05-19", "", "g1"), ("2013-05-19", "http://u", ""), ("2013-05-19", "http://u", "g1")]
    assert sorted(r.reason for r in rejects.collect()) == [
        "blank_time", "missing_field", "missing_field", "short_time"]


# --- key value ----------------------------------------------------------------------------------

def test_key_values(lines):
    good, rejects = clean.clean_key_value(lines("a 1", "b 2 ", "\tc\t 3", "a 1 2", "a", "a x", "a  1"))
    assert sorted(tuple(r) for r in good.collect()) == [("a", 1), ("b", 2), ("c", 3)]
    assert sorted(tuple(r) for r in rejects.collect()) == [
        ("a", "field_count"), ("a  1", "field_count"), ("a 1 2", "field_count"),
        ("a x", "bad_value")]


# --- clicks -------------------------------------------------------------------------------------

def click(url, time="2018-12-05 17:01:01", status="200", referer="http://cn.bing.com/search?q=x"):
    return "\t".join(["10.29.55.98", time, f'"GET {url} HTTP/1.1"', status, referer])


@pytest.mark.parametrize("url, course", [
    ("/class/131.html", 131), ("/classroom/7.html", 7), ("/class/9", 9), ("/class/1/2.html", 1),
    ("/list", 0), ("/learn/88.html", 0), ("/", 0)])
def test_click_courses(lines, url, course):
    row = clean.clean_clicks(lines(click(url))).good.first()
    assert tuple(row) == ("10.29.55.98", "20181205170101", course, 200,
                          "http://cn.bing.com/search?q=x")


@pytest.mark.parametrize("line, reason", [
    (click("/class"), "bad_course"), (click("/class/.html"), "bad_course"),
    (click("/class/x.html"), "bad_course"), (click("/class/."), "bad_course"),
    (click("/list", status="ok"), "bad_status"), (click("/list", referer=""), "missing_field"),
    ("1.1.1.1\t2018-12-05 17:01:01\tx", "missing_field"),
    ("a\tb\tc\t200\te", "bad_request")])
def test_click_rejects(lines, line, reason):
    good, rejects = clean.clean_clicks(lines(line))
    assert good.count() == 0
    assert [tuple(r) for r in rejects.collect()] == [(line, reason)]


def test_click_time_policy(lines):
    bad = lines(click("/class/1.html", time="yesterday"))
    assert clean.clean_clicks(bad).good.first().time == "19700101000000"
    assert clean.clean_clicks(bad, "reject").rejects.first().reason == "bad_time"


# --- regions ------------------------------------------------------------------------------------

@pytest.fixture()
def no_auto_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, -1)
    yield
    spark.conf.set(key, before)


def brute_force(number, ranges):
    return next((name for lo, hi, name in ranges if number is not None and lo <= number <= hi), None)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_region_lookup_by_broadcast_and_by_shuffle(spark, threshold, no_auto_broadcast):
    """Bytes decide: the threshold Spark has for the size of a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(11)
    cuts = sorted(rng.sample(range(1 << 22), 200))
    table = [(lo, hi - 1 - rng.randrange(2), f"r{i}")
             for i, (lo, hi) in enumerate(zip(cuts[::2], cuts[1::2])) if hi - lo > 2]
    ips = [rng.randrange(1 << 22) for _ in range(500)] + [lo for lo, _, _ in table] + [
        hi for _, hi, _ in table]
    rows = [(i, ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))) for i, n in enumerate(ips)]
    rows += [(len(rows), "not an address"), (len(rows) + 1, None)]
    df = spark.createDataFrame(rows, "id INT, ip STRING")
    ranges = spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"),
                                                             F.lit(name).alias("region")) for lo, hi, name in table])))
    found = geo.with_region(df, ranges)
    got = {r.id: r.region for r in found.collect()}
    assert len(got) == len(rows) == found.count()
    assert got == {i: brute_force(n, table) for i, n in enumerate(ips)} | {
        len(ips): None, len(ips) + 1: None}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert ("SortMergeJoin" in plan) == (threshold == "-1")


def test_lookup_runs_nothing_while_it_is_built(spark, ranges):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(1)
            yield batch
    ips = spark.createDataFrame([("10.0.0.1",)], "ip STRING")
    found = geo.with_region(ips, ranges.mapInArrow(count, ranges.schema))
    assert seen.value == 0
    found.collect()
    assert seen.value > 0


def test_a_hot_cell_and_bad_addresses_spread(spark, no_auto_broadcast):
    """Rows without a cell do not share one, and internal names leave the caller's columns alone."""
    rows = [("10.0.0.1", i) for i in range(300)] + [("nowhere", i) for i in range(300)] + [(None, 1)]
    df = spark.createDataFrame(rows, "ip STRING, n INT")
    for name in ("_ip", "_block", "_cell", "_of", "_region", "_lo", "_bits"):
        df = df.withColumn(name, F.lit(name))
    ranges = spark.createDataFrame([((10 << 24), (10 << 24) + 5, "home")], schemas.IP_RANGE)
    found = geo.with_region(df, ranges)
    assert found.columns == [*df.columns, "region"]
    assert found.filter("_ip = '_ip' AND _cell = '_cell' AND _lo = '_lo'").count() == len(rows)
    assert found.groupBy("region").count().orderBy("region").collect() == [(None, 301), ("home", 300)]


def test_cells_fit_dense_and_wide_ranges(spark):
    """Thousands of ranges in one block, next to ranges that cover many blocks: few ranges per cell."""
    dense = [(lo, lo + 9, f"d{lo}") for lo in range(0, 60_000, 10)]
    wide = [(1 << 20, (1 << 24) - 1, "wide"), (1 << 24, (1 << 24) + 65_535, "block")]
    blocks = geo.block_ranges(spark.createDataFrame(dense + wide, schemas.IP_RANGE))
    cells = geo.range_cells(blocks).cache()
    assert cells.count() <= 3 * blocks.count()
    assert cells.groupBy("block", "cell").count().agg({"count": "max"}).first()[0] <= 3
    ips = [(f"0.0.{n >> 8}.{n & 255}", n) for n in range(0, 65_536, 7)] + [("0.18.0.1", None)]
    found = geo.with_region(spark.createDataFrame(ips, "ip STRING, n INT"),
                            spark.createDataFrame(dense + wide, schemas.IP_RANGE))
    for r in found.collect():
        inside = r.n is not None and r.n < 60_000
        assert r.region == (f"d{r.n // 10 * 10}" if inside else "wide" if r.n is None else None)


def test_overlapping_ranges(spark, ranges):
    assert geo.overlapping_ranges(ranges).count() == 0
    bad = ranges.unionByName(spark.createDataFrame([(0x0A020000, 0x0A020001, "x")], schemas.IP_RANGE))
    assert geo.overlapping_ranges(bad).count() == 1
