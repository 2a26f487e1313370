"""Counts, top-n and word counts: against brute force and against each other."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import Observation, functions as F

from weblens import schemas
from weblens.operators import stats, topn
from weblens.plans import access, reports


@pytest.fixture(scope="module")
def views(spark):
    rng = random.Random(5)
    rows = [(f"2013-05-{rng.randrange(10, 14)}", rng.choice(["", "u1", "u2"]),
             rng.choice(["", *map(str, range(20))])) for _ in range(500)]
    rows += [("2013-06-01", "", ""), ("2013-06-02", "u", ""), ("2013-06-03", "", "g")]
    return spark.createDataFrame(rows, schemas.PAGE_VIEW)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_pv_uv_forms_agree(views):
    rows = views.collect()
    pv, uv = Counter(r.date for r in rows if r.url), defaultdict(set)
    for r in rows:
        if r.guid:
            uv[r.date].add(r.guid)
    expected = {(d, pv[d], len(uv[d])) for d in {*pv, *uv}}
    assert as_set(stats.pv_uv_daily(views)) == expected
    assert as_set(stats.pv_uv_joined(stats.pv_daily(views), stats.uv_daily(views))) == expected
    assert as_set(stats.pv_uv_full_join(views)) == expected
    assert {r[0] for r in expected} >= {"2013-06-02", "2013-06-03"}
    assert "2013-06-01" not in {r[0] for r in expected}
    by_distinct = stats.distinct_visitors(views).groupBy("date").count()
    assert as_set(by_distinct) == as_set(stats.uv_daily(views))


def test_stamped_rows(views):
    rows = stats.stamped_pv_uv(stats.pv_uv_daily(views)).collect()
    assert rows and all(r.id == 0 and r.millis > 1_600_000_000_000 for r in rows)


def test_big_day_is_counted_in_two_steps(views):
    plan = stats.pv_uv_daily(views)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Expand" not in plan


@pytest.fixture(scope="module")
def clean_rows(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(600):
        day = rng.choice(["20170510", "20170511"])
        city = rng.choice([None, None, "A", "B"])
        kind = rng.choice(["video", "video", "article"])
        rows.append(("u", kind, rng.randrange(12), rng.randrange(100), "ip", city, "t", day))
    return spark.createDataFrame(rows, schemas.CLEAN_ACCESS)


def test_daily_statistics(clean_rows):
    videos = stats.of_day_and_type(clean_rows, "20170511")
    rows = [r for r in clean_rows.collect() if r.day == "20170511" and r.cmsType == "video"]
    times, traffics, cities = Counter(), Counter(), defaultdict(Counter)
    for r in rows:
        times[r.cmsId] += 1
        traffics[r.cmsId] += r.traffic
        cities[r.city][r.cmsId] += 1

    for counts in (stats.unit_counts(videos), stats.access_counts(videos)):
        got = [(r.cmsId, r.times) for r in stats.video_access_topn(counts).collect()]
        assert got == sorted(times.items(), key=lambda p: (-p[1], p[0]))
        assert [(r.cmsId, r.times) for r in stats.video_access_topn(counts, 4).collect()] == got[:4]
        got = [(r.cmsId, r.traffics) for r in stats.video_traffic_topn(counts).collect()]
        assert got == sorted(traffics.items(), key=lambda p: (-p[1], p[0]))
        best = {(c, i, t, k) for c, items in cities.items() for k, (i, t) in enumerate(
            sorted(items.items(), key=lambda p: (-p[1], p[0]))[:3], 1)}
        got = stats.city_topn(counts).select("city", "cmsId", "times", "times_rank")
        assert as_set(got) == best


def test_video_statistic_dsl_equals_sql(clean_rows):
    counts = stats.unit_counts(stats.of_day_and_type(clean_rows, None))
    assert stats.video_access_topn(counts).collect() == stats.video_access_topn_sql(clean_rows).collect()


def test_daily_stats_tables_have_their_schemas(clean_rows):
    tables = access.daily_stats(stats.access_counts(clean_rows))
    for name, schema in {"video": schemas.DAY_VIDEO, "city": schemas.DAY_CITY_VIDEO,
                         "traffic": schemas.DAY_TRAFFIC}.items():
        assert tables[name].schema.simpleString() == schema.simpleString()


def test_taxi_dsl_equals_sql(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(12), "1", "2", f"{rng.randrange(6):02d}:00:00") for _ in range(400)]
    trips = spark.createDataFrame(rows, schemas.TAXI)
    dsl, sql = stats.taxi_topn(trips).collect(), stats.taxi_topn_sql(trips).collect()
    assert dsl == sql
    assert [(r.hour, r["rank"]) for r in dsl] == [
        (f"{h:02d}", k) for h in range(6) for k in range(1, 6)]
    counts = Counter((r[0], r[3][:2]) for r in rows)
    assert all(counts[r.id, r.hour] == r["count"] for r in dsl)


# --- grouped top-k ------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have one key, and most of those one value."""
    rng = random.Random(4)
    rows = [("hot", 50 if rng.random() < .8 else rng.randrange(60)) for _ in range(700)]
    rows += [(f"k{rng.randrange(40)}", rng.randrange(-5, 90)) for _ in range(1400)]
    rows += [("one", -1), ("twins", 3), ("twins", 3)]
    return spark.createDataFrame(rows, schemas.KEY_VALUE).repartition(6)


@pytest.mark.parametrize("k", [1, 3, 7])
def test_topk_strategies_agree(skewed, k):
    groups = defaultdict(list)
    for r in skewed.collect():
        groups[r.key].append(r.value)
    expected = {key: sorted(v, reverse=True)[:k] for key, v in groups.items()}
    for strategy in (topn.topk_collect, topn.topk_salted, topn.topk_bounded):
        assert {r.key: r["values"] for r in strategy(skewed, k).collect()} == expected, strategy
    flat = defaultdict(list)
    for r in topn.topk_secondary_sort(skewed, k).collect():
        flat[r.key].append(r.value)
    assert flat == expected


def test_secondary_sort_order(skewed):
    sorted_parts = topn.topk_secondary_sort(skewed).withColumn("part", F.spark_partition_id())
    parts = defaultdict(list)
    for r in sorted_parts.collect():
        parts[r.part].append((r.key, r.value))
    assert all(rows == sorted(rows, reverse=True) for rows in parts.values())


@pytest.mark.parametrize("strategy", reports.TOPK.values())
def test_topk_prunes_before_the_shuffle(skewed, strategy):
    """Below the exchange by key each task keeps k rows per key; no list of a whole group is built."""
    plan = strategy(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 3, Partial" in plan
    assert plan.index("collect_list") < plan.index("WindowGroupLimit") if "collect_list" in plan else True


# --- words --------------------------------------------------------------------------------------

TEXT = ["It's a cat; a CAT.", "", "   ", "a  b  ", "，全；角 a", "end."]


def plain(line):
    return "".join(c for c in line.lower() if c not in ";；.!',")


def java_tokens(line):
    if line == "":
        return [""]
    return line.rstrip(" ").split(" ") if line.rstrip(" ") else []


def test_word_counts(lines):
    df = lines(*TEXT)
    raw = Counter(w for t in TEXT for w in t.split(" ") if w)
    normal = Counter(w for t in TEXT for w in plain(t).split(" ") if w)
    assert dict(map(tuple, stats.word_count_raw(df).collect())) == raw
    assert dict(map(tuple, stats.word_count(df).collect())) == normal
    dual = Counter(("raw", w) for t in TEXT for w in java_tokens(t))
    dual += Counter(("normalised", w) for t in TEXT for w in java_tokens(plain(t)))
    assert {(r.kind, r.word): r.n for r in stats.word_count_dual(df).collect()} == dual


def test_line_and_token_totals(lines):
    df = lines(*TEXT)
    expected = (len(TEXT), sum(len(java_tokens(t)) for t in TEXT))
    assert tuple(stats.line_token_totals(df).first()) == expected
    seen = Observation()
    stats.word_count(stats.observe_line_token_totals(df, seen)).collect()
    assert (seen.get["lines"], seen.get["tokens"]) == expected
    assert tuple(stats.line_token_totals(df.limit(0)).first()) == (0, 0)


def test_both_sides_of_the_full_join_share_an_exchange(spark, tmp_path):
    path = str(tmp_path / "views")
    rows = [("d1", "u", "a"), ("d1", "", "b"), ("d1", "u", ""), ("d2", "u", ""), ("d3", "", "a"), ("d4", "", ""), ("d5", None, None), ("d1", "u", "a")]
    spark.createDataFrame(rows, "date STRING, url STRING, guid STRING").write.parquet(path)
    joined = stats.pv_uv_full_join(spark.read.parquet(path))
    assert as_set(joined) == {("d1", 3, 2), ("d2", 1, 0), ("d3", 0, 1)}
    plan = joined._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
