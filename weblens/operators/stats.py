"""Counts, sums and distinct counts over cleaned logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from weblens.functions.text import normalize_text, split_fields
from weblens.operators.topn import top_n

# --- page views and unique visitors -------------------------------------------------------------


def pv_daily(views: DataFrame) -> DataFrame:
    return views.filter(F.col("url") != "").groupBy("date").agg(F.count(F.lit(1)).alias("pv"))


def distinct_visitors(views: DataFrame) -> DataFrame:
    return views.filter(F.col("guid") != "").select("date", "guid").distinct()


def uv_daily(views: DataFrame) -> DataFrame:
    """Spark counts distinct guids in two steps, first by (date, guid): one big day does not skew it."""
    return (views.filter(F.col("guid") != "")
            .groupBy("date").agg(F.count_distinct("guid").alias("uv")))


def pv_uv_daily(views: DataFrame) -> DataFrame:
    """PV and UV from one scan and one aggregate; dates with neither are left out."""
    return (views.groupBy("date")
            .agg(F.count(F.when(F.col("url") != "", 1)).alias("pv"),
                 F.count_distinct(F.when(F.col("guid") != "", F.col("guid"))).alias("uv"))
            .filter((F.col("pv") > 0) | (F.col("uv") > 0)))


def pv_uv_joined(pv: DataFrame, uv: DataFrame) -> DataFrame:
    """Full join of separately computed PV and UV tables; a missing side counts 0."""
    zero = F.lit(0).cast("bigint")
    return (pv.join(uv, "date", "full")
            .select("date", F.coalesce("pv", zero).alias("pv"), F.coalesce("uv", zero).alias("uv")))


def visits(views: DataFrame) -> DataFrame:
    """Page views per date and visitor, of which PV and UV both add up; visitors without a page have 0."""
    return views.groupBy("date", "guid").agg(F.count(F.when(F.col("url") != "", 1)).alias("pages"))


def pv_uv_full_join(views: DataFrame) -> DataFrame:
    """PV and UV as two tables, full joined, from one scan: both aggregate the same exchange by (date, guid).

    Both read the same columns of it, or column pruning would tell the two exchanges apart.
    """
    seen = visits(views)
    pv = seen.groupBy("date").agg(F.sum("pages").alias("pv")).filter("pv > 0")
    visitor = (F.col("guid") != "") & (F.col("pages") >= 0)
    uv = seen.groupBy("date").agg(F.count(F.when(visitor, 1)).alias("uv")).filter("uv > 0")
    return pv_uv_joined(pv, uv)


def stamped_pv_uv(pv_uv: DataFrame) -> DataFrame:
    """The RDBMS form of a PV/UV table: a zero ``id`` for the database to replace, and the load time."""
    return pv_uv.select(F.lit(0).cast("bigint").alias("id"), "date", "pv", "uv",
                        F.unix_millis(F.current_timestamp()).alias("millis"))


# --- daily statistics over clean access rows ----------------------------------------------------

def of_day_and_type(access: DataFrame, day: str | None, cms_type: str = "video") -> DataFrame:
    """Rows of one content type, of one day or of all: a partition filter and a pushed filter."""
    typed = access.filter(F.col("cmsType") == cms_type)
    return typed if day is None else typed.filter(F.col("day") == day)


def unit_counts(access: DataFrame) -> DataFrame:
    """Every access as a count of one: the input of a statistic that is computed on its own.

    Rows without ``city`` will do for the statistics that do not need it.
    """
    keys = [c for c in ("day", "city", "cmsId") if c in access.columns]
    return access.select(*keys, F.lit(1).cast("bigint").alias("times"),
                         F.col("traffic").alias("traffics"))


def access_counts_of_all_days(access: DataFrame, cms_type: str = "video") -> DataFrame:
    """``access_counts`` of one content type (``counted``), and a row for every day with others, in one pass."""
    mine = F.coalesce(F.col("cmsType") == cms_type, F.lit(False))
    keys = ("city", "cmsId", "traffic")
    return (access.select("day", mine.alias("counted"), *[F.when(mine, F.col(k)).alias(k) for k in keys])
            .groupBy("day", "counted", "city", "cmsId").agg(F.count("cmsId").alias("times"), F.sum("traffic").alias("traffics")))


def access_counts(access: DataFrame) -> DataFrame:
    """Accesses and traffic per (day, city, item): all three daily statistics add up from it."""
    return access.groupBy("day", "city", "cmsId").agg(
        F.count("cmsId").alias("times"), F.sum("traffic").alias("traffics"))


def video_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("day", "cmsId").agg(F.sum("times").alias("times"))


def traffic_totals(counts: DataFrame) -> DataFrame:
    return counts.groupBy("day", "cmsId").agg(F.sum("traffics").alias("traffics"))


def city_topn(counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most accessed items of every city and day."""
    per_city = counts.groupBy("day", "city", "cmsId").agg(F.sum("times").alias("times"))
    return top_n(per_city, ["day", "city"], [F.desc("times"), F.asc("cmsId")], n, "times_rank")


def ranked(totals: DataFrame, by: str, n: int | None = None) -> DataFrame:
    """Totals from the largest to the smallest; all of them unless ``n`` is given."""
    ordered = totals.orderBy(F.desc(by), "day", "cmsId")
    return ordered if n is None else ordered.limit(n)


def video_access_topn(counts: DataFrame, n: int | None = None) -> DataFrame:
    return ranked(video_totals(counts), "times", n)


def video_traffic_topn(counts: DataFrame, n: int | None = None) -> DataFrame:
    return ranked(traffic_totals(counts), "traffics", n)


VIDEO_ACCESS_SQL = """
FROM {access}
|> WHERE cmsType = {cms_type}
|> AGGREGATE count(*) AS times GROUP BY day, cmsId
|> ORDER BY times DESC, day, cmsId"""


def video_access_topn_sql(access: DataFrame, cms_type: str = "video") -> DataFrame:
    """``video_access_topn`` as SQL text over the clean access rows."""
    return access.sparkSession.sql(VIDEO_ACCESS_SQL, access=access, cms_type=cms_type)


# --- taxi trips ---------------------------------------------------------------------------------

def hourly_counts(trips: DataFrame) -> DataFrame:
    """Trips per taxi and hour of the day; the hour is the first two characters of the time."""
    return (trips.select("id", F.substring("time", 1, 2).alias("hour"))
            .groupBy("id", "hour").agg(F.count(F.lit(1)).alias("count")))


def taxi_topn(trips: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` busiest taxis of every hour, in order of hour and rank."""
    best = top_n(hourly_counts(trips), ["hour"], [F.desc("count"), F.asc("id")], n, "rank")
    return best.orderBy("hour", "rank")


TAXI_TOPN_SQL = """
FROM {trips}
|> AGGREGATE count(*) AS count GROUP BY id, left(time, 2) AS hour
|> EXTEND row_number() OVER (PARTITION BY hour ORDER BY count DESC, id) AS rank
|> WHERE rank <= {n}
|> SELECT id, hour, count, rank
|> ORDER BY hour, rank"""


def taxi_topn_sql(trips: DataFrame, n: int = 5) -> DataFrame:
    """``taxi_topn`` as one SQL statement."""
    return trips.sparkSession.sql(TAXI_TOPN_SQL, trips=trips, n=n)


# --- words --------------------------------------------------------------------------------------

def _count_words(words: DataFrame) -> DataFrame:
    return (words.filter(F.col("word") != "")
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def word_count_raw(lines: DataFrame) -> DataFrame:
    """Non-empty tokens between single spaces."""
    return _count_words(lines.select(F.explode(F.split("value", " ")).alias("word")))


def word_count(lines: DataFrame) -> DataFrame:
    """Non-empty tokens of the lower-cased text without punctuation."""
    return _count_words(
        lines.select(F.explode(F.split(normalize_text("value"), " ")).alias("word")))


def word_count_dual(lines: DataFrame) -> DataFrame:
    """Raw and normalised counts from one scan; empty tokens inside a line count as words."""
    def tagged(kind):
        return F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("words"))

    return (lines.select(split_fields("value", " ").alias("raw"),
                         normalize_text("value").alias("plain"))
            .select("raw", split_fields("plain", " ").alias("normalised"))
            .select(F.inline(F.array(tagged("raw"), tagged("normalised"))))
            .select("kind", F.explode("words").alias("word"))
            .groupBy("kind", "word").agg(F.count(F.lit(1)).alias("n")))


def _totals():
    tokens = F.size(split_fields("value", " "))
    return [F.count(F.lit(1)).alias("lines"),
            F.coalesce(F.sum(tokens), F.lit(0).cast("bigint")).alias("tokens")]


def line_token_totals(lines: DataFrame) -> DataFrame:
    """Lines and tokens, empty tokens inside a line included, without exploding the lines."""
    return lines.agg(*_totals())


def observe_line_token_totals(lines: DataFrame, observation: Observation) -> DataFrame:
    """The same two totals as a side effect of whatever action runs on the returned lines."""
    return lines.observe(observation, *_totals())
