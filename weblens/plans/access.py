"""Access log to clean day-partitioned Parquet, and its daily statistics."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weblens import schemas
from weblens.operators import clean, stats
from weblens.functions.aggregates import observed
from weblens.operators.geo import check_ranges
from weblens.sources.readers import read_lines, read_partitioned, spread
from weblens.sources.writers import write_parquet, write_partitioned, write_stats


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a result that several outputs read, and release it afterwards."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def clean_access_log(spark: SparkSession, source: str, target: str, ranges: DataFrame,
                     site: str = clean.SITE, rejects: str | None = None,
                     arranged: bool = False) -> dict[str, int]:
    """Parse the lines under ``source`` into ``target``; returns the counts of lines and rejects.

    One scan; a second one only if the rejected lines are to be kept in ``rejects``. Logs ``arranged``
    by time are not shuffled.
    """
    check_ranges(ranges)
    lines = read_lines(spark, source)
    parsed = clean.parse_access(lines if arranged else spread(lines), site)
    seen = Observation()
    good = clean.accepted_access(clean.observe_rejects(parsed, seen), ranges)
    write_partitioned(good, target, "day", arranged=arranged)
    if rejects:
        write_parquet(clean.rejected(parsed), rejects)
    return observed(seen, lambda: parsed.agg(F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejects")))


def daily_stats(counts: DataFrame, n: int = 3) -> dict[str, DataFrame]:
    """The three statistics tables, from ``stats.access_counts``."""
    item = F.col("cmsId").alias("cms_id")
    return {
        "video": stats.video_totals(counts).select("day", item, "times"),
        "city": stats.city_topn(counts, n).select("day", item, "city", "times", "times_rank"),
        "traffic": stats.traffic_totals(counts).select("day", item, "traffics"),
    }


def store_daily_stats(access: DataFrame, target: str, day: str | None = None, n: int = 3) -> None:
    """Compute and store the statistics of one day, or of all days in ``access``.

    The access rows are read and shuffled once, for the counts that all three tables share. A day that is
    asked for, or that has access rows, loses what a former run stored even if no row replaces it.
    """
    spark = access.sparkSession
    if day:
        with persisted(stats.access_counts(stats.of_day_and_type(access, day))) as counts:
            write_stats(daily_stats(counts, n), target, spark.range(1, numPartitions=1).select(F.lit(day).alias("day")))
    else:
        with persisted(stats.access_counts_of_all_days(access)) as counts:
            write_stats(daily_stats(counts.filter("counted"), n), target, counts.select("day").distinct())


def daily_stats_job(spark: SparkSession, source: str, target: str, day: str) -> None:
    store_daily_stats(read_partitioned(spark, source, schemas.CLEAN_ACCESS), target, day)
