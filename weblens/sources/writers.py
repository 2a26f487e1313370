"""Batch sinks."""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weblens import schemas
from weblens.sources.commits import append_marker, delete_folders, folders, read_or_empty, read_or_none

# The result tables of the daily statistics.
STAT_TABLES = {
    "video": "day_video_access_topn_stat",
    "city": "day_video_city_access_topn_stat",
    "traffic": "day_video_traffics_topn_stat",
}

# The markers: which run holds a day.
STAT_RUNS = "stat_runs"


def write_text(df: DataFrame, folder: str, separator: str = ",", stamp: int | None = None) -> str:
    """One text line per row, in a new sub-folder named by the current milliseconds."""
    path = f"{folder}/{int(time.time() * 1000) if stamp is None else stamp}"
    fields = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(separator, *fields).alias("value")).write.text(path)
    return path


def _by_partition(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring the rows of a partition value together: one file for a small one. AQE splits a value
    that is larger than the advisory size over several tasks and files."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_partitioned(df: DataFrame, path: str, *columns: str, compression: str = "gzip",
                      only_given: bool = False, arranged: bool = False) -> None:
    """Parquet in one folder per partition value.

    Overwrites the whole path, or with ``only_given`` just the partitions that ``df`` has rows for. Input
    that is ``arranged`` (logs in order of time, so that a split holds few days) is written from where
    it was read, without a shuffle.
    """
    placed = df if arranged else _by_partition(df, list(columns))
    (placed.write.mode("overwrite")
     .option("compression", compression)
     .option("partitionOverwriteMode", "dynamic" if only_given else "static")
     .partitionBy(*columns).parquet(path))


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_table(df: DataFrame, table: str, *columns: str) -> None:
    """A managed Parquet table, partitioned by ``columns``, which become its last columns."""
    (_by_partition(df, list(columns)).write.format("parquet").mode("overwrite")
     .partitionBy(*columns).saveAsTable(table))


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header in the order of ``df``, in as many files as it has partitions.

    With ``single_file`` in one, written by one task: only for reports of a few rows.
    """
    placed = df.coalesce(1) if single_file else df
    placed.write.mode("overwrite").option("header", True).csv(path)


def write_bucketed(df: DataFrame, table: str, column: str, buckets: int) -> None:
    """A managed Parquet table in ``buckets`` hash buckets of ``column``, sorted by it, with table and column
    statistics. A join or aggregate by ``column`` reads it without an exchange."""
    (df.repartition(buckets, F.col(column)).write.format("parquet").mode("overwrite")
     .bucketBy(buckets, column).sortBy(column).saveAsTable(table))
    df.sparkSession.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")


def write_stats(stats: Mapping[str, DataFrame], folder: str, days: DataFrame) -> None:
    """Write the daily statistics of ``days`` (day), which replace what a former run stored for those days, also where
    there is no row any more.

    ``stats`` has the keys of ``STAT_TABLES`` and rows of ``days`` only. Every run writes folders of its own; they
    count from its marker on, which is written last, so all days of all tables change at once, and a failure on
    the way changes nothing.
    """
    spark = days.sparkSession
    runs = read_or_none(spark, f"{folder}/{STAT_RUNS}", schemas.STAT_RUN)
    run = 1 if runs is None else 1 + (runs.agg(F.max("run")).first()[0] or 0)
    for name, df in stats.items():
        write_partitioned(df, f"{folder}/{STAT_TABLES[name]}/run={run}", "day", compression="snappy")
    append_marker(days.select("day", F.lit(run).cast("bigint").alias("run")).distinct(), f"{folder}/{STAT_RUNS}")


def _valid_runs(spark: SparkSession, folder: str) -> DataFrame:
    return (read_or_empty(spark, f"{folder}/{STAT_RUNS}", schemas.STAT_RUN)
            .groupBy("day").agg(F.max("run").alias("run")))


def read_stats(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the ``STAT_TABLES`` as its last runs left it; markers are listed before the folders they speak of."""
    schema, valid = schemas.STATS[name], _valid_runs(spark, folder)
    stored = read_or_empty(spark, f"{folder}/{STAT_TABLES[name]}", StructType([*schema.fields, schemas.STAT_RUN["run"]]))
    return stored.join(valid, ["day", "run"], "left_semi").select(*schema.fieldNames())


def sweep_stats(spark: SparkSession, folder: str) -> int:
    """Delete the folders that later runs replaced; not while a reader of them may still run."""
    valid, old = _valid_runs(spark, folder).withColumnRenamed("run", "_valid"), []
    for name, table in STAT_TABLES.items():
        stored = read_or_none(spark, f"{folder}/{table}", StructType([*schemas.STATS[name].fields, schemas.STAT_RUN["run"]]))
        if stored is not None:
            old += folders(stored.select("day", "run", "_metadata.file_path").join(valid, "day").filter("run < _valid"))
    return delete_folders(spark, old)
