"""Batch sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of the text files, as ``value``."""
    return spark.read.text(path)


def spread(scan: DataFrame) -> DataFrame:
    """Spread a scan that has few splits (gzip files, one row group) over the cores before heavy parsing.

    Only where at least half of the cores would idle; a scan with enough splits is returned as it is,
    without a shuffle. For a plain scan: its number of splits is known without running anything.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() * 2 <= cores else scan


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV without a header line."""
    return spark.read.schema(schema).option("header", False).csv(path)


def read_partitioned(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Partitioned Parquet. With a schema the partition values get its types and no file is opened;
    without one they stay strings in a session set up by ``weblens.session``."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table or a named view."""
    return spark.table(name)


def from_rows(spark: SparkSession, rows: Sequence, names_or_schema=None) -> DataFrame:
    """A small collection of the driver program as a table, with names ``_1, _2, ...``, with given
    names, or with a full schema."""
    return spark.createDataFrame(rows, names_or_schema)


def as_record(df: DataFrame, schema: StructType, names: Sequence[str] | None = None) -> DataFrame:
    """Name the columns by position and bring them to the types and order of ``schema``."""
    named = df.toDF(*names) if names else df
    return named.to(schema)
