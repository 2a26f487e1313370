"""RDBMS tables. The caller brings the URL, the driver on the class path and the credentials."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from weblens.sources.writers import STAT_TABLES

BATCH_ROWS = 10_000


def read_jdbc(spark: SparkSession, url: str, table: str,
              properties: Mapping[str, str] | None = None) -> DataFrame:
    """Over one connection. Filters and column choice reach the database."""
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def read_jdbc_range(spark: SparkSession, url: str, table: str, column: str, lower: int, upper: int,
                    partitions: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """Over ``partitions`` connections, by ranges of a number column. The bounds only set the stride:
    rows outside them go to the first and last partition."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=partitions, properties=dict(properties or {}))


def read_jdbc_predicates(spark: SparkSession, url: str, table: str, predicates: Sequence[str],
                         properties: Mapping[str, str] | None = None) -> DataFrame:
    """One connection per predicate. Together they must cover every row exactly once."""
    return spark.read.jdbc(url, table, predicates=list(predicates),
                           properties=dict(properties or {}))


def _write(df: DataFrame, mode: str, url: str, table: str, properties: Mapping[str, str] | None,
           connections: int) -> None:
    # Every partition is one connection and one transaction.
    (df.write.mode(mode).option("batchsize", BATCH_ROWS).option("numPartitions", connections)
     .jdbc(url, table, properties=dict(properties or {})))


def overwrite_jdbc(df: DataFrame, url: str, table: str,
                   properties: Mapping[str, str] | None = None, connections: int = 16) -> None:
    _write(df, "overwrite", url, table, properties, connections)


def append_jdbc(df: DataFrame, url: str, table: str,
                properties: Mapping[str, str] | None = None, connections: int = 16) -> None:
    _write(df, "append", url, table, properties, connections)


def replace_days_jdbc(stats: Mapping[str, DataFrame], days: Iterable[str], url: str,
                      run_sql: Callable[[str, Sequence], object],
                      properties: Mapping[str, str] | None = None) -> None:
    """Delete the days from every statistics table, then append: a rerun leaves no duplicates.

    ``run_sql(statement, parameters)`` runs a statement on the caller's own database connection.
    """
    for day in days:
        for table in STAT_TABLES.values():
            run_sql(f"DELETE FROM {table} WHERE day = ?", [day])
    for name, df in stats.items():
        append_jdbc(df, url, STAT_TABLES[name], properties)
