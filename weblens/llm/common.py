"""Helpers the operators share: staged tables, distributed ranks, guarded broadcasts, Arrow batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weblens.session import scratch_dir
from weblens.sources.commits import delete_folders

# Rows of one BIGINT column that may be broadcast: about 50 MB as a hashed relation.
BROADCAST_IDS = 1_000_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession, rows: int = 500, size: str = "4m") -> None:
    """Bound the Arrow batches that Python workers get, by rows and by bytes (not below one row)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: it ends the lineage, and a lost
    executor costs nothing that was finished."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_at = path
    return table


def released(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: what was made of them is staged itself."""
    for table in tables:
        if path := getattr(table, "staged_at", None):
            delete_folders(table.sparkSession, [path])


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], out: str,
            value: str | None = None, label: str = "running") -> DataFrame:
    """``df`` with the sum of ``value`` over the earlier rows of its group as ``out``, 0 for the first;
    without ``value``, the number of earlier rows.

    Rows are range partitioned, so a group of any size spreads over tasks; only one total per group and
    partition meets the others. ``group`` columns may be NULL. Rows equal in ``order`` come in any order.
    """
    keys = [F.col(g) for g in group]
    placed = staged(
        df.repartitionByRange(partitions(df.sparkSession), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id()), label)
    here = ["_part", *group]
    if value is None:
        totals = placed.groupBy(*here).agg(F.count(F.lit(1)).alias("_total"), F.min("_at").alias("_first"))
    else:
        totals = placed.groupBy(*here).agg(F.sum(value).alias("_total"), F.min("_at").alias("_first"))
        placed = placed.withColumn("_in_part", F.coalesce(F.sum(value).over(
            Window.partitionBy(*here).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"_of{k}") for k in here], "_first",
        F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before"))
    same = F.lit(True)
    for k in here:
        same = same & F.col(k).eqNullSafe(F.col(f"_of{k}"))
    inside = F.col("_at") - F.col("_first") if value is None else F.col("_in_part")
    return (placed.join(offsets, same)
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    (F.col("_before") + inside).cast("bigint").alias(out)))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small_enough(ids: DataFrame, bound: int = BROADCAST_IDS) -> bool:
    """Whether ``ids`` (one BIGINT column) has at most ``bound`` rows, counted."""
    return ids.limit(bound + 1).count() <= bound


def with_ids(df: DataFrame, ids: DataFrame, column: str = "doc_id", keep: bool = True) -> DataFrame:
    """Rows of ``df`` whose ``column`` is among ``ids`` (one column, staged), or with ``keep=False`` the
    others, NULL included. Counted ids within the bound are broadcast, more are joined by shuffle."""
    name = fresh(df, "_id")
    side = ids.select(F.col(ids.columns[0]).alias(name)).distinct()
    if small_enough(ids):
        side = F.broadcast(side)
    return df.join(side, F.col(column) == F.col(name), "left_semi" if keep else "left_anti")
