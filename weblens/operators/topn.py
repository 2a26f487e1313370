"""Top-N per group.

``row_number() <= n`` keeps duplicates, and Spark prunes with it before the shuffle (window group
limit): a task sends at most n rows per group, however many rows the group has. Nothing here collects
a whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column], n: int,
          rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank. The order should end in a unique key."""
    window = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def _as_lists(top: DataFrame, key: str, value: str) -> DataFrame:
    """At most k values per key are left, so the list is bounded."""
    return top.groupBy(key).agg(F.sort_array(F.collect_list(value), asc=False).alias("values"))


def topk_collect(df: DataFrame, k: int = 3, key: str = "key", value: str = "value") -> DataFrame:
    """The k largest values per key as a descending list, from the multiset of values per key.

    The whole group is gathered as (value, count) pairs: they combine before the shuffle and spread by
    (key, value). Best where values repeat a lot.
    """
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    kept = top_n(counts, [key], [F.desc(value)], k, "_rank")
    copies = F.array_repeat(F.col(value), F.least("_n", F.lit(k).cast("bigint")).cast("int"))
    rows = kept.select(key, F.explode(copies).alias(value))
    lists = _as_lists(rows, key, value)
    return lists.withColumn("values", F.slice("values", 1, k))


def topk_salted(df: DataFrame, k: int = 3, key: str = "key", value: str = "value",
                salts: int = 10) -> DataFrame:
    """Two stages: top k per (salt, key), then top k per key. The salt is a hash, so retries agree."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    partial = top_n(df.withColumn("_salt", salt), ["_salt", key], [F.desc(value)], k, "_part")
    return _as_lists(top_n(partial, [key], [F.desc(value)], k, "_rank"), key, value)


def topk_bounded(df: DataFrame, k: int = 3, key: str = "key", value: str = "value") -> DataFrame:
    """At most k rows per key leave each input task. Best where most values differ."""
    return _as_lists(top_n(df, [key], [F.desc(value)], k, "_rank"), key, value)


def topk_secondary_sort(df: DataFrame, k: int = 3, key: str = "key",
                        value: str = "value") -> DataFrame:
    """The k largest rows per key, flat; every partition is sorted by key and value, descending.

    Rows are pruned before they are partitioned by key, and the sort reuses that partitioning.
    """
    return (top_n(df.select(key, value), [key], [F.desc(value)], k, "rank")
            .sortWithinPartitions(F.desc(key), F.desc(value)))
