"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weblens.llm.common import staged

ROWS_PER_TASK = 1_000_000


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("_least"))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b: BIGINT): the smallest node reachable.

    Nodes without an edge to another node are not in the result; NULL ends and loops are ignored. Every
    round is staged. A large star links the larger neighbours of a node to its smallest one, a small star
    its smaller ones; nothing but an edge and a minimum per node ever meets in a task.
    """
    def settle(df: DataFrame, label: str, rows: int | None = None) -> tuple[DataFrame, tuple]:
        """``df`` staged, in as few files as its last known size needs, and what tells it from another state."""
        if rows is not None:
            df = df.coalesce(rows // ROWS_PER_TASK + 1)
        df = staged(df, label)
        return df, tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now, before = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                         .filter("a > b").distinct(), "edges")
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select(F.col("a").alias("_of"), F.least("a", "_least").alias("_least"))
        large = (both.filter("b > a").join(least, F.col("a") == F.col("_of"))
                 .select(F.col("b").alias("a"), F.col("_least").alias("b")).distinct())
        least = _least(large).select(F.col("a").alias("_of"), "_least")
        small = large.join(least, F.col("a") == F.col("_of"))
        now, after = settle(
            small.select("a", F.col("_least").alias("b"))
            .union(small.filter("b > _least").select(F.col("b").alias("a"), F.col("_least").alias("b"))).distinct(),
            "stars", before[0])
        if after == before:
            return _with_roots(now)
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return _with_roots(now)


def _with_roots(stars: DataFrame) -> DataFrame:
    return (stars.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .union(stars.select("b", "b").distinct()))
