"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Native operators only. A source is clamped where its share of the budget passes ``cap`` times its size, and
the excess goes to the others by weight, until none is above. A source that is to give 1.3 times its size
takes every document once, and a seeded selection of whole documents for the other 0.3.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weblens.llm.common import fresh, running, staged

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def bucket(doc_id: Column | str, seed: str) -> Column:
    """One of ``BUCKETS`` cells by the id and the seed; NULL ids share one."""
    text = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":" + seed))
    return F.conv(F.substring(F.md5(text), 1, 3), 16, 10).cast("int")


def water_fill(sources: DataFrame, budget: tuple[int, int], cap: int) -> DataFrame:
    """``sources`` (source_size, weight: BIGINT) with ``target``: the share of budget[0]/budget[1] times all
    sizes, at most ``cap`` times the source's size.

    The level, budget per weight, is a fraction of whole numbers, so that reruns agree to the last bit. A
    round clamps the sources above the level of the last one; levels only rise, and it ends when no more
    are clamped. Only sums leave the executors.
    """
    big = "decimal(38,0)"
    size, weight = F.col("source_size").cast(big), F.col("weight").cast(big)

    def above(num: int, den: int) -> Column:
        return weight * F.lit(num).cast(big) > size * F.lit(cap * den).cast(big)

    def level(clamped: Column) -> tuple[int, int, int]:
        s = sources.agg(
            F.sum("source_size").alias("all"), F.sum(F.when(clamped, F.col("source_size"))).alias("full"),
            F.sum(F.when(~clamped, F.col("weight"))).alias("open"), F.count_if(clamped).alias("n")).first()
        return (budget[0] * (s["all"] or 0) - budget[1] * cap * (s["full"] or 0),
                budget[1] * (s["open"] or 0), s["n"])

    num, den, n = level(F.lit(False))
    while den:
        clamped = above(num, den)
        num_next, den_next, n_next = level(clamped)
        if n_next == n:
            break
        num, den, n = num_next, den_next, n_next
    full = F.col("source_size").cast("double") * cap
    share = (F.col("weight") * F.lit(num)).cast("double") / F.lit(float(den)) if den else full
    target = F.when(above(num, den), full).otherwise(share) if den else full
    return sources.withColumn("target", target.cast("double"))


def mix_plan(sizes: DataFrame, weights: Sequence[int], budget: tuple[int, int], cap: int) -> DataFrame:
    """One row per source: source_size, target, and what to take: ``whole`` repetitions of every document,
    and one more of the documents whose bucket is marked in ``more``.

    ``sizes`` is staged: source, size, bucket. Buckets are taken in order, each if it fits into what is still wanted,
    so that one that is too large stops none behind it; the one that is left and comes nearest to the rest is added, if
    that is nearer than nothing.
    """
    totals = staged(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    ranked = running(totals, [], [F.asc_nulls_last("source")], "place", label="ranked-sources")
    cycle = F.array(*[F.lit(w).cast("bigint") for w in weights])
    weighted = staged(ranked.withColumn("weight", F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int")))
                      .drop("place"), "weighted-sources")
    goals = (water_fill(weighted, budget, cap)
             .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
                         .otherwise(0).cast("bigint"))
             .withColumn("want", F.col("target") - F.col("whole") * F.col("source_size")))
    goals = staged(goals, "goals")

    # At most BUCKETS cells a source, whatever its rows.
    cells = (sizes.filter("size > 0").groupBy("source", "bucket").agg(F.sum("size").alias("amount"))
             .groupBy("source").agg(F.array_sort(F.collect_list(F.struct("bucket", "amount"))).alias("cells"))
             .select(F.col("source").alias("_source"), "cells"))
    none = F.array().cast("array<int>")
    first = F.struct(F.col("want").alias("rest"), none.alias("taken"))

    def take(done: Column, cell: Column) -> Column:
        fits = cell["amount"] <= done["rest"]
        return F.struct(F.when(fits, done["rest"] - cell["amount"]).otherwise(done["rest"]).alias("rest"),
                        F.when(fits, F.array_append(done["taken"], cell["bucket"])).otherwise(done["taken"]).alias("taken"))

    cuts = (goals.join(cells, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
            .withColumn("_done", F.aggregate(F.coalesce("cells", F.array().cast("array<struct<bucket:int,amount:bigint>>")), first, take)))
    # Staged, or the steps below would compute it anew for every cell.
    cuts = staged(cuts, "fitted-buckets")
    off = F.transform(F.filter("cells", lambda c: ~F.array_contains("_done.taken", c["bucket"])),
                      lambda c: F.struct(F.abs(c["amount"] - F.col("_done.rest")).alias("off"), c["bucket"].alias("bucket")))
    near = F.array_min(F.filter(off, lambda c: c["off"] < F.col("_done.rest")))
    taken = F.when(near.isNotNull(), F.array_append("_done.taken", near["bucket"])).otherwise(F.col("_done.taken"))
    marks = F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda k: F.array_contains("taken", k))
    cuts = staged(cuts.withColumn("taken", taken), "taken-buckets")
    return staged(cuts.select("source", "source_size", "target", "whole", marks.alias("more")), "mix-plan")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget: tuple[int, int] = (3, 2), cap: int = 2,
        seed: str = "mix") -> DataFrame:
    """All rows of ``docs`` (doc_id, text, source) with ``_size`` words, ``_repeats`` in the mix, and
    ``_source_size`` and ``_target`` of the source.

    Weights go to the sources by code point, NULL last, and repeat. A NULL or empty text has size 0 and is
    repeated with its bucket. Rows with the same doc_id are taken together; a NULL doc_id is an id like
    others. No rows give no rows. Columns named like these four are replaced, all others stay.
    """
    added = ["_size", "_repeats", "_source_size", "_target"]
    kept = [c for c in docs.columns if c not in added]
    sizes = staged(docs.select("source", word_count("text").alias("size"), bucket("doc_id", seed).alias("bucket")),
                   "sizes")
    plan = mix_plan(sizes, weights, budget, cap)
    name = {c: fresh(docs, f"_plan_{c}") for c in plan.columns}
    plan = plan.select(*[F.col(c).alias(n) for c, n in name.items()])
    again = F.get(F.col(name["more"]), bucket("doc_id", seed)).cast("bigint")
    return (docs.select(*[F.col(f"`{c}`") for c in kept])
            .join(plan, F.col("source").eqNullSafe(F.col(name["source"])))
            .select(*[F.col(f"`{c}`") for c in kept], word_count("text").alias("_size"),
                    (F.col(name["whole"]) + again).alias("_repeats"),
                    F.col(name["source_size"]).alias("_source_size"), F.col(name["target"]).alias("_target")))


def repeated(mixed: DataFrame) -> DataFrame:
    """The rows of the mix: each as often as it is taken, without the added columns."""
    added = ["_size", "_repeats", "_source_size", "_target"]
    copy = fresh(mixed, "_copy")
    return (mixed.filter("_repeats > 0")
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("_repeats").cast("int"))))
            .drop(copy, *added))
