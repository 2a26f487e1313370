"""User-defined aggregates that keep partial aggregation.

An aggregate is a set of buffer slots, each a built-in aggregate, and a final expression over them.
Spark combines built-in aggregates before the shuffle, so a hot key costs one buffer per map task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from weblens.functions.text import as_col


@dataclass(frozen=True)
class AlgebraicAggregate:
    """``buffer`` maps a slot to a built-in aggregate of the input, ``evaluate`` combines the slots."""

    buffer: Mapping[str, Callable[[Column], Column]]
    evaluate: Callable[[Mapping[str, Column]], Column]

    def __call__(self, column: Column | str) -> Column:
        value = as_col(column)
        return self.evaluate({slot: fold(value) for slot, fold in self.buffer.items()})


def _mean(slots: Mapping[str, Column]) -> Column:
    return (F.when(slots["n"] == 0, F.lit(float("nan")))
            .otherwise(slots["total"] / slots["n"]))


#: Average as sum / count. NULLs are skipped; a group without values gives NaN.
self_avg = AlgebraicAggregate(
    buffer={"total": lambda v: F.sum(v.cast("double")), "n": F.count},
    evaluate=_mean)


def aggregate_batches(df: DataFrame, keys: Sequence[str], inputs: Sequence[str],
                      update: Callable[[pd.DataFrame], pd.DataFrame], buffer: StructType,
                      merge: Mapping[str, Callable[[Column], Column]],
                      evaluate: Callable[[Mapping[str, Column]], Column], name: str) -> DataFrame:
    """Aggregate with Python code on the input side, for folds that no built-in expresses.

    ``update`` turns one Arrow batch into at most one buffer row per key (``buffer`` is its schema, keys
    first); Spark merges the slots with built-in aggregates. No task ever holds a whole group.
    """
    def partials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield update(batch)

    merged = (df.select(*keys, *inputs).mapInPandas(partials, buffer)
              .groupBy(*keys)
              .agg(*[fold(F.col(slot)).alias(slot) for slot, fold in merge.items()]))
    return merged.select(*keys, evaluate({slot: F.col(slot) for slot in merge}).alias(name))


def self_avg_in_pandas(df: DataFrame, key: str, value: str, name: str = "avg") -> DataFrame:
    """``self_avg`` per key through :func:`aggregate_batches`."""
    def update(batch: pd.DataFrame) -> pd.DataFrame:
        return (batch.groupby(key, dropna=False)[value].agg(["sum", "count"]).reset_index()
                .set_axis([key, "total", "n"], axis=1))

    buffer = StructType([df.schema[key]]).add("total", DoubleType()).add("n", LongType())
    return aggregate_batches(df, [key], [value], update, buffer,
                             {"total": F.sum, "n": F.sum}, _mean, name)


def observed(seen: Observation, recount: Callable[[], DataFrame]) -> dict[str, int]:
    """What ``seen`` counted on the way. Where the optimizer left the observed part out of the plan, because it
    could not give a row to the output, there is nothing to get, and ``recount`` (one row) counts instead."""
    try:
        return seen.get
    except Py4JJavaError as error:  # what Spark says of an observation without a row; anything else is a failure
        if error.java_exception.getClass().getName() != "java.lang.AssertionError":
            raise
        return {k: v or 0 for k, v in recount().first().asDict().items()}
