"""Labelled rows to learn from, and scoring of whole texts next to the columns they came with."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from weblens.llm.common import bounded_batches


def held_out(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 3, is 1; a NULL id is not held out, and has no label."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label 0 or 1) of the rows that may be learnt from; ids with both labels are left out."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out())
            .groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("_high"))
            .filter(F.col("label") == F.col("_high")).select(F.col("doc_id").alias("_id"), F.col("label").cast("int").alias("label")))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int]) -> tuple[DataFrame, dict[int, int]]:
    """At most ``per_class`` labelled documents of each class (doc_id, text, label), by hash of the id, and the
    number of all training labels by class. Only the chosen ids, bounded so, are broadcast."""
    known = training_labels(labels, label)
    counts = {0: 0, 1: 0} | {r[0]: r[1] for r in known.groupBy("label").agg(F.count(F.lit(1))).collect()}
    order = [F.xxhash64("_id", F.lit("sample")), F.col("_id")]
    chosen = [known.filter(F.col("label") == k).orderBy(*order).limit(n) for k, n in enumerate(per_class)]
    picked = F.broadcast(chosen[0].union(chosen[1]))
    return docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("_id")).select("doc_id", "text", "label"), counts


def scored(docs: DataFrame, score: Callable[[pa.Array], dict[str, pa.Array]], added: StructType) -> DataFrame:
    """``docs`` with the columns that ``score`` makes from a batch of texts, in one pass without a shuffle."""
    bounded_batches(docs.sparkSession)
    at, names = docs.columns.index("text"), [*docs.columns, *added.fieldNames()]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = score(batch.column(at))
            yield pa.RecordBatch.from_arrays([*batch.columns, *(found[n] for n in added.fieldNames())], names=names)

    return docs.mapInArrow(add, StructType(docs.schema.fields + added.fields))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 40) -> np.ndarray:
    """Weights of the least ridge-penalised logistic loss, by damped Newton steps."""
    def loss(w: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)) + ridge / 2 * w @ w)

    w = np.zeros(x.shape[1])
    now = loss(w)
    for _ in range(steps):
        p = sigmoid(x @ w)
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        move, rate = np.linalg.solve(curve, slope), 1.0
        while rate > 1e-4 and loss(w - rate * move) > now:
            rate /= 2
        w = w - rate * move
        before, now = now, loss(w)
        if before - now < 1e-7 * max(1.0, abs(before)):
            break
    return w
