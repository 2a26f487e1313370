"""Document quality by Bradley-Terry ranking.

A preference pair is a good and a bad labelled document; the probability that the first wins is the logistic
function of the difference of their scores, which are linear in features of the text. The loss on feature
differences gives the weights; the score quantile at the share of bad labels is the threshold.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from weblens.llm.labels import held_out, logistic, sample, scored, sigmoid
from weblens.llm.wordhash import text_slices, word_hashes

PER_CLASS = 3000
PAIRS_PER_DOC = 8

_KIND = np.full(256, 8)
_KIND[32], _KIND[:32] = 0, 1
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 2, 3, 4
_KIND[[ord(c) for c in ".,"]], _KIND[[ord(c) for c in "!?"]] = 5, 6
_KIND[[ord(c) for c in ";:'\"()-"]] = 7
_KIND[128:] = 9
_MARKS = np.array([c for c in range(33, 127) if not chr(c).isalnum()])
WORDS = ["log words", "mean length", "distinct share", "same as last", "same as last but one", "same as last but two",
         "long words", "short words"]


def features(texts: pa.Array) -> np.ndarray:
    """A row per text: shares of byte kinds next to each other, of each ASCII mark, and of words."""
    rows = []
    for _, data, offsets in text_slices(texts):
        n, sizes = len(offsets) - 1, np.diff(offsets)
        doc = np.repeat(np.arange(n), sizes)
        kind = _KIND[data]
        inside = np.flatnonzero(doc[1:] == doc[:-1]) if len(data) else np.zeros(0, np.int64)
        pairs = np.bincount(doc[inside] * 100 + kind[inside] * 10 + kind[inside + 1], minlength=n * 100)
        marked = np.isin(data, _MARKS)
        marks = np.bincount(doc[marked] * 128 + data[marked], minlength=n * 128).reshape(n, 128)[:, _MARKS]
        hashes, at = word_hashes(data, offsets, lower=True)
        words = np.diff(at)
        owner = np.repeat(np.arange(n), words)
        count = lambda mask, where: np.bincount(where[mask], minlength=n)
        repeats = []
        for lag in (1, 2, 3):
            same = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag]) if len(hashes) > lag else np.zeros(0, bool)
            repeats.append(count(same, owner[lag:lag + len(same)]))
        order = np.lexsort((hashes, owner))
        fresh = np.ones(len(hashes), dtype=bool)
        fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        letters = np.bincount(doc[kind > 1], minlength=n)
        some = np.maximum(words, 1)
        length = letters / some
        rows.append(np.column_stack([
            np.sqrt(pairs.reshape(n, 100) / np.maximum(sizes, 1)[:, None]), np.sqrt(marks / np.maximum(sizes, 1)[:, None]),
            np.log1p(words), length, count(fresh, owner[order]) / some, *[np.sqrt(r / some) for r in repeats],
            length > 12, length < 3]))
    return np.concatenate(rows) if rows else np.zeros((0, 100 + len(_MARKS) + len(WORDS)))


class Ranking:
    """Scores of texts; without labels of both classes every score is 1/2."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bad_share: float, ridge: float = 1.0, seed: int = 7):
        self.mean, self.spread = np.zeros(x.shape[1]), np.ones(x.shape[1])
        self.weights, self.threshold = np.zeros(x.shape[1]), 0.0
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        if not len(good) or not len(bad):
            return
        self.mean, self.spread = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = self._scaled(x)
        rng = np.random.default_rng(seed)
        n = PAIRS_PER_DOC * min(max(len(good), len(bad)), PER_CLASS)
        winners = np.resize(rng.permutation(good), n)
        losers = rng.permutation(np.resize(rng.permutation(bad), n))
        # The loser's features minus the winner's with outcome 0 would add nothing: the loss is the same.
        self.weights = logistic(z[winners] - z[losers], np.ones(n), np.full(n, 1.0 / PAIRS_PER_DOC), ridge)
        raw = z @ self.weights
        # The quantile over all labels: each class counts as often as it is among them, not in the sample.
        share = np.where(y == 1, (1 - bad_share) / len(good), bad_share / len(bad))
        order = np.argsort(raw)
        reached = np.cumsum(share[order])
        k = min(int(np.searchsorted(reached, bad_share - 1e-12)), len(raw) - 1)
        self.threshold = float((raw[order][k] + raw[order][min(k + 1, len(raw) - 1)]) / 2)

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -8, 8)

    def score(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self._scaled(features(texts)) @ self.weights - self.threshold)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Ranking:
    """Fit on at most ``per_class`` labelled documents of each class; all labels count for the threshold."""
    chosen, counts = sample(docs, labels, "quality", (per_class, per_class))
    made = chosen.select("doc_id", "text", "label")

    def describe(batches):
        for batch in batches:
            x = features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))],
                                             names=["doc_id", "label", "x"])

    rows = sorted(made.mapInArrow(describe, "doc_id BIGINT, label INT, x ARRAY<DOUBLE>").collect())
    x = np.array([r["x"] for r in rows]).reshape(len(rows), 100 + len(_MARKS) + len(WORDS))
    return Ranking(x, np.array([r["label"] for r in rows]), counts[0] / max(1, sum(counts.values())))


def score_quality(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """``docs`` with held_out, score (0 to 1) and predicted (1 where the score is 0.5 or more).

    Every row is scored by itself, whatever its doc_id; a NULL text counts as empty; columns of these three
    names are replaced, all others stay. Labels that are NULL, contradict each other, or name no document are
    not used.
    """
    kept = docs.drop("held_out", "score", "predicted")
    model = learn(docs, labels, per_class)
    added = StructType([StructField("score", DoubleType())])
    out = scored(kept, lambda texts: {"score": pa.array(model.score(texts))}, added)
    return (out.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
            .select(*[F.col(f"`{c}`") for c in kept.columns], "held_out", "score", "predicted"))
