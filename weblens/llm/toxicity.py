"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Examples are a bounded sample of labelled documents. Terms (runs of letters) are those of the examples that
tell the classes apart; their document frequencies are counted over all documents.
The inverted index of the examples is cut into blocks with the largest weight of each term; a document's bound
for a block is the sum of its weights times those. Blocks are evaluated from the highest bound down, until the
bound falls below the k-th similarity, so the neighbours are exact. Their votes, weighted by distance and class
size, are calibrated on the examples, each without itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from weblens.llm.common import bounded_batches
from weblens.llm.labels import held_out, logistic, sample, scored, sigmoid
from weblens.llm.wordhash import text_slices, word_hashes

PER_CLASS = (2000, 2000)
TERMS = 3072
NEIGHBOURS = 15
BLOCK = 32


def term_counts(texts: pa.Array, terms: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the texts: range of terms per text, term numbers and counts. ``terms`` are sorted hashes."""
    for _, data, offsets in text_slices(texts):
        n = len(offsets) - 1
        hashes, at = word_hashes(data, offsets, lower=True, letters=True)
        place = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
        hit = terms[place] == hashes if len(terms) else np.zeros(len(hashes), bool)
        owner = np.repeat(np.arange(n), np.diff(at))[hit]
        code, count = np.unique(owner * max(1, len(terms)) + place[hit], return_counts=True)
        doc, term = np.divmod(code, max(1, len(terms)))
        yield np.searchsorted(doc, np.arange(n + 1)), term, count


def vector(term: np.ndarray, count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weights (1 + ln tf) idf of a document's terms, of length 1."""
    w = (1 + np.log(count)) * idf[term]
    return w / max(1e-300, float(np.sqrt(w @ w)))


class BlockMaxIndex:
    """Postings (term, example, weight) of the examples, in blocks of BLOCK examples with the largest weight per
    term. Examples with the same heaviest term are put next to each other, which tightens the bounds."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, block: int = BLOCK):
        self.block, self.blocks = block, -(-len(vectors) // block)
        self.largest = np.zeros((terms, self.blocks))
        self.postings = []
        self.query = np.zeros(terms)
        for b in range(self.blocks):
            mine = vectors[b * block:(b + 1) * block]
            term = np.concatenate([t for t, _ in mine])
            weight = np.concatenate([w for _, w in mine])
            owner = np.repeat(np.arange(len(mine)), [len(t) for t, _ in mine])
            self.postings.append((term, owner, weight))
            np.maximum.at(self.largest[:, b], term, weight)

    def nearest(self, term: np.ndarray, w: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the ``k`` most similar by (cosine, number); only those that share a term."""
        bounds = w @ self.largest[term]
        order = np.argsort(-bounds, kind="stable")
        self.query[term] = w
        best, score = np.zeros(0, np.int64), np.zeros(0)
        for b in order:
            if bounds[b] <= 0 or len(best) == k and bounds[b] < score[-1] - 1e-12:
                break
            terms, owner, weight = self.postings[b]
            cosines = np.bincount(owner, weights=weight * self.query[terms], minlength=self.block)
            at = np.flatnonzero(cosines > (score[-1] - 1e-12 if len(best) == k else 0))
            at = at[at + b * self.block != without]
            if len(at):
                best, score = np.concatenate([best, at + b * self.block]), np.concatenate([score, cosines[at]])
                keep = np.lexsort((best, -np.round(score, 12)))[:k]
                best, score = best[keep], score[keep]
        self.query[term] = 0
        return best, score


class Neighbours:
    """The fitted scorer: terms, index, votes and their calibration."""

    def __init__(self, terms, names, idf, ids, labels, vectors, counts, k=NEIGHBOURS):
        self.terms, self.names, self.idf, self.k = terms, names, idf, k
        heaviest = [int(t[w.argmax()]) if len(t) else -1 for t, w in vectors]
        order = np.lexsort((ids, heaviest, labels))
        self.ids, self.labels = np.array(ids, dtype=np.int64)[order], np.array(labels, dtype=np.int64)[order]
        vectors = [vectors[i] for i in order]
        self.index = BlockMaxIndex(vectors, len(terms))
        n = np.bincount(self.labels, minlength=2)
        self.share = np.array([counts[c] / max(1, n[c]) for c in (0, 1)])
        self.prior = counts[1] / max(1, counts[0] + counts[1])
        x = np.array([self._signs(*self.index.nearest(t, w, k, j)) for j, (t, w) in enumerate(vectors)]).reshape(-1, 3)
        weight = self.share[self.labels] if len(self.labels) else np.zeros(0)
        self.line = logistic(x, self.labels.astype(float), weight, 1e-2) if n.all() else np.array([0.0, 0.0, np.log(
            (self.prior + 1e-9) / (1 - self.prior + 1e-9))])

    def _signs(self, at: np.ndarray, cosines: np.ndarray) -> tuple[float, float, float]:
        """What is calibrated: the log odds of the vote, how near the nearest are, and a constant."""
        if not len(at):
            return 0.0, 0.0, 1.0
        w = self.share[self.labels[at]] / (1.05 - cosines)
        vote = float((w * self.labels[at]).sum())
        rest = float((w * (1 - self.labels[at])).sum())
        pull = np.log((vote + 0.05 * w.mean()) / (rest + 0.05 * w.mean()))
        return float(pull), float(cosines[0] * np.sign(pull)), 1.0

    def score(self, texts: pa.Array) -> dict[str, pa.Array]:
        scores, examples, similar, words = [], [], [], []
        empty = float(sigmoid(np.array([0.0, 0.0, 1.0]) @ self.line))
        for ranges, term, count in term_counts(texts, self.terms):
            for i, j in zip(ranges[:-1], ranges[1:]):
                if i == j:
                    scores.append(empty)
                    examples.append([])
                    similar.append([])
                    words.append([])
                    continue
                t, w = term[i:j], vector(term[i:j], count[i:j], self.idf)
                at, cosines = self.index.nearest(t, w, self.k)
                scores.append(float(sigmoid(np.array(self._signs(at, cosines)) @ self.line)))
                examples.append(self.ids[at[:5]].tolist())
                similar.append(cosines[:5].tolist())
                words.append([self.names[x] for x in t[np.argsort(-w, kind="stable")[:5]]])
        return {"score": pa.array(scores, pa.float64()), "examples": pa.array(examples, pa.list_(pa.int64())),
                "similarities": pa.array(similar, pa.list_(pa.float64())), "terms": pa.array(words, pa.list_(pa.string()))}


def choose_terms(chosen: DataFrame) -> list[str]:
    """At most TERMS terms of the sample whose chi-squared with the label is significant (0.01 %, corrected for the
    number of terms looked at). Other terms bring strangers near each other, in long texts above all."""
    words = (chosen.select("doc_id", "label", F.explode(F.array_distinct(F.regexp_extract_all(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(r"[a-z\x{80}-\x{10FFFF}]+"), F.lit(0)))).alias("term")))
    totals = {0: 0, 1: 0} | {r[0]: r[1] for r in chosen.groupBy("label").agg(F.count(F.lit(1))).collect()}
    if not all(totals.values()):
        return []
    bad, fine = float(totals[1]), float(totals[0])
    both = (F.col("toxic") + F.col("plain")) / (bad + fine)
    table = (words.groupBy("term").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("plain"))
             .filter("toxic + plain >= 3")
             .withColumn("chi", F.pow(F.col("toxic") / bad - F.col("plain") / fine, 2)
                         / (both * (1 - both) + F.lit(1e-9)) * (bad * fine / (bad + fine)))).persist()
    try:
        limit = NormalDist().inv_cdf(1 - 0.00005 / max(1, table.count())) ** 2
        return sorted(r[0] for r in table.filter(F.col("chi") >= limit).orderBy(F.desc("chi"), "term").limit(TERMS).collect())
    finally:
        table.unpersist()


def learn(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS, k: int = NEIGHBOURS) -> Neighbours:
    """Fit on at most ``per_class`` labelled documents without and with the label; frequencies are of all ``docs``."""
    bounded_batches(docs.sparkSession)
    chosen, counts = sample(docs, labels, "toxic", per_class)
    chosen = chosen.persist()
    try:
        names = choose_terms(chosen)
        raw = "\n".join(names).encode()
        hashes = word_hashes(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), letters=True)[0]
        order = np.argsort(hashes)
        terms, names = hashes[order], [names[i] for i in order]
        n = len(terms)

        def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found, docs_seen = np.zeros(n, np.int64), 0
            for batch in batches:
                docs_seen += batch.num_rows
                for _, term, _ in term_counts(batch.column(0), terms):
                    found += np.bincount(term, minlength=n)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, n)), pa.array(np.append(docs_seen, found))],
                                             names=["term", "df"])

        counted = {r[0]: r[1] for r in docs.select("text").mapInArrow(frequencies, "term BIGINT, df BIGINT")
                   .groupBy("term").agg(F.sum("df")).collect()}
        df = np.array([counted.get(i, 0) for i in range(n)], dtype=float)
        idf = np.log((1 + counted.get(-1, 0)) / (1 + df)) + 1e-3

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                t, c = [], []
                for ranges, term, count in term_counts(batch.column(1), terms):
                    for i, j in zip(ranges[:-1], ranges[1:]):
                        t.append(term[i:j].tolist())
                        c.append(count[i:j].tolist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(t, pa.list_(pa.int64())), pa.array(c, pa.list_(pa.int64()))],
                    names=["doc_id", "label", "t", "c"])

        rows = sorted(chosen.mapInArrow(vectors, "doc_id BIGINT, label INT, t ARRAY<BIGINT>, c ARRAY<BIGINT>").collect())
    finally:
        chosen.unpersist()
    made = [(np.array(r["t"], np.int64), vector(np.array(r["t"], np.int64), np.array(r["c"], float), idf)) for r in rows]
    return Neighbours(terms, names, idf, [r["doc_id"] for r in rows], [r["label"] for r in rows], made, counts, k)


def score_toxicity(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = PER_CLASS,
                   k: int = NEIGHBOURS) -> DataFrame:
    """``docs`` with held_out, score (0 to 1), predicted (1 where the score is 0.7 or more) and the evidence:
    the nearest examples, their similarities, and the document's heaviest terms.

    A text without terms of the examples, a NULL text among them, gets what the calibration says of no
    neighbours. Every row is scored by itself; columns of these names are replaced, all others stay. Labels
    that are NULL, contradict each other, or name no document are not used; without labels of both classes
    the score is the share of toxic labels.
    """
    names = ["held_out", "score", "predicted", "examples", "similarities", "terms"]
    kept = docs.drop(*names)
    model = learn(docs, labels, per_class, k)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by TERMS and per_class
    added = StructType([StructField("score", DoubleType()), StructField("examples", ArrayType(LongType())),
                        StructField("similarities", ArrayType(DoubleType())), StructField("terms", ArrayType(StringType()))])
    out = scored(kept, lambda texts: shared.value.score(texts), added)
    return (out.withColumn("held_out", held_out()).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
            .select(*[F.col(f"`{c}`") for c in kept.columns], *names))
