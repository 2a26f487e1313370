"""Whitening directions of embeddings through a bidiagonal qd solver.

The centred rows are never multiplied into a covariance: QR factorisations of blocks of rows, joined in a tree of
Spark tasks, leave one triangle R of the size of a vector squared. On it a Householder bidiagonalisation, dqds
(singular values to high relative accuracy) and twisted factorisations (their vectors) give the directions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from weblens.llm.common import fresh, staged

EPS = float(np.finfo(float).eps)
FAN = 16  # triangles one task joins
LONG = 2 ** 63


# --- singular values and vectors of a bidiagonal matrix ------------------------------------------

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, p): r = q B p' with B upper bidiagonal, a its diagonal and b the one above; p is orthogonal."""
    r = np.array(r, dtype=float)
    n = r.shape[1]
    p = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        norm = np.linalg.norm(x)
        if norm == 0 or not np.any(x[1:]):
            return None
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for i in range(n):
        v = reflector(r[i:, i])
        if v is not None:
            r[i:, i:] -= 2 * np.outer(v, v @ r[i:, i:])
        if i + 2 < n:
            v = reflector(r[i, i + 1:])
            if v is not None:
                r[i:, i + 1:] -= 2 * np.outer(r[i:, i + 1:] @ v, v)
                p[:, i + 1:] -= 2 * np.outer(p[:, i + 1:] @ v, v)
    return np.diag(r).copy(), np.diag(r, 1).copy(), p


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One differential qd transform with shift: (q, e, last d, whether all d before the last stayed positive)."""
    n, d = len(q), q[0] - shift
    new_q, new_e = [0.0] * n, [0.0] * (n - 1)
    for k in range(n - 1):
        if d < 0:
            return new_q, new_e, d, False
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e[k] = e[k] * ratio
        d = d * ratio - shift if new_q[k] else q[k + 1] - shift
    new_q[-1] = d
    return new_q, new_e, d, True


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the upper bidiagonal matrix with diagonal a and b above it.

    A shift that proves too large (a negative d) is replaced by what that d suggests, by a quarter, then by none.
    """
    scale = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if scale == 0:
        return np.zeros(len(a))
    tolerance = (8 * EPS) ** 2
    blocks = [([float(x) ** 2 for x in a / scale], [float(x) ** 2 for x in b / scale], 0.0)]
    values: list[float] = []
    for _ in range(400 * len(a) + 400):
        if not blocks:
            break
        q, e, moved = blocks.pop()
        while len(q) > 1 and e[-1] <= tolerance * (moved + q[-1]):
            values.append(q.pop() + moved)
            e.pop()
        if len(q) == 1:
            values.append(q[0] + moved)
            continue
        cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tolerance * min(q[k], q[k + 1]) or e[k] <= EPS ** 2 * moved), None)
        if cut is not None:
            blocks += [(q[:cut + 1], e[:cut], moved), (q[cut + 1:], e[cut + 1:], moved)]
            continue
        if 1.5 * q[0] < q[-1]:  # graded the wrong way round: the reversed matrix has the same singular values
            q, e = q[::-1], e[::-1]
        if min(q) == 0:
            shift = 0.0
        else:  # the smaller eigenvalue of the last 2 x 2 block
            x, y, z = q[-2] + (e[-2] if len(e) > 1 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
            half = (x - z) / 2
            shift = max(0.0, z - y / (abs(half) + float(np.hypot(half, np.sqrt(y)))) if half >= 0 else
                        x - y / (abs(half) + float(np.hypot(half, np.sqrt(y)))))
        for attempt in range(4):
            new_q, new_e, last, inside = _dqds_step(q, e, shift)
            if inside and last >= 0:
                break
            shift = max(0.0, shift + last) if inside and attempt == 0 else shift / 4 if attempt < 2 else 0.0
        blocks.append((new_q, new_e, moved + shift))
    else:
        raise ArithmeticError("dqds did not converge")
    return np.sort(np.array(values))[::-1] * scale ** 2


def _twisted(q: np.ndarray, e: np.ndarray, off: np.ndarray, value: float, taken: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """(vector, step of the Rayleigh quotient): the twisted factorisation of B'B - value at the index with the least pivot, weighed by
    what the vectors of the same cluster leave there."""
    n, tiny = len(q), EPS * max(value, float(q.max())) * EPS
    plus, s = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n):
        plus[i] = q[i] + s[i]
        if plus[i] == 0:
            plus[i] = -tiny
        if i + 1 < n:
            s[i + 1] = e[i] * s[i] / plus[i] - value
    minus, p = np.zeros(n), np.zeros(n)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        minus[i + 1] = e[i] + p[i + 1]
        if minus[i + 1] == 0:
            minus[i + 1] = -tiny
        p[i] = p[i + 1] * q[i] / minus[i + 1] - value
    pivots = s + p + value
    free = np.maximum(EPS, 1 - sum((v * v for v in taken), np.zeros(n)))
    r = int(np.argmin(np.abs(pivots) / free))
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -off[i] / plus[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -off[i] / minus[i + 1] * z[i]
        if abs(z[i + 1]) > 1e150:
            z /= abs(z[i + 1])
    norm = float(np.linalg.norm(z))
    return z / norm, float(pivots[r]) * (float(z[r]) / norm) ** 2


def singular_pairs(a: np.ndarray, b: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest squared singular values of the bidiagonal matrix, and their right vectors as columns."""
    n = len(a)
    b = np.where(np.abs(b) <= EPS * (np.abs(a[:-1]) + np.abs(a[1:])), 0.0, b)
    found: list[tuple[float, np.ndarray]] = []
    edges = [0, *(np.flatnonzero(b == 0) + 1).tolist(), n]
    for low, high in zip(edges, edges[1:]):
        aa, bb = a[low:high], b[low:high - 1]
        q, e, off = aa * aa, bb * bb, aa[:-1] * bb
        mine: list[tuple[float, np.ndarray]] = []
        for value in dqds(aa, bb)[:k]:
            close = [v for w, v in mine if w - value <= 1e-3 * w]
            if len(aa) == 1:
                z = np.ones(1)
            else:
                at = value
                for _ in range(3):
                    z, step = _twisted(q, e, off, at, close)
                    if close or abs(step) <= 2 * EPS * value or abs(step) > 1e-8 * value:
                        break
                    at += step
                for _ in range(3 if close else 0):
                    for v in close:
                        z = z - (v @ z) * v
                    if np.linalg.norm(z) < 1e-6:  # all of it was in the cluster's other vectors: start where they are least
                        z = np.zeros(len(aa))
                        z[np.argmin(sum(v * v for v in close))] = 1
                    z /= np.linalg.norm(z)
            mine.append((float(value), z))
        for value, z in mine:
            full = np.zeros(n)
            full[low:high] = z
            found.append((value, full))
    found.sort(key=lambda pair: -pair[0])
    return np.array([w for w, _ in found[:k]]), np.array([v for _, v in found[:k]]).T.reshape(n, -1)


# --- the fit on Spark ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """n distinct vectors with sums ``sums``; ``directions`` (columns), eigenvalues ``variances`` and their ``total``."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    total: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exactly: as int64 where that holds it, else as Python integers."""
        most = max(map(abs, self.sums), default=0) + self.n * int(np.abs(x.astype(object)).max(initial=0) if _wide(x) else np.abs(x).max(initial=0))
        if most < LONG:
            return x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """x - mean, projected on the directions, over the square roots of the variances."""
        centred = self.deviations(x).astype(float) / self.n
        return centred @ self.directions / np.sqrt(self.variances)


def _wide(x: np.ndarray) -> bool:
    return bool((x == -LONG).any())


def whole(column: Column | str) -> Column:
    """floor(256 * c) of every entry, as BIGINT; beyond its range the nearest BIGINT."""
    return F.transform(column, lambda c: F.floor(F.lit(256.0) * c.cast("double")))


def usable(column: Column | str) -> Column:
    """Whether the vector has entries, all of them finite."""
    finite = F.forall(column, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce((F.size(column) > 0) & finite, F.lit(False))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _row_blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[np.ndarray]:
    """Rows of the only column in blocks of some four times as many rows as columns, at most."""
    rows = max(256, 4 * d)
    for batch in batches:
        x = _matrix(batch.column(0), d)
        for k in range(0, len(x), rows):
            yield x[k:k + rows]


def _joined(parts: DataFrame, join: Callable[[list[bytes]], bytes], label: str) -> bytes | None:
    """One value from (part INT, value BINARY) of every task: FAN values meet in a task, level after level."""
    parts = staged(parts, label)
    count = parts.count()
    while count > 1:
        parts = staged(parts.groupBy((F.col("part") / FAN).cast("int").alias("part")).applyInPandas(
            lambda df: df.iloc[:1].assign(value=[join(list(df.sort_values("part", kind="stable")["value"]))]), parts.schema), label)
        count = parts.count()
    row = parts.first()
    return bytes(row["value"]) if row else None


def _per_task(df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], bytes | None]) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = fold(batches)
        if value is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              "value": pa.array([value], pa.binary())})
    return df.mapInArrow(each, "part INT, value BINARY")


def _sums(fit: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    """Rows, and the exact sum of every dimension."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, dtype=object)
        for x in _row_blocks(batches, d):
            n += len(x)
            small = not _wide(x) and int(np.abs(x).max(initial=0)) < LONG // (len(x) + 1)
            total = total + (x.sum(axis=0) if small else x.astype(object).sum(axis=0)).astype(object)
        yield pa.RecordBatch.from_pydict({
            "place": pa.array(range(d), pa.int32()), "rows": pa.array([n] * d, pa.int64()),
            "total": pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))})
    sums = (fit.mapInArrow(each, "place INT, rows BIGINT, total DECIMAL(38,0)").groupBy("place")
            .agg(F.sum("rows").alias("rows"), F.sum("total").alias("total")).orderBy("place").collect())
    return sums[0]["rows"], tuple(int(r["total"]) for r in sums)


def _triangle(fit: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of the QR factorisation of the centred rows, square."""
    d = len(sums)
    centre = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)

    def square(r: np.ndarray) -> np.ndarray:
        return np.vstack([r, np.zeros((d - len(r), d))])

    def fold(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        r = None
        for x in _row_blocks(batches, d):
            centred = centre.deviations(x).astype(float) / n
            r = np.linalg.qr(centred if r is None else np.vstack([r, centred]), mode="r")
        return None if r is None else square(r).tobytes()

    def join(values: list[bytes]) -> bytes:
        return square(np.linalg.qr(np.vstack([np.frombuffer(v).reshape(d, d) for v in values]), mode="r")).tobytes()

    return np.frombuffer(_joined(_per_task(fit, fold), join, "triangles")).reshape(d, d)


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    d, k = len(model.sums), len(model.variances)

    def merged(x: tuple, y: tuple) -> tuple:
        n = x[0] + y[0]
        step = y[1] - x[1]
        return n, x[1] + step * (y[0] / n), x[2] + y[2] + np.outer(step, step) * (x[0] * y[0] / n)

    def packed(x: tuple) -> bytes:
        return np.concatenate([[float(x[0])], x[1], x[2].ravel()]).tobytes()

    def unpacked(value: bytes) -> tuple:
        v = np.frombuffer(value)
        return v[0], v[1:1 + k], v[1 + k:].reshape(k, k)

    def fold(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        seen = None
        for x in _row_blocks(batches, d):
            w = model.whiten(x)
            mean = w.mean(axis=0)
            here = (float(len(w)), mean, (w - mean).T @ (w - mean))
            seen = here if seen is None else merged(seen, here)
        return None if seen is None else packed(seen)

    def join(values: list[bytes]) -> bytes:
        seen = unpacked(values[0])
        for v in values[1:]:
            seen = merged(seen, unpacked(v))
        return packed(seen)

    n, _, products = unpacked(_joined(_per_task(fit, fold), join, "covariance"))
    return float(np.abs(products / n - np.eye(k)).max(initial=0))


def fit_whitening(fit: DataFrame, components: int) -> Whitening:
    """The model of a staged list of distinct vectors (one column, ARRAY<BIGINT>, all of one length, at least one row).

    The driver sees one triangle, the size of a vector squared. Directions are unit vectors whose largest entry by
    size is positive; those without variance, up to rounding, are left out.
    """
    d = fit.select(F.size(fit.columns[0])).first()[0]
    n, sums = _sums(fit, d)
    r = _triangle(fit, n, sums)
    a, b, p = bidiagonalise(r)
    values, vectors = singular_pairs(a, b, min(components, d))
    keep = values > values.max(initial=0) * (EPS * max(d, 8)) ** 2
    directions = p @ vectors[:, keep]
    lead = directions[np.argmax(np.abs(directions), axis=0), np.arange(directions.shape[1])]
    return Whitening(n, sums, directions * np.sign(lead), values[keep] / n, float((r * r).sum()) / n)


def whitened_components(vectors: DataFrame, components: int = 4, column: str = "embedding") -> DataFrame:
    """Every row with a usable vector once per component: its columns but the vector, and component, n, deviation,
    whitened, explained, identity_error (these replace columns of the same names).

    The model is fitted on the distinct vectors floor(256 c). Vectors that are NULL, empty, or hold NULL or non-finite
    entries are dropped, and so are those of another length than the most frequent one (ties: the shorter). Repeated
    rows and ids keep their rows. Components without variance are not returned: no row for an empty table or one
    distinct vector. A deviation beyond BIGINT is NULL.
    """
    spark = vectors.sparkSession
    added = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = fresh(vectors, "_x")
    vec = F.col(f"`{column}`")
    kept = [f for f in vectors.schema.fields if f.name != column and f.name.lower() not in added]
    schema = StructType(kept + StructType.fromDDL("component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE").fields)
    good = vectors.filter(usable(vec))
    length = good.groupBy(F.size(vec).alias("length")).count().orderBy(F.desc("count"), "length").first()
    if length is None:
        return spark.createDataFrame([], schema)
    d = length["length"]
    good = good.filter(F.size(vec) == d).select(*[F.col(f"`{f.name}`") for f in kept], whole(vec).alias(x))
    fit = staged(good.select(x).distinct(), "fit_list")
    model = fit_whitening(fit, components)
    k = len(model.variances)
    if k == 0:
        return spark.createDataFrame([], schema)
    error = _identity_error(fit, model)
    explained = model.variances / model.total

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch.column(batch.num_columns - 1), d)
            m = len(rows)
            off = model.deviations(rows)
            wide = off.dtype == object or d * int(np.abs(off).max(initial=0)) ** 2 >= LONG
            exact = (off.astype(object) ** 2).sum(axis=1) if wide else (off * off).sum(axis=1)
            deviation = pa.array([int(v) if v < LONG else None for v in exact.tolist()], pa.int64())
            again = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(again) for i in range(batch.num_columns - 1)],
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n, dtype=np.int64)),
                 deviation.take(again), pa.array(model.whiten(rows).ravel()), pa.array(np.tile(explained, m)),
                 pa.array(np.full(m * k, error))], schema.names)

    return good.mapInArrow(each, schema)
