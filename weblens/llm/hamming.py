"""Exact nearest binary codes by incremental multi-index hashing, on an index that is spread over tasks.

A code is cut into segments, about as long as the logarithm of the number of codes. Two codes that agree within r in
no segment are at least m (r + 1) apart, so queries look up segment values at growing radii, verify what they find,
and leave the search as soon as their k-th distance is below that.

The index is a table of (segment, first bits of its value): a piece of it is what one task holds, and pieces of
many codes are cut again by hash. In every round a query goes to the pieces whose first bits are within the radius
of its own; what a piece finds is new, as a code belongs to the first of its segments that is nearest to the query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from weblens.llm.common import released, staged

CODES = 16384
RADII = 2  # of a round, which moves the index once
_U = np.uint64


def sign_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id and ``code``: bit i of the 64-bit number is set where component i is above zero.

    Components beyond 64 are folded in by parity (bit i mod 64 counts them all); missing ones are 0, NULL and NaN
    ones too; a NULL vector has no code and is left out, and so is a row without vec_id.
    """
    bits = F.transform("embedding", lambda x, i: F.when(
        (x > 0) & ~F.isnan(x), F.get(_powers(), F.pmod(i, F.lit(64))))
        .otherwise(F.lit(0).cast("bigint")))
    code = F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseXOR(x))
    return (embeddings.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
            .select("vec_id", code.alias("code")))


def _powers():
    return F.array(*[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("bigint") for i in range(64)])


@lru_cache(maxsize=256)
def _ring(bits: int, radius: int) -> np.ndarray:
    """Numbers of ``bits`` bits with ``radius`` bits set."""
    return np.array([sum(1 << b for b in chosen) for chosen in combinations(range(bits), radius)], dtype=_U)


class Segments:
    """How codes of 64 bits are cut for ``count`` of them: segments as (first bit, bits), and the bits of a value
    that name its piece, so many that a piece has about ``per_piece`` codes."""

    def __init__(self, count: int, per_piece: int):
        many = min(16, max(2, round(64 / math.log2(max(16, count)))))
        ends = [64 * s // many for s in range(many + 1)]
        self.at = [(a, b - a) for a, b in zip(ends, ends[1:])]
        self.first = min(max(0, math.ceil(math.log2(max(1, count) / per_piece))), min(b for _, b in self.at))
        self.deepest = max(b for _, b in self.at)

    def values(self, codes: np.ndarray, segment: int) -> np.ndarray:
        start, bits = self.at[segment]
        return codes >> _U(start) & _U((1 << bits) - 1)

    def places(self, codes: np.ndarray, segment: int) -> np.ndarray:
        """The piece of each code in the index of ``segment``, before it is cut by hash."""
        return (self.values(codes, segment) >> _U(self.at[segment][1] - self.first)).astype(np.int64) << 4 | segment


class Piece:
    """Codes whose values of one segment have the same first bits, sorted by that value."""

    def __init__(self, segments: Segments, place: int, codes: np.ndarray):
        self.segments, self.segment = segments, place & 15
        self.low = segments.at[self.segment][1] - segments.first
        self.start = _U((place >> 4) << self.low)
        values = segments.values(codes, self.segment)
        self.order = np.argsort(values, kind="stable")
        self.codes, self.values = codes[self.order], values[self.order]

    def _near(self, value: np.uint64, radius: int) -> np.ndarray:
        """Rows whose value of the segment differs from ``value`` in ``radius`` bits."""
        rest = radius - int(np.bitwise_count((value ^ self.start) >> _U(self.low)))
        if rest < 0 or rest > self.low:
            return np.zeros(0, np.int64)
        if math.comb(self.low, rest) * 16 > len(self.values):
            return np.flatnonzero(np.bitwise_count(self.values ^ value) == radius)
        ring = self.start | ((value & _U((1 << self.low) - 1)) ^ _ring(self.low, rest))
        first, last = (np.searchsorted(self.values, ring, side) for side in ("left", "right"))
        some = last > first
        first, lengths = first[some], (last - first)[some]
        return np.arange(int(lengths.sum())) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)

    def search(self, code: np.uint64, radius: int, bound: int) -> tuple[np.ndarray, np.ndarray]:
        """(places among the codes given, distances) of the codes within ``bound`` of ``code`` whose nearest segment,
        the first of several, is this one, in ``radius`` bits."""
        at = self._near(self.segments.values(code, self.segment), radius)
        apart = self.codes[at] ^ code
        new = np.bitwise_count(apart) <= bound
        for s in range(len(self.segments.at)):
            if s != self.segment:
                new &= np.bitwise_count(self.segments.values(apart, s)) >= radius + (s < self.segment)
        return self.order[at[new]], np.bitwise_count(apart[new]).astype(np.int64)


def _places(codes: DataFrame, segments: Segments, radius: int) -> DataFrame:
    """A row of ``codes`` (code, ...) for every piece whose first bits are within ``radius`` of its own, in each
    segment, with the number of the piece as ``place``."""
    schema = StructType([*codes.schema.fields, StructField("place", LongType())])
    names = schema.names

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = np.arange(1 << segments.first)
        masks = masks[np.bitwise_count(masks) <= radius] << 4
        step = max(1, 200_000 // len(masks))
        for batch in batches:
            for part in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                values = np.asarray(part.column("code")).view(_U)
                for s in range(len(segments.at)):
                    places = segments.places(values, s)[:, None] ^ masks
                    rows = part.take(pa.array(np.repeat(np.arange(len(values)), len(masks))))
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(places.reshape(-1))], names=names)

    return codes.mapInArrow(spread, schema)


def _looked_up(index: DataFrame, asked: DataFrame, segments: Segments, radii: range, k: int) -> DataFrame:
    """query, code, least, copies, distance: what the pieces of ``index`` (place, salt, code, least, copies) find at
    ``radii`` for ``asked`` (place, salt, code, bound); of a piece, no more codes than can be among the ``k`` nearest."""
    rows = (index.select("place", "salt", F.lit(0).alias("kind"), "code", "least", "copies")
            .union(asked.select("place", "salt", F.lit(1), "code", F.lit(None).cast("bigint"), "bound")))
    names = ["query", "code", "least", "copies", "distance"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        piece, now = None, None
        for batch in batches:
            place, salt, kind, codes, least, copies = (np.asarray(c.fill_null(0)) for c in batch.columns)
            new = (place[1:] != place[:-1]) | (salt[1:] != salt[:-1]) | (kind[1:] != kind[:-1])
            cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(place)]
            out: list[tuple] = []
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if (place[i], salt[i]) != now:
                    now, held, piece = (place[i], salt[i]), [], None
                if not kind[i]:
                    held.append((codes[i:j].view(_U).copy(), least[i:j].copy(), copies[i:j].copy()))
                    continue
                if not held:
                    continue
                if piece is None:
                    all_codes, all_least, all_copies = (np.concatenate(c) for c in zip(*held))
                    piece = Piece(segments, int(place[i]), all_codes)
                for code, bound in zip(codes[i:j].view(_U), copies[i:j]):
                    at, distances = (np.concatenate(x) for x in zip(*(piece.search(code, radius, bound) for radius in radii)))
                    if len(at) > k:
                        best = np.lexsort((all_least[at], distances))[:k]
                        at, distances = at[best], distances[best]
                    if len(at):
                        out.append((np.full(len(at), code), all_codes[at], all_least[at], all_copies[at], distances))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64, casting="unsafe")) for c in zip(*out)],
                                                 names=names)

    return (rows.repartition("place", "salt").sortWithinPartitions("place", "salt", "kind")
            .mapInArrow(search, ", ".join(f"{n} BIGINT" for n in names)))


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int, per_piece: int = CODES) -> DataFrame:
    """query_id, rank (from 1), vec_id, distance: the ``k`` codes nearest to each query by (distance, vec_id).

    ``codes`` and ``queries`` have vec_id and code (BIGINT). A query that is itself among the codes finds
    itself. Codes with one vec_id count each, equal queries once; rows without vec_id or code are left
    out; with fewer than ``k`` codes all are returned; without codes or queries there are no rows. Equal codes are searched once, by
    queries and in the index, and of each its ``k`` smallest vec_ids can be among the answers.
    """
    of_code = Window.partitionBy("code").orderBy("vec_id")
    rows = staged(codes.filter("vec_id IS NOT NULL AND code IS NOT NULL").select("code", "vec_id").withColumn("_at", F.row_number().over(of_code))
                  .filter(F.col("_at") <= k), "codes")
    distinct = staged(rows.groupBy("code").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies")), "distinct")
    count, total = distinct.agg(F.count(F.lit(1)), F.coalesce(F.sum("copies"), F.lit(0))).first()
    asks = staged(queries.filter("vec_id IS NOT NULL AND code IS NOT NULL").select("vec_id", "code").distinct(), "queries")
    segments, wanted = Segments(count, per_piece), min(k, total)

    # Pieces of more codes than a task should hold are cut by hash; a query then asks every part.
    placed = staged(_places(distinct, segments, 0), "placed")
    parts = staged(placed.groupBy("place").agg(F.ceil(F.count(F.lit(1)) / per_piece).alias("parts"))
                   .select(F.col("place").alias("_place"), "parts"), "pieces")
    index = staged(placed.join(parts, F.col("place") == F.col("_place"))
                   .select("place", F.pmod(F.xxhash64("code"), "parts").alias("salt"), "code", "least", "copies"), "index")
    released(placed)

    left = staged(asks.select("code").filter(F.lit(total > 0)).distinct().withColumn("bound", F.lit(64).cast("bigint")), "open")
    nearest = Window.partitionBy("query").orderBy("distance", "least")
    before = nearest.rowsBetween(Window.unboundedPreceding, -1)
    best = None
    for first in range(0, segments.deepest + 1, RADII):
        radius = first + RADII - 1
        asked = (_places(left, segments, radius).join(parts, F.col("place") == F.col("_place"))
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))))
        found = _looked_up(index, asked, segments, range(first, radius + 1), k)
        found = found if best is None else found.union(best)
        now = staged(found.withColumn("_at", F.row_number().over(nearest)).filter(F.col("_at") <= k)
                     .withColumn("_before", F.coalesce(F.sum("copies").over(before), F.lit(0))).filter(F.col("_before") < wanted)
                     .drop("_at", "_before"), "nearest")
        # Codes not seen yet differ by more than the radius in every segment.
        ends = (now.groupBy("query").agg(F.max("distance").alias("_far"), F.sum("copies").alias("_copies"))
                .select(F.col("query").alias("_of"), F.when(F.col("_copies") >= wanted, F.col("_far")).alias("_far"), "_copies"))
        still = staged(left.select("code").join(ends, F.col("code") == F.col("_of"), "left")
                       .filter(F.coalesce("_copies", F.lit(0)) < total)
                       .select("code", F.coalesce("_far", F.lit(64).cast("bigint")).alias("bound"))
                       .filter(F.col("bound") >= len(segments.at) * (radius + 1)), "open")
        released(left, *([best] if best is not None else []))
        best, left = now, still
        if left.isEmpty():
            break
    answers = best.groupBy("query").agg(F.collect_list(F.struct("code", "distance")).alias("found"))
    near = (answers.select("query", F.inline("found")).join(rows.select(F.col("code").alias("_code"), "vec_id", "_at"), F.col("code") == F.col("_code"))
            .withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy("distance", "vec_id", "_at"))).filter(F.col("rank") <= k)
            .groupBy("query").agg(F.collect_list(F.struct("rank", "vec_id", "distance")).alias("near")))
    return (asks.select(F.col("vec_id").alias("query_id"), "code").join(near, F.col("code") == F.col("query"))
            .select("query_id", F.inline("near")))
