"""Packing token sequences as a cutting-stock problem, by column generation.

Documents are cut into full pieces and a rest. Pieces are counted by length, short ones exactly and longer ones in
classes of ``unit`` tokens, which bounds both linear programs whatever the number of documents. Patterns (how many
pieces of each class share a sequence) are priced by a knapsack over the dual values until none improves, rounded
down, and the few pieces left over are packed best fit. A piece finds its place by its rank in its class: how many
it is among those of its file, after those of the files before. So no group of pieces meets in a task, and the ids
move once, to their sequence.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from weblens.llm.common import staged
from weblens.llm.tokens import encoder

CAPACITY = 2048
UNIT = 8
SHORT = 128  # lengths up to this are classes of their own

# Rows (file, class) that may be broadcast: some 40 MB; more are joined by shuffle.
BROADCAST_COUNTS = 500_000


def price(duals: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The pattern of the highest value within ``capacity``: an unbounded knapsack by dynamic programming."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        fits = sizes <= room
        gain = value[room - sizes[fits]] + duals[fits]
        if len(gain):
            k = int(gain.argmax())
            if gain[k] > value[room] + 1e-12:
                value[room], choice[room] = gain[k], np.flatnonzero(fits)[k]
    pattern, room = np.zeros(len(sizes), dtype=np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(value[capacity]), pattern


def relaxed(sizes: np.ndarray, demand: np.ndarray, capacity: int, most_columns: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, how often each): a basic solution of the linear program that covers ``demand``
    with the fewest sequences. ``most_columns`` bounds the pivots; stopping there is feasible, only less tight."""
    columns = np.diag(capacity // sizes).astype(np.int64)
    inverse = np.diag(1.0 / np.diag(columns))
    amount = inverse @ demand
    for _ in range(most_columns):
        value, pattern = price(np.maximum(inverse.sum(axis=0), 0), sizes, capacity)
        if value <= 1 + 1e-9:
            break
        direction = inverse @ pattern
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        leaves = int(ratio.argmin())
        columns[:, leaves] = pattern
        row = inverse[leaves] / direction[leaves]
        inverse = inverse - np.outer(direction, row)
        inverse[leaves] = row
        amount = np.maximum(inverse @ demand, 0)
    return columns, amount


def best_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[np.ndarray]:
    """Patterns that pack the remaining pieces, largest first, each into the fullest sequence with room."""
    bins, room = [], np.zeros(0, dtype=np.int64)
    for k in np.argsort(-sizes):
        for _ in range(int(left[k])):
            fits = np.flatnonzero(room >= sizes[k])
            if len(fits):
                b = int(fits[room[fits].argmin()])
            else:
                b = len(bins)
                bins.append(np.zeros(len(sizes), dtype=np.int64))
                room = np.append(room, capacity)
            bins[b][k] += 1
            room[b] -= sizes[k]
    return bins


def patterns(histogram: dict[int, int], capacity: int, most_columns: int = 20_000) -> list[tuple[int, dict[int, int]]]:
    """(number of sequences, {class: pieces}) that together hold exactly the pieces of ``histogram``.

    Rounding down leaves less than a sequence of each basic pattern, so what best fit packs is bounded by the
    number of classes times the pieces in a sequence.
    """
    sizes = np.array(sorted(k for k, n in histogram.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(k)] for k in sizes], dtype=np.int64)
    columns, amount = relaxed(sizes, demand.astype(float), capacity, most_columns)
    plan, left = [], demand.copy()
    for j in np.argsort(-(amount - np.floor(amount))):
        used = columns[:, j]
        if not used.any():
            continue
        # What degenerate bases overshoot is cut off by what is left.
        times = min(int(np.floor(amount[j] + 1e-9)), int((left[used > 0] // used[used > 0]).min()))
        if times:
            plan.append((times, used.copy()))
            left -= times * used
    for j in np.argsort(-(amount - np.floor(amount))):  # round a pattern up where all its pieces are there
        used = columns[:, j]
        if used.any() and (used <= left).all() and used @ sizes == capacity:
            plan.append((1, used.copy()))
            left -= used
    plan += [(1, used) for used in best_fit(sizes, left, capacity)]
    return [(n, {int(sizes[k]): int(used[k]) for k in np.flatnonzero(used)}) for n, used in plan]


def id_width(tokenizer: str) -> int:
    """Bytes that hold any id of the vocabulary: 2 or 4."""
    return 2 if encoder(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, unit: int, width: int) -> DataFrame:
    """doc_id, start, length, doc_tokens, ids (little-endian, ``width`` bytes each) of the pieces of every whole text of
    ``docs``; class, part (the task) and local (how many pieces of the class the task had before)."""
    names = ["doc_id", "start", "length", "doc_tokens"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, seen = encoder(tokenizer), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: list[list] = [[] for _ in range(8)]
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1), end_id)):
                packed = ids.astype(f"<u{width}")
                for start in range(0, len(ids), capacity):
                    length = min(capacity, len(ids) - start)
                    kind = length if length <= SHORT else SHORT - (-length // unit)
                    for out, x in zip(rows, (doc_id, start, length, len(ids), packed[start:start + length].tobytes(), kind, part, seen[kind])):
                        out.append(x)
                    seen[kind] += 1
            kinds = [*[pa.int64()] * 4, pa.binary(), pa.int32(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], names=[*names, "ids", "class", "part", "local"])

    schema = ", ".join(f"{n} BIGINT" for n in names) + ", ids BINARY, class INT, part INT, local BIGINT"
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def _slots(histogram: dict[int, int], capacity: int, unit: int) -> list[tuple[int, int, int, int, int]]:
    """(class, first rank, rank behind the last, pieces in a sequence, first sequence): where the ranks of a class go.

    At most classes x patterns rows, whatever the number of documents."""
    short = {k: n for k, n in histogram.items() if k <= SHORT}
    wide = {k - SHORT: n for k, n in histogram.items() if k > SHORT}
    plan = patterns(short, capacity)
    plan += [(n, {k + SHORT: m for k, m in used.items()}) for n, used in patterns(wide, capacity // unit)]
    slots, base, given = [], 0, dict.fromkeys(histogram, 0)
    for times, used in plan:
        for k, n in used.items():
            slots.append((k, given[k], given[k] + times * n, n, base))
            given[k] += times * n
        base += times
    if given != histogram:
        raise RuntimeError("patterns do not hold the pieces")
    return slots


def _sequences(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, unit: int, width: int) -> DataFrame:
    spark = docs.sparkSession
    pieces = staged(token_pieces(docs, tokenizer, end_id, capacity, unit, width), "pieces")
    counts = staged(pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("class").agg(F.sum("n")).collect()}
    table = spark.createDataFrame(_slots(histogram, capacity, unit), "_of INT, _from BIGINT, _to BIGINT, _each BIGINT, _base BIGINT")
    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "class", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    if counts.count() <= BROADCAST_COUNTS:
        before = F.broadcast(before)
    rank = F.col("_before") + F.col("local")
    placed = (pieces.join(before, ["part", "class"]).withColumn("_rank", rank)
              .join(F.broadcast(table), (F.col("class") == F.col("_of")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))
              .withColumn("sequence_id", F.expr("_base + (_rank - _from) div _each")))
    inside = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "class", "_rank")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.select("doc_id", "start", "length", "doc_tokens", "sequence_id",
                         F.coalesce(F.sum("length").over(inside), F.lit(0)).cast("bigint").alias("offset"), "ids")


def pack_sequences(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   unit: int = UNIT) -> DataFrame:
    """A row per piece of ``docs`` (doc_id, text), with its ids.

    doc_id, start, length, doc_tokens, sequence_id (gapless from 0), offset, ids. Rows of a sequence lie in one
    partition in order of their offset. A NULL or empty text is one piece of the end id; rows with one doc_id are packed
    each by itself; a NULL doc_id stays NULL; no rows give no rows; columns other than doc_id and text are left.
    """
    width = id_width(tokenizer)

    def widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, ids = batch.columns
            flat = np.frombuffer(b"".join(ids.to_pylist()), dtype=f"<u{width}").astype(np.int32)
            ends = np.concatenate([[0], np.cumsum(rest[2].to_numpy())]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=batch.schema.names)

    return _sequences(docs, tokenizer, end_id, capacity, unit, width).mapInArrow(
        widened, "doc_id BIGINT, start BIGINT, length BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT, ids ARRAY<INT>")


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY,
                   unit: int = UNIT) -> DataFrame:
    """The rows of ``pack_sequences`` with the digest of each piece's ids instead of them: doc_id, start,
    length, ids_crc32, doc_tokens, sequence_id, offset."""
    width = id_width(tokenizer)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, ids = batch.columns
            sums = [zlib.crc32(np.frombuffer(x, dtype=f"<u{width}").astype("<u4").tobytes()) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([*rest[:3], pa.array(sums, pa.int64()), *rest[3:]], names=names)

    return _sequences(docs, tokenizer, end_id, capacity, unit, width).mapInArrow(digest, ", ".join(f"{n} BIGINT" for n in names))
