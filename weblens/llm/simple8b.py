"""Token ids as 64-bit words in Simple-8b coding, in segments with a document index and block offsets.

A word holds a 4-bit selector and 60 bits: 60 ids of 1 bit, 30 of 2, ... 1 of 60. Selector 15 is an escape: the
word holds the number of an entry in the list of ids that need more than 60 bits. Blocks of 4096 ids begin
with a word of their own, at an offset that the segment lists. A segment is one row of a Parquet table,
which gives commits and any file store; it holds whole documents in order of doc_id:

    magic, number of documents, ids, blocks, words, escapes        6 x uint64
    doc_ids int64, NULL flags uint8, ids per document int64, word offset of each block int64,
    words uint64, escaped ids uint64, crc32 of everything before   (little-endian)
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weblens.llm.common import bounded_batches, partitions
from weblens.llm.tokens import encoder
from weblens.session import scratch_dir

MAGIC = 0x31423850494D4953
BLOCK = 4096
# Ids per word and bits per id of the selectors 1 to 14; the widest packing comes first.
COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 15
_U = np.uint64
_LIMITS = np.array([1 << int(b) for b in BITS], dtype=np.uint64)  # the first values that do not fit


def _later(largest: np.ndarray, by: int) -> np.ndarray:
    """The larger of each value and the one ``by`` places later in its block."""
    out = largest.copy()
    np.maximum(out[:, :-by], largest[:, by:], out=out[:, :-by])
    return out


def pack(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, word offset of each block, escaped ids) of unsigned 64-bit values.

    Every word takes as many of the next ids as fit, found for all positions at once by running maxima; the
    greedy chains of all blocks then advance together.
    """
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, _U)
    blocks = -(-n // block)
    grid = np.zeros((blocks, block), dtype=_U)
    grid.reshape(-1)[:n] = values
    valid = np.minimum(block, n - np.arange(blocks) * block)
    # need[i]: the narrowest selector for one id, counted from the widest packing; 14 is an escape.
    need = np.searchsorted(_LIMITS, grid.reshape(-1), side="right").astype(np.uint8).reshape(blocks, block)
    selector = np.full((blocks, block), ESCAPE, dtype=np.int8)
    widest = {1: need}  # the largest need among the next ids; past the end of a block none is needed
    size = 1
    while size < 32:
        widest[2 * size] = _later(widest[size], size)
        size *= 2
    for k in range(len(COUNTS) - 1, -1, -1):
        count = int(COUNTS[k])
        size = 1 << (count.bit_length() - 1)
        run = widest[size] if size == count else _later(widest[size], count - size)
        selector[run <= k] = k + 1
    step = np.ones(16, dtype=np.int64)
    step[1:15] = COUNTS
    chosen_at = np.zeros((blocks, block), dtype=bool)
    flat_selector, flat_chosen = selector.reshape(-1), chosen_at.reshape(-1)
    at, last = np.arange(blocks) * block, np.minimum(np.arange(1, blocks + 1) * block, n)
    while len(at):
        flat_chosen[at] = True
        at = at + step[flat_selector[at]]
        live = at < last
        if not live.all():
            at, last = at[live], last[live]
    where = np.flatnonzero(flat_chosen)
    chosen = flat_selector[where]
    words = chosen.astype(_U) << _U(60)
    padded = np.concatenate([grid.reshape(-1), np.zeros(60, dtype=_U)])
    limit = (where // block + 1) * block
    for k in range(len(COUNTS)):
        mine = np.flatnonzero(chosen == k + 1)
        if len(mine):
            word, source, end = words[mine], where[mine], limit[mine]
            for j in range(int(COUNTS[k])):
                value = padded[source + j]
                if int(COUNTS[k]) > 1:
                    value = np.where(source + j < end, value, _U(0))
                word |= value << _U(j * int(BITS[k]))
            words[mine] = word
    escapes = np.flatnonzero(chosen == ESCAPE)
    words[escapes] |= np.arange(len(escapes), dtype=_U)
    return words, np.searchsorted(where, np.arange(blocks) * block), padded[where[escapes]]


def unpack(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The values again; all words of a selector are decoded at once."""
    out = np.zeros(n + 60, dtype=_U)
    if n == 0:
        return out[:0]
    selector = (words >> _U(60)).astype(np.int64)
    step = np.ones(16, dtype=np.int64)
    step[1:15] = COUNTS
    counts = step[selector]
    before = np.cumsum(counts) - counts
    owner = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    start = owner * block + before - before[offsets][owner]
    room = np.minimum((owner + 1) * block, n) - start
    for k in range(len(COUNTS)):
        mine = np.flatnonzero(selector == k + 1)
        if len(mine):
            mask = _U((1 << int(BITS[k])) - 1)
            for j in range(int(COUNTS[k])):
                inside = mine[room[mine] > j]
                out[start[inside] + j] = (words[inside] >> _U(j * int(BITS[k]))) & mask
    mine = selector == ESCAPE
    out[start[mine]] = escapes[(words[mine] & _U((1 << 60) - 1)).astype(np.int64)]
    return out[:n]


def segment(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    lengths = np.array([len(x) for x in ids], dtype=np.int64)
    words, offsets, escapes = pack(np.concatenate(ids) if ids else np.zeros(0, _U))
    head = np.array([MAGIC, len(ids), lengths.sum(), len(offsets), len(words), len(escapes)], dtype="<u8")
    body = b"".join([
        head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], "u1").tobytes(), lengths.astype("<i8").tobytes(),
        offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()])
    return body + zlib.crc32(body).to_bytes(4, "little")


def read_segment(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of the documents of a segment; a damaged one raises."""
    if len(data) < 52 or zlib.crc32(memoryview(data)[:-4]) != int.from_bytes(data[-4:], "little"):
        raise ValueError("damaged segment")
    magic, docs, n, blocks, n_words, n_escapes = (int(x) for x in np.frombuffer(data, "<u8", 6))
    if magic != MAGIC:
        raise ValueError("not a segment")
    at, parts = 48, []
    for kind, count in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", blocks), ("<u8", n_words), ("<u8", n_escapes)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    doc_ids, missing, lengths, offsets, words, escapes = parts
    values = unpack(words, offsets, escapes, n)
    ends = np.cumsum(lengths)
    for doc_id, gone, start, end in zip(doc_ids, missing, ends - lengths, ends):
        yield (None if gone else int(doc_id)), values[start:end]


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0,
              segment_ids: int = 1 << 18) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write the segments to ``path``.

    Rows are range partitioned by doc_id, NULL first, and sorted, so (shard, segment) is the global order;
    rows with one doc_id are ordered by text. A task holds one segment, or one document where that is longer.
    """
    bounded_batches(docs.sparkSession)
    schema = "shard INT, segment INT, start BIGINT, ids BIGINT, payload BINARY"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = encoder(tokenizer), TaskContext.get().partitionId()
        doc_ids, ids, held, done, number = [], [], 0, 0, 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([done], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([segment(doc_ids, ids)], pa.binary())],
                names=["shard", "segment", "start", "ids", "payload"])

        for batch in batches:
            for doc_id, found in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1), end_id)):
                doc_ids.append(doc_id)
                ids.append(found)
                held += len(found)
                if held >= segment_ids:
                    yield flush()
                    doc_ids, ids, held, done, number = [], [], 0, done + held, number + 1
        if ids:
            yield flush()

    (docs.select("doc_id", "text").repartitionByRange(partitions(docs.sparkSession), "doc_id")
     .sortWithinPartitions("doc_id", "text").mapInArrow(encode, schema)
     .write.option("compression", "zstd").parquet(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (little-endian uint32) from the segments at ``path``."""
    bounded_batches(spark)
    table = spark.read.parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, start, payload in zip(*(batch.column(k) for k in range(3))):
                doc_ids, starts, lengths, crcs, at = [], [], [], [], start.as_py()
                for doc_id, ids in read_segment(payload.as_py()):
                    doc_ids.append(doc_id)
                    starts.append(at)
                    lengths.append(len(ids))
                    crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.as_py()] * len(doc_ids), pa.int32()), pa.array(doc_ids, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64())],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"])

    docs = table.select("shard", "start", "payload").mapInArrow(
        decode, "shard INT, doc_id BIGINT, start BIGINT, n_tokens BIGINT, ids_crc32 BIGINT")
    # One row per shard, a partition of the writing job.
    earlier = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (table.groupBy(F.col("shard").alias("_shard")).agg(F.sum("ids").alias("_ids"))
               .select("_shard", F.coalesce(F.sum("_ids").over(earlier), F.lit(0)).alias("_before")))
    return (docs.join(F.broadcast(offsets), F.col("shard") == F.col("_shard"))
            .select("doc_id", (F.col("start") + F.col("_before")).alias("start"), "n_tokens", "ids_crc32"))


def binary_output(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write the ids of ``docs`` and read them back. A NULL text is empty; no rows give no rows; columns other
    than doc_id and text are left. The files stay in the shared scratch folder."""
    path = scratch_dir(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer, end_id)
    return read_ids(docs.sparkSession, path)
