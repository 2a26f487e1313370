import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import SF_DIR
from weblens.llm import packing, queries
from weblens.llm.packing import pack_documents, pack_sequences, patterns, price, relaxed
from weblens.llm.simple8b import binary_output, pack, read_segment, segment, unpack
from weblens.llm.tokens import Encoder

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]


@pytest.fixture(scope="module", params=PATHS, ids=["bytes", "words"])
def pair(request):
    plain = Tokenizer.from_file(request.param)
    plain.encode_special_tokens = True
    return plain, Encoder(request.param, most_pieces=2000)


def test_pieces_encode_like_the_whole(pair):
    plain, encoder = pair

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.one_of(st.text(alphabet="aZé.,!'\n\t    日1_́\x1c", max_size=40), st.text(max_size=30), st.none()), max_size=5))
    def same(texts):
        for text, ids in zip(texts, encoder.encode(pa.array(texts, pa.string()), 5)):
            assert ids.tolist() == plain.encode(text or "", add_special_tokens=False).ids + [5]

    same()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1) | st.integers(0, 60000) | st.integers(0, 3), max_size=300), st.sampled_from([1, 7, 64, 4096]))
def test_packing_words_round_trip(values, block):
    values = np.array(values, dtype=np.uint64)
    words, offsets, escapes = pack(values, block)
    assert unpack(words, offsets, escapes, len(values), block).tolist() == values.tolist()
    assert len(offsets) == -(-len(values) // block)


def test_segment():
    docs = [np.array([5, 2 ** 61, 0], np.uint64), np.array([0], np.uint64)]
    data = segment([3, None], docs)
    assert [(d, x.tolist()) for d, x in read_segment(data)] == [(3, docs[0].tolist()), (None, [0])]
    for bad in (data[:-1], data[:60] + bytes([data[60] ^ 1]) + data[61:], b""):
        with pytest.raises(ValueError):
            list(read_segment(bad))


def expected_ids(path, rows, end):
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    return [(i, plain.encode(t or "", add_special_tokens=False).ids + [end]) for i, t in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("source", ["table", "odd"])
def test_ids(spark, make_docs, odd_rows, source):
    if source == "table":
        out = queries.op4_simple8b(spark, SF_DIR)
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    else:
        out, rows = binary_output(make_docs(odd_rows), PATHS[0]), [r[:2] for r in odd_rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    want, at = [], 0
    for doc_id, ids in expected_ids(PATHS[0], rows, 0):
        want.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    key = lambda r: (r[1], r[2])
    assert sorted(map(tuple, out.collect()), key=key) == want


def test_no_ids(make_docs):
    assert binary_output(make_docs([]), PATHS[0]).count() == 0
    assert pack_documents(make_docs([]), PATHS[1]).count() == 0


@pytest.mark.parametrize("source", ["table", "odd"])
def test_sequences(spark, make_docs, odd_rows, source):
    if source == "table":
        out = queries.op9_packing(spark, SF_DIR.replace("0.001", "0.01")).collect()
        rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/documents.parquet").collect()]
    else:
        out, rows = pack_documents(make_docs(odd_rows), PATHS[1]).collect(), [r[:2] for r in odd_rows]
    ids = expected_ids(PATHS[1], rows, 1)
    pieces = sorted((str(d), n, s, min(2048, n - s), crc(x[s:s + 2048])) for d, x in ids for n in [len(x)] for s in range(0, n, 2048))
    assert sorted((str(r["doc_id"]), r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in out) == pieces
    held = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == held.get(r["sequence_id"], 0)
        held[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(held.values()) <= 2048 and sorted(held) == list(range(len(held)))
    if source == "table":
        assert sum(held.values()) >= 0.96 * 2048 * len(held)


@pytest.mark.parametrize("text", ["one two three", None, "w " * 70])
def test_short_texts_leave_little_padding(spark, text):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(text).cast("string").alias("text"))
    out = pack_documents(docs, PATHS[1])
    held = {r[0]: r[1] for r in out.groupBy("sequence_id").agg(F.sum("length")).collect()}
    assert sum(held.values()) >= 0.97 * 2048 * (len(held) - 1) and out.count() == 4000


def test_ranks_by_shuffle_are_the_same(spark, make_docs, odd_rows, monkeypatch):
    docs = make_docs(odd_rows).coalesce(1)
    want = sorted(map(str, pack_documents(docs, PATHS[1]).collect()))
    monkeypatch.setattr(packing, "BROADCAST_COUNTS", 0)
    assert sorted(map(str, pack_documents(docs, PATHS[1]).collect())) == want


def test_texts_that_polynomial_hashes_confuse(spark, make_docs):
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rows = [(1, one), (2, one.translate(str.maketrans("ab", "ba")))]
    docs = make_docs(rows).coalesce(1)
    for path, out, end in ((PATHS[0], binary_output(docs, PATHS[0]), 0), (PATHS[1], pack_documents(docs, PATHS[1]), 1)):
        assert sorted((r["doc_id"], r["ids_crc32"]) for r in out.collect()) == [(d, crc(x)) for d, x in expected_ids(path, rows, end)]


def test_sequences_hold_the_ids(make_docs, odd_rows):
    held = {}
    for r in pack_sequences(make_docs(odd_rows), PATHS[1]).collect():
        assert len(r["ids"]) == r["length"]
        held[r["sequence_id"], r["offset"]] = (str(r["doc_id"]), r["start"], r["ids"])
    want = [(str(d), s, x[s:s + 2048]) for d, x in expected_ids(PATHS[1], [r[:2] for r in odd_rows], 1) for s in range(0, len(x), 2048)]
    assert sorted(held.values()) == sorted(want)


def test_patterns():
    rng = np.random.default_rng(1)
    for top in (3, 40, 5000):
        histogram = {int(k): int(rng.integers(0, top)) for k in rng.choice(256, 90, replace=False) + 1}
        made, plan = {}, patterns(histogram, 256)
        for n, used in plan:
            assert sum(k * m for k, m in used.items()) <= 256 and n > 0
            for k, m in used.items():
                made[k] = made.get(k, 0) + n * m
        assert made == {k: n for k, n in histogram.items() if n}
        sizes = np.array(sorted(k for k, n in histogram.items() if n))
        _, least = relaxed(sizes, np.array([histogram[int(k)] for k in sizes], float), 256, 1500)
        assert sum(n for n, _ in plan) <= least.sum() + 0.5 * len(sizes) + 1
    assert patterns({}, 256) == []


def test_price_is_the_best_pattern():
    duals, sizes = np.array([0.5, 0.34, 0.2]), np.array([5, 3, 2])
    best = max(duals @ [a, b, c] for a in range(5) for b in range(7) for c in range(11) if 5 * a + 3 * b + 2 * c <= 13)
    value, pattern = price(duals, sizes, 13)
    assert abs(value - best) < 1e-12 and abs(duals @ pattern - best) < 1e-12 and pattern @ sizes <= 13
