import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import SF_DIR
from weblens.llm import queries
from weblens.llm.quality import Ranking, features, score_quality
from weblens.llm.toxicity import BlockMaxIndex, score_toxicity, term_counts


@pytest.mark.parametrize("query, label, least", [("op3_quality", "quality", 0.95), ("op6_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, query, label, least):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    rows = queries.QUERIES[query](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    known = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    cut = 0.5 if label == "quality" else 0.7
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= cut)
    tested = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    assert sum(r["predicted"] == known[r["doc_id"]] for r in tested) >= least * len(tested)


@pytest.mark.parametrize("score", [score_quality, score_toxicity])
def test_odd(spark, make_docs, odd_rows, score):
    rng = random.Random(2)
    plain = [(100 + i, " ".join(rng.choice("the a of on".split()) for _ in range(30)) + (" rotten" if i % 2 else "")) for i in range(120)]
    docs = make_docs(odd_rows + plain)
    labels = spark.createDataFrame(
        [(100 + i, i % 2, i % 2) for i in range(120)] + [(None, 1, 1), (4, None, None), (5, 1, 1), (5, 0, 0), (999, 1, 1)],
        "doc_id BIGINT, quality INT, toxic INT")
    out = score(docs, labels)
    rows = out.collect()
    assert len(rows) == len(odd_rows) + 120 and len(set(out.columns)) == len(out.columns)
    assert all(r["_rank"] == 7 and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["doc_id"] % 2) for r in rows if (r["doc_id"] or 0) >= 100)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert score(make_docs([]), labels).count() == 0
    nobody = score(make_docs([(1, "a b"), (2, None)]), labels.limit(0)).collect()
    assert len(nobody) == 2 and all(0 <= r["score"] <= 1 for r in nobody)


def test_feature_rows_do_not_depend_on_neighbours():
    texts = ["Some words, and more!", "", None, "ALL CAPS !!", "a a a a b", "é ß ö"]
    together = features(pa.array(texts))
    for i, t in enumerate(texts):
        assert np.array_equal(features(pa.array([t], pa.string()))[0], together[i])
    assert Ranking(np.zeros((0, together.shape[1])), np.zeros(0), 0).score(pa.array(texts)).tolist() == [0.5] * 6


def test_block_max_is_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(500):
        t = np.sort(rng.choice(80, rng.integers(0, 12), replace=False))
        w = rng.random(len(t)) + 0.01
        vectors.append((t, w / max(1e-300, np.sqrt(w @ w))))
    vectors[7] = vectors[8] = vectors[3]  # ties
    index = BlockMaxIndex(vectors, 80)
    dense = np.zeros((500, 80))
    for j, (t, w) in enumerate(vectors):
        dense[j, t] = w
    for j in range(0, 500, 9):
        t, w = vectors[j]
        cosines = dense @ dense[j]
        cosines[j] = -1
        best = [int(i) for i in np.lexsort((np.arange(500), -np.round(cosines, 12)))[:10] if cosines[i] > 0]
        found, score = index.nearest(t, w, 10, j)
        assert found.tolist() == best and np.allclose(score, cosines[best])


def test_term_counts():
    from weblens.llm.wordhash import word_hashes
    names = b"bad\nworse"
    terms = np.sort(word_hashes(np.frombuffer(names, np.uint8), np.array([0, len(names)]), letters=True)[0])
    got = [(r.tolist(), c.tolist()) for r, _, c in term_counts(pa.array(["Bad, bad WORSE.", None, "good", "bad"]), terms)]
    assert [sorted(c) for _, c in got] == [[1, 1, 2]] and got[0][0] == [0, 2, 2, 2, 3]
