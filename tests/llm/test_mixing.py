import math
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SF_DIR
from weblens.llm.mixing import mix, repeated


def fill(sizes, weights, budget, cap):
    total, open_, target = sum(sizes) * budget, set(range(len(sizes))), {}
    while open_:
        level = (total - sum(target.values())) / sum(weights[i] for i in open_)
        over = {i for i in open_ if level * weights[i] > cap * sizes[i]}
        if not over:
            return target | {i: level * weights[i] for i in open_}
        target |= {i: Fraction(cap * sizes[i]) for i in over}
        open_ -= over
    return target


def test_targets_and_totals(spark, make_docs):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 40)), [None, "b", "B", "a", "é", "z"][min(5, i % 11 % 6 if i % 3 else 3)]) for i in range(3000)]
    out = mix(make_docs(rows)).collect()
    sizes = defaultdict(int)
    for r in out:
        assert r["_size"] == len((r["text"] or "").split())
        sizes[r["source"]] += r["_size"]
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = fill([sizes[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], Fraction(3, 2), 2)
    taken = defaultdict(int)
    for r in out:
        assert r["_source_size"] == sizes[r["source"]] and 0 <= r["_repeats"] <= 2
        assert math.isclose(r["_target"], float(want[names.index(r["source"])]), rel_tol=1e-12)
        taken[r["source"]] += r["_size"] * r["_repeats"]
    for i, s in enumerate(names):
        assert abs(taken[s] - float(want[i])) <= 20
    again = {(r["doc_id"], r["_repeats"]) for r in mix(make_docs(rows)).collect()}
    assert again == {(r["doc_id"], r["_repeats"]) for r in out}
    copies = repeated(mix(make_docs(rows)))
    assert copies.count() == sum(r["_repeats"] for r in out)


def test_odd(make_docs, odd_rows):
    out = mix(make_docs(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    assert {r["_size"] for r in out if r["doc_id"] in (1, 2, 3)} == {0}
    assert all(r["_rank"] == 7 and r["target"] == 7 for r in out)
    assert mix(make_docs([])).count() == 0
    empty = mix(make_docs([(1, None), (2, "")])).collect()
    assert [(r["_target"], r["_repeats"] * r["_size"]) for r in empty] == [(0.0, 0)] * 2


def test_no_python(make_docs):
    plan = mix(make_docs([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_all_capped(spark, make_docs):
    out = mix(make_docs([(1, "a b"), (2, "c")]), weights=(1,), budget=(2, 1)).collect()
    assert {(r["_target"], r["_repeats"]) for r in out} == {(6.0, 2)}
    assert F.col is not None


@pytest.mark.parametrize("long_id", range(12))
def test_one_document_outweighs_what_is_wanted(spark, long_id):
    """Wherever its bucket lies, it stops none of the others."""
    rows = [(long_id, "w " * 10_000, "a")] + [(1000 + i, "w " * 100, "a") for i in range(99)] + [(5000 + i, "w " * 100, "b") for i in range(40)]
    out = mix(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING"), (5, 1), (5, 4), 2).collect()
    for source in "ab":
        mine = [r for r in out if r["source"] == source]
        taken = sum(r["_size"] * r["_repeats"] for r in mine)
        assert abs(taken - mine[0]["_target"]) <= max(50, 0.01 * mine[0]["_target"]), (source, taken, mine[0]["_target"])


def test_pipeline_stages_take_odd_rows(spark, make_docs, odd_rows):
    """Every stage of the pipeline on NULLs, empty, long and repeated rows, and on no rows."""
    import corpus_pipeline
    for rows in (odd_rows, []):
        for name, stage in corpus_pipeline.STAGES:
            docs = make_docs(rows, clash=False)
            out = stage(spark, docs, SF_DIR)
            found = out.collect()
            assert name == "packing" or out.columns == docs.columns
            assert {r["doc_id"] for r in found} <= {r[0] for r in rows}
            if name == "personal_data":
                assert len(found) == len(rows)
            if name == "near_copies" and rows:
                assert {1, 2, 3, 4} <= {r["doc_id"] for r in found}
