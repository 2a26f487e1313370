import importlib
from collections import Counter

import corpus_pipeline
from tests.llm.conftest import SF_DIR
from tests.llm.test_joins import brute
from weblens.llm.common import staged
from weblens.llm.pii import detect


def test_stages_follow_each_other(spark):
    sf_dir = SF_DIR.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        seen.append(docs.collect())
        assert docs.columns == columns or name == "packing"
    given, good, single, private, mixed, packed = seen
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good}
    known = [r["doc_id"] for r in given if r["doc_id"] in labels]
    assert sum((d in kept) == (labels[d] == 1) for d in known) >= 0.97 * len(known)

    def five(text):
        return " ".join((text or "").split())
    component, _ = brute([(r["doc_id"], five(r["text"])) for r in good], 5, 80, 100)
    assert {r["doc_id"] for r in single} == set(component.values())
    assert [r["doc_id"] for r in sorted(private)] == [r["doc_id"] for r in sorted(single)]
    text = {r["doc_id"]: r["text"] for r in single}
    for r in private:
        assert (r["text"] != text[r["doc_id"]]) == bool(detect(text[r["doc_id"]]))
    counts = Counter(r["doc_id"] for r in mixed)
    assert set(counts) <= set(text) and max(counts.values()) <= 2
    assert {(r["doc_id"], r["text"]) for r in mixed} <= {(r["doc_id"], r["text"]) for r in private}
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == counts


def test_run_and_registration(spark):
    entry = importlib.import_module("__spark_entry__")
    assert {"pipeline", *(f"op{n}_" for n in range(1, 11))} <= {q.split("_")[0] + "_" * (q != "pipeline") for q in entry.queries()}
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
