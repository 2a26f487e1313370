import os
import random

import pytest
from pyspark.sql import functions as F

from tests.oracle import TESTDATA

SF_DIR = os.path.join(TESTDATA, "sf0.001")
DOC = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with columns whose names operators use inside."""
    def make(rows, clash=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        if clash:
            for name in ("_rank", "_id", "score", "node", "rep", "_part", "target", "whole", "_row", "_own", "_copy"):
                df = df.withColumn(name, F.lit(7))
        return df
    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs everywhere, empty and very long texts, ties, repeated rows and ids."""
    rng = random.Random(3)
    long = " ".join(rng.choice("alpha beta gamma delta eps zeta".split()) + str(rng.randrange(9)) for _ in range(60000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one two three"), (6, long), (7, long + " end"), (8, "Same text here now ok"),
            (9, "Same text here now ok"), (9, "Same text here now ok"), (10, "same TEXT here now ok", None), (None, "no id at all"),
            (None, None), (11, "Zażółć gęślą jaźń 日本語 é"), (12, "x" * 5000, None), (13, "<|endoftext|> a  b\n c")]


@pytest.fixture(scope="session")
def words():
    """Random texts, and edited copies of them."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(900)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    def edited(t, share):
        return " ".join(rng.choice(vocabulary) if rng.random() < share else w for w in t.split())
    return text, edited
