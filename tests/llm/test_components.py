import random

import pytest

from weblens.llm.components import components


def brute(edges):
    label = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("edges", [
    [(1, 2), (2, 3), (3, 4), (9, 4), (20, 21)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 200)],
    [(5, 5)], [], [(3, 1), (3, 1), (1, 3)]], ids=["mixed", "path", "star", "loop", "none", "repeated"])
def test_small(spark, edges):
    df = spark.createDataFrame(edges + [(None, 4), (4, None)], "a BIGINT, b BIGINT")
    assert {tuple(r) for r in components(df).collect()} == set(brute([e for e in edges if e[0] != e[1]]).items())


def test_random(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    edges = [e for e in edges if e[0] != e[1]]
    df = spark.createDataFrame(edges, "a BIGINT, b BIGINT")
    assert {tuple(r) for r in components(df).collect()} == set(brute(edges).items())
