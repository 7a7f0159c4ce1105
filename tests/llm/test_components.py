import random

import pytest

from gleaner.llm.components import components, with_edges


def brute(edges):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return {x: root(x) for x in parent}


def table(spark, edges):
    return spark.createDataFrame(edges, "a long, b long")


def labels(df):
    return {r.node: r.component for r in df.collect()}


MIXED = random.Random(2).sample(range(500), 70)
CASES = {
    "path": [(i, i + 1) for i in range(60)],
    "star": [(100, i) for i in range(60)] + [(100, 200)],
    "mixed path": list(zip(MIXED, MIXED[1:], strict=False)),
    "random": [(random.Random(i).randint(0, 80), random.Random(i + 999).randint(0, 80)) for i in range(70)],
    "repeated": [(3, 4), (4, 3), (3, 4), (-5, 9), (9, 12)],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = [(a, b) for a, b in CASES[name] if a != b]
    assert labels(components(table(spark, edges))) == brute(edges)


def test_edges_one_part_after_another(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(61, 120)) for _ in range(60)]
    edges += [(rng.randint(0, 120), 130 + i) for i in range(10)]
    found = None
    for start in range(0, len(edges), 25):
        found = with_edges(found, table(spark, edges[start : start + 25]))
    assert labels(found) == brute(edges)
