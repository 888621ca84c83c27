import random

import numpy as np

from ledgerlens.llm.components import connected_components, merge_labels


def brute(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return sorted((x, find(x)) for x in parent)


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(300)]
    edges += [(5, 5), (None, 3), (70, None), (-4, -9), (-9, -4), (-4, -9)]
    have = connected_components(spark.createDataFrame(edges, "x long, y long"), "x", "y").collect()
    assert sorted(map(tuple, have)) == brute(edges)
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0


def test_merge_labels():
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    want = dict(brute(list(zip(a.tolist(), b.tolist()))))
    half = merge_labels(np.arange(400), a[:150], b[:150])
    assert merge_labels(half, a[150:], b[150:]).tolist() == [want.get(i, i) for i in range(400)]
