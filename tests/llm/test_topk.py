import math

import numpy as np

from ledgerlens.llm import topk_pivots as K
from pyspark.sql import functions as F


def brute(rows, k=10, every=100):
    ok = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v, _ in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            own = sorted((-sum(x * y for x, y in zip(a, b)), c) for c, b in ok if c != q and len(a) == len(b))[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(own)]
    return sorted(out)


def got(frame, **params):
    return sorted(tuple(r) for r in K.search(K.quantized(frame), F.col("id") % 100 == 0, **params).collect())


def test_against_brute_force_with_ties_and_bad_vectors(spark, vectors_of):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(16).tolist(), 1) for i in range(900)]
    rows += [(i, rows[5][1], 2) for i in range(1000, 1060)]  # ties with an exact copy
    rows += [(2000, None, 1), (2100, [float("nan")] * 16, 1), (2200, [1.0, None] * 8, 1), (2300, [float("inf")] * 16, 1), (2400, [1.0, 2.0], 1), (2500, [0.0] * 16, 1),
             (None, [1.0] * 16, 1)]
    f = vectors_of(rows)
    assert got(f) == brute(rows)
    assert got(f, block=100, query_block=4, n_pivots=3) == brute(rows)


def test_few_rows_and_empty(spark, vectors_of):
    rows = [(0, [1.0, 0.5], 0), (1, [0.2, 0.1], 0)]
    assert got(vectors_of(rows)) == brute(rows) == [(0, 1, 1, 204 * 1024 + 102 * 512)]
    assert got(vectors_of([])) == []


def test_pivots_save_work():
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((20, 8)) * 3000
    c = (centres[rng.integers(0, 20, 4000)] + rng.standard_normal((4000, 8)) * 50).astype(np.int64)
    ids = np.arange(4000)
    found, work = K.best_in_block(ids[:5], c[:5], ids, c, c[100:124], 10)
    assert len(found) == 50 and work < 5 * 4000 / 2
