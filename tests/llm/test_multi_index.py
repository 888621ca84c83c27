import numpy as np

from ledgerlens.llm import multi_index as I


def brute(rows, least=0.93):
    ok = {}
    for n, (i, v, lab) in enumerate(rows):
        if i is not None and v is not None and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.asarray(np.asarray(v, np.float32), np.float64)
            ok[n] = (i, x / np.linalg.norm(x), lab)
    links, low = {n: set() for n in ok}, {n: ok[n][0] for n in ok}
    for a in ok:
        for b in ok:
            if a < b and ok[a][2] == ok[b][2] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= least:
                links[a].add(b)
                links[b].add(a)
    changed = True
    while changed:
        changed = False
        for a in ok:
            m = min([low[a], *(low[b] for b in links[a])])
            changed, low[a] = changed or m < low[a], m
    return sorted((str(r[0]), len(links[n]) if n in ok else 0, str(low.get(n, r[0]))) for n, r in enumerate(rows))


def got(frame, **params):
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in I.near_duplicates(frame, **params).collect())


def sample(n=700, dim=24, seed=5):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((n, dim))
    rows = [(i, base[i].tolist(), int(i % 3)) for i in range(n)]
    for j in range(400):  # near copies of a few, one of them a large group
        src = 0 if j < 250 else j % 40
        rows.append((n + j, (base[src] + rng.standard_normal(dim) * rng.choice([0.05, 0.15, 0.25])).tolist(), int(src % 3)))
    return rows


def test_links_and_components(spark, vectors_of):
    rows = sample()
    want, have = brute(rows), got(vectors_of(rows), target_recall=1.0)
    links = lambda x: sum(r[1] for r in x)
    assert links(have) <= links(want) and links(have) >= 0.999 * links(want)
    assert have == want


def test_recall_at_the_default(spark, vectors_of):
    rows = sample(seed=9)
    want, have = brute(rows), got(vectors_of(rows))
    assert sum(r[1] for r in have) >= 0.99 * sum(r[1] for r in want)


def test_blocks_give_the_same(spark, vectors_of):
    rows = sample(n=200)
    assert got(vectors_of(rows), block=16, target_recall=1.0) == brute(rows)


def test_bad_vectors_copies_and_empty(spark, vectors_of):
    rows = [(5, [1.0, 2.0, 3.0], 1), (3, [1.0, 2.0, 3.0], 1), (9, [2.0, 4.0, 6.0], 1), (4, [1.0, 2.0, 3.0], 2), (6, [1.0, 2.0, 3.0], None), (7, [0.0] * 3, 1), (8, [0.0] * 3, 1),
            (10, None, 1), (11, [float("nan")] * 3, 1), (12, [None, 1.0, 1.0], 1), (13, [1.0], 1), (14, [5.0], 1), (15, [], 1), (16, [float("inf"), 1.0, 1.0], 1), (17, [1.0, 2.0, 3.0], 2)]
    assert got(vectors_of(rows)) == brute(rows)
    assert got(vectors_of([])) == []
    one = I.near_duplicates(vectors_of([(None, [1.0, 2.0], 1)])).collect()[0]
    assert one["vec_id"] is None and one["n_links"] == 0 and one["kept"]


def test_recall_of_pairs_that_differ_inside_the_data():
    rng = np.random.default_rng(4)
    for rank in (4, 16):
        basis = np.linalg.qr(rng.standard_normal((64, rank)))[0].T
        x = rng.standard_normal((4000, rank))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        way = rng.standard_normal(x.shape)
        way -= (way * x).sum(1, keepdims=True) * x
        y = (0.935 * x + np.sqrt(1 - 0.935 ** 2) * way / np.linalg.norm(way, axis=1, keepdims=True)) @ basis
        x, at = x @ basis, np.arange(len(x))
        book = I.MultiIndex(x, 31, 0.93, 0.995)
        (i, j), (k, m), (b1, b2), (c1, c2) = book.cells(x), book.cells(y), book.borders(x), book.borders(y)
        assert np.mean((b1[at, k] + b2[at, m] <= book.radius) | (c1[at, i] + c2[at, j] <= book.radius)) >= 0.99
