import random
import re

import numpy as np
import xxhash

from ledgerlens.llm import simhash as S


def slow_print(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def classes(prints, most):
    """prints: [(doc_id, fp)] -> sorted (doc_id, fp, smallest id reachable)."""
    fps = sorted({f for _, f in prints})
    low = {f: min((d for d, g in prints if g == f and d is not None), default=None) for f in fps}
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= most:
                parent[find(a)] = find(b)
    best = {}
    for f in fps:
        r = find(f)
        best[r] = min((x for x in (best.get(r), low[f]) if x is not None), default=None)
    return sorted((str(d), f, str(best[find(f)])) for d, f in prints)


def texts(n=260, seed=2):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    out = []
    for i in range(n):
        out.append((i, " ".join(word() for _ in range(rng.randint(0, 60))), "en", "s"))
    for j in range(200):  # near copies: a few words changed
        w = out[j % 40][1].split()
        if w:
            w[rng.randrange(len(w))] = word()
        out.append((n + j, " ".join(w), "en", "s"))
    return out + [(900, None, "en", "s"), (901, "", "en", "s"), (902, " \t\n", "en", "s"), (903, "One two", "en", "s"), (904, "oNE\ttwo ", "en", "s"), (905, "a b c d", "en", "s"),
                  (None, "one two", "en", "s"), (None, "null alone here for good", "en", "s"), (906, "x y " * 100_000, "en", "s"), (5, out[5][1], "en", "s")]


def got(frame, **params):
    return sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1, str(r["component_id"])) for r in S.near_duplicates(frame, **params).collect())


def test_fingerprints_equal_the_slow_form():
    for _, t, _, _ in texts(60):
        assert S.fingerprint(t) == slow_print(t)


def test_against_brute_force(spark, docs_of):
    rows = texts()
    want = classes([(d, slow_print(t)) for d, t, _, _ in rows], 4)
    assert got(docs_of(rows)) == want
    assert got(docs_of(rows), block=8, sample=50) == want


def test_planted_bit_distances(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2 ** 63, 300, dtype=np.uint64)
    fps = set(base.tolist())
    for b in base[:200].tolist():
        for k in (1, 3, 4, 5):
            x = b
            for bit in rng.choice(64, k, replace=False):
                x ^= 1 << int(bit)
            fps.add(x)
    chain = int(base[0])
    for i in range(40):  # a chain of single bits, and a dense group
        chain ^= 1 << i
        fps.add(chain)
    dense = int(base[1])
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)}
    fps = sorted(fps)
    frame = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    from ledgerlens.llm.components import connected_components
    want = {}
    for d, f, c in classes([(x, x) for x in fps], 4):
        want.setdefault(c, set()).add(f)
    for block in (4096, 300):
        edges = S.link_forest(frame, block=block)
        roots = connected_components(edges, "node", "root").collect()
        have = {}
        for r in roots:
            have.setdefault(r["root"], set()).add(r["node"] & (1 << 64) - 1)
        assert sorted(map(sorted, have.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def test_thresholds_cover_and_follow_the_counts():
    cost, ts = S.allocate([[0, 1, 100, 1e4], [0, 50, 60, 70], [0, 10, 10.5, 11]], 1)
    assert sum(ts) == 1 and cost == min(sum(c[t + 1] for c, t in zip([[0, 1, 100, 1e4], [0, 50, 60, 70], [0, 10, 10.5, 11]], u))
                                        for u in [(a, b, c) for a in range(-1, 3) for b in range(-1, 3) for c in range(-1, 3)] if sum(u) == 1)
    bits = S.bit_groups(np.random.default_rng(0).integers(0, 2 ** 63, 500, dtype=np.uint64), 5)
    assert sorted(np.concatenate(bits).tolist()) == list(range(64))


def test_one_of_each_group_stays(spark, docs_of):
    rows = texts(80) + [(7, texts(80)[7][1], "en", "s")] * 3
    kept = S.keep_first(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    out = kept.collect()
    want = {c for _, _, c in classes([(d, slow_print(t)) for d, t, _, _ in rows], 4)}
    assert sorted(str(r["doc_id"]) for r in out) == sorted(want)
    assert S.keep_first(docs_of([])).count() == 0 and S.near_duplicates(docs_of([])).count() == 0
