import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerlens.llm import context_tree as X
from ledgerlens.llm import queries as Q


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    out, word = [], ""
    for c in lower(text) + " ":
        if c in " \t\n\v\f\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return out


def trains(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 != 2


def decisions(text, depth):
    data = b"\n" * depth + " ".join(words_of(text)).encode() + b"\n"
    for at in range(depth, len(data)):
        for i in range(8):
            yield data[at - depth:at], (1 << i) | (data[at] >> (8 - i)), data[at] >> (7 - i) & 1


def ln_kt(a, b):
    return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)


class Trees:
    """Context-tree weighting by its definition: P_w of every node from its counts and children."""

    def __init__(self, texts, depth):
        self.depth, self.n, self.children = depth, defaultdict(lambda: [0, 0]), defaultdict(set)
        for text in texts:
            for ctx, v, bit in decisions(text, depth):
                self.add(ctx, v, bit, 1)

    def add(self, ctx, v, bit, times):
        for d in range(self.depth + 1):
            node = (v, ctx[self.depth - d:])
            self.n[node][bit] += times
            if d < self.depth:
                self.children[node].add((v, ctx[self.depth - d - 1:]))

    def ln_pw(self, node, cache):
        if node not in cache:
            kt = ln_kt(*self.n[node])
            if len(node[1]) == self.depth:
                cache[node] = kt
            else:
                below = sum(self.ln_pw(c, cache) for c in self.children[node])
                top = max(kt, below)
                cache[node] = top + math.log(math.exp(kt - top) + math.exp(below - top)) - math.log(2)
        return cache[node]

    def log10(self, text):
        """Each decision: P_w of the root with it counted once more, over P_w of the root."""
        before, total = {}, 0.0
        for ctx, v, bit in decisions(text, self.depth):
            root = (v, b"")
            old = self.ln_pw(root, before)
            path = [(v, ctx[self.depth - d:]) for d in range(self.depth + 1)]
            self.add(ctx, v, bit, 1)
            after = {k: x for k, x in before.items() if k not in path}
            total += self.ln_pw(root, after) - old
            self.add(ctx, v, bit, -1)
        return total / math.log(10)


def brute(rows, depth):
    train = [t for d, t in rows if trains(d)]
    trees, counts = Trees(train, depth), Counter()
    for t in train:
        counts.update([*words_of(t), None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, t in rows:
        tokens = [*words_of(t), None]
        out.append((d, not trains(d), len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens), trees.log10(t)))
    return out


ROWS = [(i, " ".join(["The cat", "sat ON", "the\tmat.", "Ünï çödé", "日本", "cat cat"][(i * j) % 6] for j in range(i % 9)), "en", "s") for i in range(16)]
ROWS += [(100, None, "en", "s"), (101, "", "en", "s"), (102, " \n\t ", "en", "s"), (None, "null id", "en", "s"), (3, ROWS[3][1], "en", "s"), (3, "same id", "en", "s"),
         (103, "x" * 300, "en", "s"), (104, "  \u0085 nbsp is no space", "en", "s"), (105, "unseen zebra quux " * 3, "en", "s")]


@pytest.mark.parametrize(("depth", "unit", "hot"), [(2, 1 << 18, 1 << 25), (3, 7, 0), (6, 40, 2000), (1, 1, 1 << 25)])
def test_scores_equal_the_definition(docs_of, monkeypatch, depth, unit, hot):
    monkeypatch.setattr(X, "HOT_STRINGS", hot)
    monkeypatch.setattr(X, "HOT_WORDS", hot)
    monkeypatch.setattr(X, "UNIT", unit)
    got = [tuple(r)[:7] for r in X.score(docs_of(ROWS), depth).collect()]
    want = brute([r[:2] for r in ROWS], depth)
    key = lambda r: (r[0] is None, r[0] or 0, r[6], r[2])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=lambda r: (*key(r)[:2], round(r[6], 6))), sorted(want, key=lambda r: (*key(r)[:2], round(r[6], 6))), strict=True):
        assert g[:5] == w[:5] and np.allclose(g[5:], w[5:], rtol=1e-9, atol=1e-9), (g, w)


def test_next_byte_probabilities_sum_to_one(spark):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 4, (400, 3)) @ np.array([1 << 16, 1 << 8, 1]))
    contexts = np.unique(keys >> 8)
    every = [(int(c << 8 | b), int(b < 4) * int(c % 5), 1) for c in contexts for b in range(256)]
    priced = X.price_strings(spark.createDataFrame(every, "key long, n long, n_all long"), 2, 50).collect()
    total = defaultdict(float)
    for r in priced:
        total[r["key"] >> 8] += 2 ** -r["bits"]
    assert len(total) == len(contexts) and np.allclose(list(total.values()), 1)


def test_no_training_texts_and_empty_table(docs_of):
    held = next(i for i in range(100) if not trains(i))
    r = X.score(docs_of([(held, "two words", "en", "s")]), 2).first()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) == (True, 3, 0, 0, 0.0)
    assert np.isclose(r["score"], -8 * 10 * math.log10(2)) and np.isclose(r["bits_per_byte"], 8)
    assert X.score(docs_of([])).count() == 0


def test_pieces_lose_no_row(docs_of, monkeypatch):
    monkeypatch.setattr(X, "CHUNK", 50)
    monkeypatch.setattr(X, "PRICED", 70)
    rows = [(i, "w" * (i % 97) + " tail", "en", "s") for i in range(300)]
    assert sorted(r["doc_id"] for r in X.score(docs_of(rows), 2).collect()) == list(range(300))


def test_model_beats_the_base_on_held_out_texts(spark):
    rows = Q.op12_context_tree(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) / sum(r["n_bytes"] for r in held) > -2.2 * math.log10(2)
