from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import queries as Q
from ledgerlens.llm import source_divergence as S


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if "A" <= c <= "Z" or "a" <= c <= "z" or c >= "\x80":
            word += chr(ord(c) + 32) if "A" <= c <= "Z" else c
        else:
            out += [word] if word else []
            word = ""
    return out


def brute(rows, least=10, k=10):
    """The contract with Python's integers over (lang, source, text)."""
    docs, n, lang_n, groups = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        found = terms_of(text)
        n[lang, source].update(found)
        lang_n[lang].update(found)
        docs.update((lang, t) for t in set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for t in lang_n[lang] if docs[lang, t] >= least]
        v, lang_size = len(kept), sum(lang_n[lang][t] for t in kept) + 2 * len(kept)
        q = {t: 1 + 10**9 * (lang_n[lang][t] + 2) // lang_size for t in kept}
        p = {}
        for s in sources:
            size = sum(n[lang, s][t] for t in kept) + 2 * v
            p[s] = {t: 1 + 10**9 * (n[lang, s][t] + 2) // size for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(items) if part == "pair" or i < k]
    return sorted(out)


def of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


@pytest.fixture
def rows():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)] + ["Über", "été", "ÉTÉ", "日本", "x y", "\U0001f600"]
    out = []
    for i in range(600):
        lang, source = ["en", "de", None, ""][i % 7 % 4], f"s{i * i % 11}" if i % 5 else None
        out.append((lang, source, " ".join(words[int(w)] + ["", ",", "1", "'s"][int(w) % 4] for w in rng.zipf(1.3, int(rng.integers(0, 60))) % len(words))))
    out += [("xx", "alone", "only one source"), ("yy", "a", "few"), ("yy", "b", None), ("en", "hot", "common " * 50_000 + "Common"), ("en", "never", None), ("en", "never", "")]
    return out


def test_whole_contract(docs_of, rows):
    got = of(S.divergence(docs_of([(i, t, lang, src) for i, (lang, src, t) in enumerate(rows)])))
    assert got == brute(rows)


def test_small_blocks_chunks_and_flushes(docs_of, rows, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 3)
    monkeypatch.setattr(S, "CHUNK", 500)
    monkeypatch.setattr(S, "HELD", 20)
    got = of(S.divergence(docs_of([(None, t, lang, src) for lang, src, t in rows])))
    assert got == brute(rows)


def test_repeated_rows_and_empty_table(docs_of):
    rows = [("en", "a", "same text here")] * 9 + [("en", "b", "same text here"), ("en", "b", "text other")]
    assert of(S.divergence(docs_of([(1, t, lang, src) for lang, src, t in rows]))) == brute(rows)
    assert of(S.divergence(docs_of([]))) == []


def test_shares_are_exact(spark):
    big = [(2, 3), (7, 7), (2, 9_000_000_000_000_000), (8_999_999_999_999_999, 9_000_000_000_000_000), (123_456_789_012_345, 987_654_321_098_765)]
    got = spark.createDataFrame(big, "c long, t long").select(S.share("c", "t").alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * c // t for c, t in big]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), max_size=60), st.integers(1, 4), st.integers(1, 7))
def test_skyband(points, k, step):
    n, lang_n = np.array([p[0] for p in points], int), np.array([p[1] for p in points], int)
    term = np.random.default_rng(len(points)).permutation(len(points))
    want = {i for i in range(len(points)) if ((n >= n[i]) & (lang_n <= lang_n[i]) & (term < term[i])).sum() < k}
    assert set(S.skyband(n, lang_n, term, k, step).tolist()) == want


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("lang", "source", "text").collect()
    assert of(Q.op13_source_divergence(spark, sf)) == brute([tuple(r) for r in docs])
