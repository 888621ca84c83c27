import hashlib
import re

import pytest

from ledgerlens.llm import mixing as M

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, weights=(3, 1, 2), share=1.5, most=2):
    size = [len(WORD.findall(t or "")) for _, t, _, _ in rows]
    srcs = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    tot = {s: sum(n for r, n in zip(rows, size) if r[3] == s) for s in srcs}
    w = {s: weights[i % len(weights)] for i, s in enumerate(srcs)}
    left, target, open_ = share * sum(tot.values()), {}, set(srcs)
    while open_:
        unit = left / sum(w[s] for s in open_)
        full = {s for s in open_ if w[s] * unit >= most * tot[s]}
        for s in full or open_:
            target[s] = most * tot[s] if full else w[s] * unit
        left -= sum(target[s] for s in full)
        open_ -= full or open_
    taken = {}
    for s in srcs:
        e = int(target[s] // tot[s]) if tot[s] else 0
        room = int(target[s] - e * tot[s])
        own = sorted((hashlib.md5(f"0|{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[0], n) for r, n in zip(rows, size) if r[3] == s)
        for _, d, n in own:
            part = min(n, room)
            room -= part
            taken[d] = e * n + part
    return tot, target, taken


def text(n):
    return " ".join(f"w{i}" for i in range(n))


def test_against_brute_force(spark, docs_of):
    rows = [(i, text(i * 7 % 23), "en", ["a", "b", "hot", None][0 if i % 11 == 0 else 1 if i % 7 == 0 else 3 if i % 13 == 0 else 2]) for i in range(300)]
    rows += [(900, None, "en", "b"), (901, "", "en", "empty"), (902, text(3000), "en", "a")]
    tot, target, taken = brute(rows)
    src = {r[0]: r[3] for r in rows}
    got = M.mix(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["source_size"] == tot[src[r["doc_id"]]]
        assert r["target"] == pytest.approx(target[src[r["doc_id"]]])
        assert r["taken"] == taken[r["doc_id"]] and r["taken"] <= 2 * r["size"]


def test_repeated_ids_null_ids_and_empty_table(spark, docs_of):
    rows = [(1, text(10), "en", "a")] * 5 + [(None, text(4), "en", "a"), (2, text(100), "en", "b")]
    got = M.mix(docs_of(rows)).collect()
    assert len(got) == 7 and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert M.mix(docs_of([])).count() == 0


def test_documents_repeat_whole_and_reruns_agree(spark, docs_of):
    rows = [(i, text(20), "en", "ab"[i % 10 == 0]) for i in range(200)]
    one, two = (sorted((r["doc_id"], r["text"], r["key"]) for r in M.mix_documents(docs_of(rows)).collect()) for _ in range(2))
    assert one == two and {t for _, t, _ in one} == {text(20)}
    assert M.mix_documents(docs_of(rows)).columns == docs_of(rows).columns
    plan = {r["doc_id"]: r["copies"] for r in M.mix(docs_of(rows)).collect()}
    assert len(one) == sum(plan.values()) == 300
