import random
import zlib

import pytest

from ledgerlens.llm import language_id as L
from ledgerlens.llm import toxicity as X

WORDS = {"en": "the and of with that thing other where should them".split(), "de": "und der nicht schon über zwischen auch wieder durch".split(),
         "el": "και το δεν είναι από στην αυτό μας".split()}


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(4, 40))), lang, "s"))
    return out


def test_languages_held_out_and_edge_rows(spark, docs_of):
    rows = corpus() + [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "123 !?", "en", "s"), (1003, "the other thing " * 200_000, None, "s"),
                       (None, "und nicht über", "de", "s"), (5, corpus()[5][1], "en", "s")]
    got = L.identify(docs_of(rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (1000, 1001, 1002))
    assert by[1003]["lang_pred"] == "en" and by[None]["lang_pred"] == "de"
    held = [(by[d], lang) for d, _, lang, _ in corpus() if d in by and zlib.crc32(str(d).encode()) % 5 == 0]
    assert held and all(r["held_out"] and r["lang_pred"] == lang for r, lang in held) and all(0 <= r["score"] <= 1 for r in got)


def test_languages_without_training_rows(spark, docs_of):
    assert {r["lang_pred"] for r in L.identify(docs_of([(1, "some words", None, "s"), (2, "more", None, "s")])).collect()} == {"und"}
    assert L.identify(docs_of([])).count() == 0


def test_cosine_equals_brute_force():
    import numpy as np
    text = "Ab ba, aB!"
    s = " ab ba ab "
    v = sum(np.roll(L.letter_vector(ord(s[i])).astype(int), 2) * np.roll(L.letter_vector(ord(s[i + 1])).astype(int), 1) * L.letter_vector(ord(s[i + 2])) for i in range(len(s) - 2))
    assert (L.bundles([text, None, "7"], L.GramTable())[0] == v).all() and not L.bundles([None, "7"], L.GramTable()).any()


def bags(n=900, seed=3):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        sents = [" ".join("".join(rng.choice("aeiourstn") for _ in range(5)) for _ in range(6)) for _ in range(rng.randint(1, 12))]
        bad = rng.random() < 0.2
        if bad:
            k = rng.randrange(len(sents))
            sents[k] += " " + rng.choice(["dreadful", "vileness", "vilely", "rotten"])
        rows.append((i, ". ".join(sents) + ".", "en", "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_toxicity_learns_and_locates(spark, docs_of):
    rows, labels = bags()
    extra = [(5000, None, "en", "s"), (5001, "", "en", "s"), (5002, "fine " * 300_000 + "rotten.", "en", "s"), (None, "rotten", "en", "s")]
    lab = spark.createDataFrame([*labels, (5000, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows + extra)
    got = {r["doc_id"]: r for r in X.score_documents(docs, lab).collect()}
    assert len(got) == len(rows) + 4 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got.values())
    held = [(got[i], t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(r["predicted"] == t for r, t in held) >= 0.98 * len(held)
    assert got[5000]["predicted"] == 0 and got[5001]["predicted"] == 0 and got[5002]["predicted"] == 1
    model = X.train(docs, lab)
    text = {r[0]: r[1] for r in rows}
    spots = X.locate(docs_of(rows), model).collect()
    assert spots and all(any(w in text[r["doc_id"]][r["start"]:r["end"]] for w in ("dreadful", "vile", "rotten")) for r in spots)


def test_toxic_words_scarce_in_the_sample(spark, docs_of):
    rng = random.Random(8)
    plain = lambda: " ".join("".join(rng.choice("aeiourstn") for _ in range(5)) for _ in range(12))
    rows = [(i, plain() + (" quibbling" if i < 100 else " dreadful" if i % 2 else ""), "en", "s") for i in range(6000)]
    rows += [(9, rows[9][1], "en", "s")] * 4  # equal rows are one text
    lab = spark.createDataFrame([(i, 1, int(i < 100 or i % 2)) for i in range(6000)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in X.score_documents(docs_of(rows), lab, sample=200).collect()}
    assert all(got[i] == 1 for i in range(100)) and sum(got[i] == i % 2 for i in range(100, 6000)) >= 0.99 * 5900


def test_toxicity_without_features_is_the_class_share(spark, docs_of):
    rows = [(i, f"{i}", "en", "s") for i in range(400)]
    lab = spark.createDataFrame([(i, 1, int(i % 10 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    learnt = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5]
    share = sum(i % 10 == 0 for i in learnt) / len(learnt)
    assert {r["score"] for r in X.score_documents(docs_of(rows), lab, sample=40).collect()} == {share}


def test_toxicity_without_labels(spark, docs_of):
    lab = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in X.score_documents(docs_of([(1, "a", "en", "s")]), lab).collect()] == [0.0]
    assert X.score_documents(docs_of([]), lab).count() == 0


@pytest.mark.parametrize("text,spans", [("", []), ("a. b", ["a.", "b"]), ("x\n\n y z!", ["x", "y z!"])])
def test_sentences(text, spans):
    assert [text[s:e] for s, e in X.sentence_spans(text)] == spans
