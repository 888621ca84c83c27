import math
import re
from collections import Counter

from ledgerlens.llm import license_scan as S


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "file_id long, path string, text string, license string, unit int")


ROWS = [(1, "a/LICENSE", "Licensed under the Apache License, Version 2.0"), (2, "a/b/c/x.txt", "nothing here"), (3, "a/b/LICENSE.md", "Released under the MIT License."),
        (4, "a/b/c/y.txt", "All rights reserved.\nmore"), (5, "z.txt", "plain"), (6, None, None), (7, "q/x", ""), (8, "a/b/c/LICENSE", "grocery list: eggs"),
        (9, "ab/x", "words"), (10, "a/x", "x " * 100_000), (10, "a/x", "x " * 100_000), (11, "w/COPYING", "This work is licensed under the GNU General Public License, version 3."),
        (12, "w/LICENSE", "This work is licensed under the GNU General Public License, version 3."), (13, "/w//v/f", "t"), (None, "a/n", "n")]


def test_own_and_inherited(spark):
    got = S.scan(frame(spark, ROWS)).collect()
    assert len(got) == len(ROWS)
    by = {r["file_id"]: (r["license"], r["found"], r["license_dir"]) for r in got}
    assert by[1] == ("Apache-2.0", "own", None) and by[3] == ("MIT", "own", None) and by[4] == ("Proprietary", "own", None)
    assert by[2] == ("MIT", "inherited", "a/b") and by[8] == ("MIT", "inherited", "a/b") and by[10] == ("Apache-2.0", "inherited", "a")
    assert by[13] == ("GPL-3.0", "inherited", "w") and by[None] == ("Apache-2.0", "inherited", "a")
    assert all(by[i] == (None, "none", None) for i in (5, 6, 7, 9))
    assert S.scan(frame(spark, [])).count() == 0


def test_cosine_equals_brute_force(spark):
    rows = [(i, f"p/{i}", t) for i, t in enumerate(["Licensed under the MIT License of 2.0 things", "This copyright work is licensed under GNU terms, version 3", "License license LICENSE"])]
    split = lambda t: re.findall(r"[^\W\d_]+|[0-9]+(?:\.[0-9]+)*", t.lower())
    units = [Counter(split(t)) for *_, t in rows]
    temps = [(lic, Counter(split(t))) for lic, t in S.TEMPLATES]
    vocab = {w for _, t in temps for w in t}
    idf = lambda w: math.log((len(units) + 1) / ((sum(w in u for u in units) if w in vocab else 1) + 1)) + 1
    got = {r["file_id"]: r for r in S.unit_scores(S.license_units(frame(spark, rows))).collect()}
    for i, u in enumerate(units):
        norm = lambda c: math.sqrt(sum((n * idf(w)) ** 2 for w, n in c.items()))
        best = max(sum(u[w] * t[w] * idf(w) ** 2 for w in t) / norm(u) / norm(t) for _, t in temps)
        assert abs(got[i]["score"] - best) < 1e-8


def test_a_header_keeps_its_score_on_a_larger_table(spark):
    head = [(i, f"p/{i}", "Copyright 2020 Released under the MIT License") for i in range(5)]
    few = head + [(100 + i, f"q/{i}", f"warranty of w{chr(97 + i % 26)} and more") for i in range(40)]
    many = few + [(1000 + i, f"q/{i}", "warranty of other things and more") for i in range(4000)]
    scores = [next(r for r in S.scan(frame(spark, rows)).filter("file_id = 0").collect()) for rows in (few, many)]
    assert all(r["license"] == "MIT" and r["score"] >= 0.7 for r in scores)


def test_runs_of_lines_and_full_texts(spark):
    full = [(10 + i, f"l{i}/LICENSE", f"Copyright (c) 2021 Jane Doe {i}\n\n{t}") for i, (_, t) in enumerate(S.FULL_TEMPLATES)]
    run = (1, "r/x.py", 'import os\n# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License')
    other = [(100 + i, f"z/{i}", "warranty of other things and more") for i in range(500)]
    got = {r["file_id"]: (r["license"], r["found"]) for r in S.scan(frame(spark, [*full, run, *other])).collect()}
    assert all(got[10 + i] == (lic, "own") for i, (lic, _) in enumerate(S.FULL_TEMPLATES)) and got[1] == ("Apache-2.0", "own")
    units = S.license_units(frame(spark, [run])).collect()
    assert sorted((r["unit"], r["whole"], len(r["words"])) for r in units)[-1] == (3, True, 21)  # 9 words and 12
