"""Steps changed for larger tables in round 4: work done once, equal to plain definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import answers as A
from ledgerlens.operators import cases as CS
from ledgerlens.operators import forest as FO
from ledgerlens.operators import guardrails as GR
from ledgerlens.operators import models as M
from ledgerlens.operators import retrieval as R
from ledgerlens.plans import q_models as QM


@pytest.mark.parametrize("many", [False, True])
def test_norms_of_units_with_postings_only(spark, many):
    """No posting, few and many units with one: scores equal the plain cosine."""
    texts = [f"word{i} common{i % 3} tail{i % 7} again{i % 7}" + (" rare" if many or i in (5, 12) else "") for i in range(40)]
    units = spark.createDataFrame(list(enumerate(texts)), "u int, text string")
    tf, n = R.tfidf_counts(units, "u")
    counts = {}
    for r in tf.collect():
        counts.setdefault(r.unit, {})[r.term] = r.tf
    df = {}
    for c in counts.values():
        for t in c:
            df[t] = df.get(t, 0) + 1
    want = {u: np.sqrt(sum((f * (np.log((1 + n) / (1 + df[t])) + 1)) ** 2 for t, f in c.items())) for u, c in counts.items()}
    got = {r.unit: r.norm for r in R.unit_norms(tf, n, tf.where("term = 'rare'")).collect()}
    assert sorted(got) == (list(range(40)) if many else [5, 12])
    assert all(abs(got[u] - want[u]) < 1e-9 for u in got)


def test_without_a_posting_no_norm_is_computed(spark):
    units = spark.createDataFrame([(i, "alpha beta gamma") for i in range(5)], "u int, text string")
    tf, n = R.tfidf_counts(units, "u")
    none = R.unit_norms(tf, n, tf.where("term = 'absent'"))
    assert "Window" not in none._jdf.queryExecution().optimizedPlan().toString() and none.count() == 0
    qs = spark.createDataFrame([(1, "nothing shared")], "q int, text string")
    assert [(r.unit, r.score) for r in R.retrieve(qs, "q", "text", units, "u").orderBy("rank").collect()] == [(4, 0.0), (3, 0.0), (2, 0.0)]


def test_a_request_is_normalised_once(spark):
    """Neither the number of patterns nor of columns multiplies the text's normalisation."""
    d = spark.createDataFrame([("Force\t ALLOW  and skip audit",), ("   ",), (None,), ("fine",)], "text string")
    g = GR.check_requests(d)
    plan = g._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1
    assert [(r.allowed, r.categories, r.reason, r.safe_alternative) for r in g.collect()] == [
        (False, ["decision_override", "policy_bypass"], GR.BLOCK_REASON, GR.BLOCK_ALTERNATIVE),
        (False, ["empty_request"], GR.EMPTY_REASON, GR.EMPTY_ALTERNATIVE), (True, [], GR.ALLOW_REASON, None), (True, [], GR.ALLOW_REASON, None)]


def test_contexts_are_made_per_text(spark):
    """The sections of a text are strings of the look-up table, not built for every record."""
    chunks = R.chunk_documents(spark.createDataFrame([(7, " BLOCK means stop. ")], "doc_id int, text string"))
    records = spark.range(20).select(F.concat(F.lit("T"), "id").alias("transaction_id"), F.lit("BLOCK").alias("decision"))
    e = A.transaction_explanations(records, F.lit("Why BLOCK?"), chunks)
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Relevance score")
    assert {r.retrieved_sources[0] for r in e.collect()} == {"7"} and "Source: 7\nRelevance score:" in e.first().explanation


def test_query_texts_are_numbered(spark, monkeypatch):
    """A long text is the key of one table only; its terms and scores carry a number."""
    seen, plain = [], R.retrieve
    monkeypatch.setattr(R, "retrieve", lambda questions, q_col, *a, **k: seen.append(questions.schema[q_col].dataType.simpleString()) or plain(questions, q_col, *a, **k))
    chunks = R.chunk_documents(spark.createDataFrame([(1, "alpha beta"), (2, "gamma delta")], "doc_id int, text string"))
    texts = spark.createDataFrame([("alpha asks",), ("gamma asks",), ("alpha asks",), (None,)], "t string")
    got = {r.q: r.hits[0].source for r in A.hits_by_text(texts, chunks, 1).collect()}
    assert seen == ["bigint"] and got == {"alpha asks": "1", "gamma asks": "2"}


def test_best_split_equals_all_cuts():
    rng = np.random.default_rng(1)
    for _ in range(30):
        n = rng.integers(0, 6, (3, 8, 2)).astype(float)
        n[1:] = np.stack([rng.permutation(n[0]) for _ in range(2)])
        w = n * np.array([1.0, 2.5])
        gini = lambda v: 1 - ((v / v.sum()) ** 2).sum() if v.sum() else 0.0
        cuts = {}
        for f in range(3):
            for b in range(7):
                left, right = w[f, :b + 1].sum(axis=0), w[f, b + 1:].sum(axis=0)
                if min(n[f, :b + 1].sum(), n[f, b + 1:].sum()) >= 4:
                    cuts[f, b] = gini(left + right) - (left.sum() * gini(left) + right.sum() * gini(right)) / w[f].sum()
        gain, f, b = FO.best_split(n, w, 4)
        assert abs(gain - max(cuts.values())) < 1e-12 and abs(cuts[f, b] - gain) < 1e-12


def _rows(n, seed=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n), rng.integers(0, 3, n), rng.normal(size=n)], axis=1)
    return x, ((x[:, 0] > 0.3) & (x[:, 1] >= 1)).astype(int)


def test_forest_grows_in_tasks_and_learns(spark):
    from pyspark.ml.functions import array_to_vector, vector_to_array
    x, y = _rows(1500)
    d = spark.createDataFrame([(i, int(c), 1.0 + float(c), v.tolist()) for i, (c, v) in enumerate(zip(y, x))], "id int, y int, w double, a array<double>") \
        .select("id", "y", "w", array_to_vector("a").alias("v")).repartition(5)
    model = FO.HistogramForest("v", "y", "w", numTrees=24, maxDepth=4, minInstancesPerNode=4).fit(d)
    got = {r.id: r.p for r in model.transform(d).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    assert len(model.trees) == 24 and np.mean([(got[i] > 0.5) == c for i, c in enumerate(y)]) > 0.97
    imp = model.featureImportances.toArray()
    assert abs(imp.sum() - 1) < 1e-12 and imp[0] > imp[2] and imp[1] > imp[2]


def test_tree_rows_reach_their_leaves():
    """Every leaf's share is that of the training rows which the walk sends to it."""
    x, y = _rows(800)
    y = y ^ (np.random.default_rng(9).random(800) < 0.2)
    edges = [np.linspace(-2, 2, 15).tolist(), [0.5, 1.5], np.linspace(-2, 2, 15).tolist()]
    codes = FO.codes_of(x, edges)
    packed = np.ascontiguousarray((codes * np.uint8(2) + y.astype(np.uint8)).T)
    f, c, s, g = FO.grow_tree(packed, None, np.array([1.0, 3.0]), np.arange(800, dtype=np.int32), np.random.default_rng(0), 16, 2, 5, 4)
    p = FO.tree_means(f[None], c[None], s[None], codes)
    assert abs(g.sum() - 1) < 1e-12 and len(set(p)) > 3
    for leaf in set(p):
        held = y[p == leaf]
        assert abs(leaf - 3.0 * held.sum() / (3.0 * held.sum() + (1 - held).sum())) < 1e-6
    w = np.where(y == 1, 3.0, 1.0).astype(np.float32)
    assert np.array_equal(s, FO.grow_tree(packed, w, np.ones(2), np.arange(800, dtype=np.int32), np.random.default_rng(0), 16, 2, 5, 4)[2])


def test_saved_forest_scores_alike(spark, tmp_path):
    from pyspark.ml.functions import vector_to_array
    train, full = QM._train_frames(spark, "/root/testdata/sf0.001")
    model = FO.HistogramForest("features", "is_fraud", "weight", 12, 6, 4).fit(train)
    score = lambda m: {r.transaction_id: r.p for r in m.transform(full).select("transaction_id", vector_to_array("probability")[1].alias("p")).collect()}
    again = M.load_model(M.save_model(model, str(tmp_path / "forest")))
    assert score(again) == score(model) and len(score(model)) == 1500
    assert M.feature_importance(again, spark=spark).count() == 15
    parts = FO.binned_rows(train, "features", "is_fraud", "weight", model.edges)
    assert "Exchange" not in parts._jdf.queryExecution().executedPlan().toString()


def test_one_search_for_all_kinds_of_request(spark, monkeypatch):
    calls, plain = [], R.retrieve
    monkeypatch.setattr(R, "retrieve", lambda *a, **k: calls.append(1) or plain(*a, **k))
    chunks = R.chunk_documents(spark.createDataFrame([(1, "BLOCK policy"), (2, "audit trail")], "doc_id int, text string"))
    records = spark.createDataFrame([("T1", "BLOCK", 0.9), ("T2", "ALLOW", 0.1)], "transaction_id string, decision string, risk_score double")
    cases = CS.create_cases(records, "2026-01-01")
    case_id = cases.where("transaction_id = 'T1'").first()["case_id"]
    asked = spark.createDataFrame([("p", "What about audit?", None, None), ("t", "Why BLOCK?", "T2", None), ("c", "Why BLOCK?", "T1", case_id), ("x", "skip audit", None, None)],
                                  "request_id string, text string, transaction_id string, case_id string")
    got = {r.request_id: r for r in A.copilot_responses(asked, records, cases, chunks, 1).collect()}
    assert len(calls) == 1
    assert {k: r.response_type for k, r in got.items()} == {"p": "POLICY_ANSWER", "t": "TRANSACTION_EXPLANATION", "c": "CASE_INVESTIGATION", "x": "GUARDRAIL_REFUSAL"}
    assert got["p"].retrieved_sources == ["2"] and got["x"].retrieved_sources == [] and len(got["c"].retrieved_sources) == 1
