"""Steps changed for larger tables: equal to plain definitions, computed once and spread."""

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from ledgerlens.operators import answers as A
from ledgerlens.operators import models as M
from ledgerlens.operators import retrieval as R
from ledgerlens.plans import q_answers as QA
from ledgerlens.plans import q_models as QM

SF = "/root/testdata/sf0.001"


def test_packed_forest_walks_as_its_trees():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)).round(1)
    names = ["feature", "threshold", "left", "right", "size"]
    forest = {t: pd.DataFrame(dict(zip(names, M._grow_tree(x[rng.choice(300, 40, False)], rng, 6)))) for t in range(7)}
    packed = M._pack_forest(forest, 6)

    def walk(tree, row):
        node = depth = 0
        while tree["feature"][node] >= 0:
            node = tree["left"][node] if row[tree["feature"][node]] < tree["threshold"][node] else tree["right"][node]
            depth += 1
        return depth + M._c(tree["size"][node])

    want = [np.mean([walk(t, row) for t in forest.values()]) for row in x]
    assert np.allclose(M._path_lengths(packed, x), want, rtol=0, atol=1e-12)


def test_training_rows_are_a_table_on_all_cores(spark):
    train, full = QM._train_frames(spark, SF)
    cores = spark.sparkContext.defaultParallelism
    assert "shuffle" not in train._jdf.queryExecution().executedPlan().toString().lower() and len(full.inputFiles()) == cores
    assert full.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_blocks_hold_every_best_unit():
    """Against all scores, with many exact ties across the cut."""
    rng = np.random.default_rng(5)
    n_units, n_terms, k = 700, 30, 3
    dense = rng.integers(0, 3, (n_units, n_terms)) * (rng.random((n_units, n_terms)) < 0.2)
    dense[400:] = dense[:300]
    unit, tid = np.nonzero(dense)
    qs = rng.random((40, n_terms)) * (rng.random((40, n_terms)) < 0.15)
    q, qt = np.nonzero(qs)
    gq, gu, gs = R.best_of_block(tid, unit, dense[unit, tid].astype(float), n_units, q, qt, qs[q, qt], k)
    for i in range(40):
        score = (dense @ qs[i]).round(9)
        want = [u for u in np.lexsort((-np.arange(n_units), -score)) if score[u] > 0][:k]
        mine = gq == i
        got = gu[mine][np.lexsort((-gu[mine], -gs[mine].round(9)))][:k]
        assert got.tolist() == want and np.allclose(gs[mine][np.lexsort((-gu[mine], -gs[mine].round(9)))][:k], score[want])


def test_no_pair_of_question_and_unit_is_shuffled(spark):
    """Only best rows leave the blocks, whatever the number of units with a common term."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text"))
    qs = spark.range(20).select(F.col("id").alias("q"), F.lit("same words").alias("text"))
    got = R.retrieve(qs, "q", "text", docs, "doc_id", k=3)
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.q, r.unit) for r in got.collect()} == {(q, u) for q in range(20) for u in (2999, 2998, 2997)}


def test_repeated_units_and_empty_texts_count_as_one(spark):
    units = spark.createDataFrame([(1, "alpha beta"), (1, "beta gamma"), (2, ""), (3, None), (4, "gamma")], "u int, text string")
    raw, idf, _ = R.tfidf_raw(units, "u")
    assert {(r.term, r.df) for r in idf.collect()} == {("alpha", 1), ("beta", 1), ("gamma", 2), ("alpha beta", 1), ("beta gamma", 1)}
    n = {r.term: round(r.raw / (np.log(5 / 2) + 1), 9) for r in raw.where("unit = 1").collect() if r.term != "gamma"}
    assert n == {"alpha": 1, "beta": 2, "alpha beta": 1, "beta gamma": 1}


def test_records_are_not_shuffled_for_their_texts(spark):
    for plan in (QA.q_create_and_investigate(spark, SF), QA.q_explanations(spark, SF), QA.q_investigation_reports(spark, SF),
                 QA.q_case_investigation_reports(spark, SF)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_created_cases_carry_columns(spark):
    rec = spark.createDataFrame([("T1", "ALLOW", 0.1, "r1"), ("T1", "BLOCK", 0.9, "r2")], "transaction_id string, decision string, risk_score double, request_id string")
    made = A.create_and_investigate(rec.withColumn("text", F.lit("Investigate.")), R.chunk_documents(
        spark.createDataFrame([(7, "BLOCK means stop.")], "doc_id int, text string")))
    assert sorted(r.request_id for r in made.collect()) == ["r1", "r2"]
