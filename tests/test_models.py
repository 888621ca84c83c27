"""Splits, the forest's samples, flags, and saved models."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import models as M
from ledgerlens.plans import q_models as Q


@pytest.mark.parametrize("digits", [1, 3])
def test_stratified_split_is_exact(spark, digits):
    rows = [(f"t{i}", [0, 0, 0, 1, None][i % 5]) for i in range(1003)] + [("only", 7), ("pair0", 8), ("pair1", 8)]
    df = spark.createDataFrame(rows, "id string, y int").repartition(7)
    got = Counter((r["y"], r["is_test"]) for r in M.stratified_split(df, "id", "y").collect())
    n = Counter(y for _, y in rows)
    assert all(got[y, True] == math.floor(0.25 * n[y] + 0.5) for y in n)
    assert sum(got.values()) == len(rows)
    cuts = {r["y"]: r["cut"] for r in M.stratified_cuts(df, "id", "y", digits=digits).collect()}
    again = Counter((r["y"], r["k"] <= cuts[r["y"]]) for r in df.select("y", M._split_key("id", 42).alias("k")).collect() if r["y"] in cuts)
    assert all(again[y, True] == got[y, True] for y in n if y in cuts)


def test_stratified_split_of_an_empty_table(spark):
    assert M.stratified_split(spark.createDataFrame([], "id string, y int"), "id", "y").count() == 0


def _vectors(spark, n, dim=3):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=dim).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a array<double>").select("id", array_to_vector("a").alias("v"))


def test_every_tree_draws_its_own_rows_from_the_whole_table(spark):
    used = {}
    for n in (100, 3000, 30_000):
        sample, psi = M.tree_samples(_vectors(spark, n), "id", "v", 40, 128)
        rows = sample.select("tree", "key").collect()
        assert psi == min(128, n)
        by_tree = Counter(r["tree"] for r in rows)
        assert by_tree == Counter({t: psi for t in range(40)})
        assert len({(r["tree"], r["key"]) for r in rows}) == len(rows)
        used[n] = len({r["key"] for r in rows})
    # 40 x 128 draws: with replacement over trees, a share 1 - exp(-5120 / n) of the rows
    assert used[100] == 100
    assert abs(used[3000] / 3000 - (1 - math.exp(-5120 / 3000))) < 0.03
    assert abs(used[30_000] / 30_000 - (1 - math.exp(-5120 / 30_000))) < 0.02


def test_samples_are_the_smallest_ranks_and_do_not_depend_on_partitions(spark):
    d = _vectors(spark, 2000)
    keys = {r["id"]: r["k"] for r in d.select("id", F.xxhash64("id", F.lit(42)).alias("k")).collect()}
    ranks = M._ranks(np.array(list(keys.values())), np.arange(5))
    want = {(t, k) for t in range(5) for k in np.array(list(keys.values()))[np.argsort(ranks[:, t])[:64]].tolist()}
    for parts in (1, 9):
        sample, _ = M.tree_samples(d.repartition(parts), "id", "v", 5, 64)
        assert {(r["tree"], r["key"]) for r in sample.collect()} == want


def test_flags_are_the_top_twentieth_of_normal_rows(spark):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(2)
    rows = [(i, 0, rng.normal(size=2).tolist()) for i in range(1000)] + [(2000 + i, 1, (rng.normal(size=2) + 9).tolist()) for i in range(20)]
    d = spark.createDataFrame(rows, "id long, y int, a array<double>").select("id", "y", array_to_vector("a").alias("v"))
    got = M.flag_anomalies(d, "y = 0", "id", "v", n_trees=60).collect()
    normal = [r for r in got if r["y"] == 0]
    assert sum(r["predicted_anomaly"] for r in normal) == 50
    assert all(r["predicted_anomaly"] for r in got if r["y"] == 1)
    assert min(r["isolation_forest_anomaly_score"] for r in normal) == 0 and max(r["isolation_forest_anomaly_score"] for r in normal) == 100


def test_transactions_are_flagged(spark):
    rows = Q.q_transaction_anomaly(spark, "/root/testdata/sf0.001").collect()
    train = [r for r in rows if not r["is_test"] and r["is_fraud"] == 0]
    assert len(rows) == 1500 and abs(sum(r["predicted_anomaly"] for r in train) / len(train) - 0.05) < 0.01
    assert all(0 <= r["isolation_forest_anomaly_score"] <= 100 for r in rows)


def test_standardized_rows_have_mean_0_and_deviation_1(spark):
    d = spark.createDataFrame([(float(i), 5.0) for i in range(10)], "a double, b double")
    z = M.standardize(d, M.fit_standardizer(d, ["a", "b"]), ["a", "b"]).agg(F.avg("a"), F.stddev_pop("a"), F.max("b"), F.min("b")).first()
    assert abs(z[0]) < 1e-12 and abs(z[1] - 1) < 1e-12 and z[2] == z[3] == 0.0


def test_saved_model_scores_alike(spark, tmp_path):
    train, full = Q._train_frames(spark, "/root/testdata/sf0.001")
    model, scored = M.fit_and_score(train, full, "Logistic Regression")
    again = M.load_model(M.save_model(model, str(tmp_path / "model"))).transform(full)
    from pyspark.ml.functions import vector_to_array
    want = {r["transaction_id"]: r["logistic_regression_probability"] for r in scored.collect()}
    got = {r["transaction_id"]: r["p"] for r in again.select("transaction_id", vector_to_array("probability")[1].alias("p")).collect()}
    assert got == want and len(got) == 1500


def test_score_table_query_holds_every_supervised_model(spark, monkeypatch):
    """The fits themselves are left to the queries of each model."""
    fitted = []

    def constant(train, score_on, name, seed=42):
        fitted.append(name)
        s = M.slug(name)
        return None, score_on.withColumns({f"{s}_probability": F.lit(0.5), f"{s}_score": F.lit(50)})

    monkeypatch.setattr(M, "fit_and_score", constant)
    got = Q.q_model_score_table(spark, "/root/testdata/sf0.001")
    assert fitted == list(M.supervised_estimators()) and len(fitted) == 4
    assert {f"{M.slug(n)}_{c}" for n in fitted for c in ("probability", "score")} <= set(got.columns)
    assert got.count() == 1500
