"""Exact quantiles, exact forest samples, complete streams and cheap plans."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.operators import models as M
from ledgerlens.plans import catalog
from ledgerlens.streaming import scoring as S

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("buckets", [4, 256])
def test_quantiles_equal_numpy(spark, buckets):
    rng = np.random.default_rng(2)
    rows = [("a", float(x)) for x in rng.standard_normal(999)] + [("b", float(x)) for x in rng.integers(0, 5, 400)] + [("c", 3.0), ("d", None)]
    levels = [0.0, 0.1, 0.25, 0.5, 0.95, 1.0]
    got = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", levels, ["g"], buckets=buckets).collect()}
    assert set(got) == {"a", "b", "c"}
    for g, r in got.items():
        own = [v for k, v in rows if k == g]
        assert np.allclose(r["qs"], np.quantile(own, levels), rtol=1e-12, atol=1e-12)
        assert (r["n"], r["mn"], r["mx"]) == (len(own), min(own), max(own))


def test_quantiles_without_groups_or_rows(spark):
    d = spark.range(11).select(F.col("id").cast("double").alias("v"))
    assert exact_quantiles(d, "v", [0.5, 0.95]).first()["qs"] == [5.0, 9.5]
    assert exact_quantiles(d.limit(0), "v", [0.5]).count() == 0


@pytest.mark.parametrize("n", [40, 900])
def test_every_tree_has_exactly_psi_rows(spark, n):
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(n)]
    d = spark.createDataFrame(rows, "id long, x array<double>").select("id", array_to_vector("x").alias("v"))
    forest, psi = M.isolation_forest_fit(d, "id", "v", n_trees=30, sample_size=64)
    assert psi == min(64, n) and len(forest) == 30
    assert all(t["size"].iloc[0] == psi for t in forest.values())
    scores = M.isolation_forest_score(d, forest, psi, "v").agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < scores[0] <= scores[1] < 1


def _folder(spark, tmp_path, table, parts=4):
    path = str(tmp_path / f"{table}.parquet")
    spark.read.parquet(f"{SF}/{table}.parquet").repartition(parts).write.parquet(path)
    return str(tmp_path)


def test_streams_read_folders_and_lose_nothing(spark, tmp_path):
    for table in ("events", "orders"):
        _folder(spark, tmp_path, table)
    q = catalog.queries()
    for name in ("stream_velocity", "stream_scoring", "stream_case_status"):
        one, many = (sorted(map(repr, q[name](spark, sf).collect())) for sf in (SF, str(tmp_path)))
        assert one == many and one
    events = spark.read.parquet(f"{SF}/events.parquet").count()
    assert q["stream_velocity"](spark, str(tmp_path)).agg(F.sum("n")).first()[0] == 2 * events


def test_state_table_keeps_the_latest_of_many_batches(spark, tmp_path):
    src = str(tmp_path / "in")
    rows = [(f"c{i % 5}", f"s{i}", f"2024-01-{1 + i:02d}") for i in range(20)]
    for i in range(0, 20, 5):
        spark.createDataFrame(rows[i:i + 5], "case_id string, status string, updated_at string").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("case_id string, status string, updated_at string").option("maxFilesPerTrigger", 1).parquet(src)
    out = S.run_state_table(S.latest_status_stream(stream), str(tmp_path / "out"), str(tmp_path / "ck"), "case_id")
    assert {r["case_id"]: r["status"] for r in out.collect()} == {f"c{i}": f"s{15 + i}" for i in range(5)}
    assert len([d for d in os.listdir(tmp_path / "out") if d.startswith("batch=")]) > 1


def test_case_filter_is_not_pushed_into_the_scoring_chain(spark):
    plan = catalog.queries()["case_evidence"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 50_000 and "Filter ((upper(" not in plan
