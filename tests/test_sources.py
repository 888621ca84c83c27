"""Tolerant scans, report sets committed as a whole, policies as a table, bracketed quantiles."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.operators import cost as CO
from ledgerlens.operators import dashboard as K
from ledgerlens.sources import tables as T


def test_tolerant_csv_keeps_every_line_once(spark, tmp_path):
    lines = ["id,amount,ok", "1,2.5,true", "2,abc,false", "3,4.5", "4,,true", "5,1e3,true,extra", '"6",7,"true"', "x,1,true", ",,"]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    good, bad = T.read_tolerant(spark, str(tmp_path / "a.csv"), "id int, amount double, ok boolean")
    assert sorted((r["id"] is None, r["id"] or 0, r["amount"]) for r in good.collect()) == [(False, 1, 2.5), (False, 4, None), (False, 6, 7.0), (True, 0, None)]
    rows = bad.collect()
    assert sorted(r["line"] for r in rows) == ["2,abc,false", "3,4.5", "5,1e3,true,extra", "x,1,true"] and all(r["file"].endswith("a.csv") for r in rows)
    assert good.count() + bad.count() == len(lines) - 1
    # whichever columns are read, the same rows are good
    assert good.select("id").count() == good.select("ok").count() == 4


def test_tolerant_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "v": "x"}\n{"id": 2, "v":\n{"id": "no", "v": "y"}\n{"v": "z"}\n')
    good, bad = T.read_tolerant(spark, str(tmp_path / "a.json"), "id int, v string", fmt="json")
    assert sorted((r["id"] or 0, r["v"]) for r in good.collect()) == [(0, "z"), (1, "x")] and bad.count() == 2


def test_report_set_is_seen_whole_or_not_at_all(spark, tmp_path):
    out = str(tmp_path / "rep")
    one = {"a": spark.range(3).toDF("x"), "b": spark.range(2).toDF("y")}
    assert T.read_report_set(spark, out) == {}
    broken = {"a": spark.range(9).toDF("x"), "b": spark.range(1).select(F.raise_error("midway").alias("y"))}
    with pytest.raises(Exception, match="midway"):
        T.commit_report_set(broken, out)
    assert T.read_report_set(spark, out) == {}
    first = T.commit_report_set(one, out)
    with pytest.raises(Exception, match="midway"):
        T.commit_report_set(broken, out)
    got = T.read_report_set(spark, out)
    assert {n: f.count() for n, f in got.items()} == {"a": 3, "b": 2}
    second = T.commit_report_set({"a": spark.range(5).toDF("x")}, out)
    assert first < second and {n: f.count() for n, f in T.read_report_set(spark, out).items()} == {"a": 5}
    assert got["a"].count() == 3  # a reader of the earlier version keeps it
    assert len(os.listdir(os.path.join(out, "manifests"))) >= 2


def test_policies_hold_from_their_time_on(spark):
    d = lambda n: dt.datetime(2024, 1, n)
    policies = spark.createDataFrame([("a", d(1), 0.3, 0.6), ("a", d(10), 0.1, 0.2), ("b", d(5), 0.9, 0.95), ("a", d(10), 0.1, 0.9)],
                                     "segment string, valid_from timestamp, review_threshold double, block_threshold double")
    rows = spark.createDataFrame([("r0", "a", d(1), 0.5), ("r1", "a", d(9), 0.7), ("r2", "a", d(10), 0.5), ("r3", "b", d(4), 0.5), ("r4", "b", d(6), 0.5), ("r5", "c", d(6), 0.8),
                                  ("r6", None, d(6), 0.1), ("r7", "a", None, 0.5)], "transaction_id string, seg string, ts timestamp, fraud_probability double")
    got = {r["transaction_id"]: r for r in CO.cost_decisions_by_policy(rows, policies, "seg", "ts").collect()}
    assert {k: r["decision"] for k, r in got.items()} == {"r0": "REVIEW", "r1": "BLOCK", "r2": "BLOCK", "r3": "REVIEW", "r4": "ALLOW", "r5": "BLOCK", "r6": "ALLOW", "r7": "REVIEW"}
    assert got["r2"]["reasons"][-1] == "Adjusted risk 0.500 exceeds block threshold 0.200" and got["r3"]["policy_from"] is None


@pytest.mark.parametrize("accuracy", [3, 20, 10_000])
def test_bracketed_quantiles(spark, accuracy):
    rng = np.random.default_rng(4)
    groups = {"ties": rng.integers(0, 5, 3000).astype(float), "wide": rng.normal(size=4000) * 1e6, "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "same": np.full(500, 3.0)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs] + [("ties", None)], "g string, v double").repartition(5)
    levels = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0, 0.5]
    got = {r["g"]: r for r in exact_quantiles(df, "v", levels, ["g"], accuracy=accuracy, extra=[F.avg("v").alias("mean")]).collect()}
    for g, vs in groups.items():
        assert np.allclose(got[g]["qs"], np.quantile(vs, levels), rtol=1e-12), g
        assert got[g]["n"] == len(vs) and np.isclose(got[g]["mean"], vs.mean())


def test_rows_of_matching_keys(spark):
    d = spark.createDataFrame([("a", 1), ("a", 9), ("b", 2), (None, 9), ("c", None)], "transaction_id string, v int")
    assert sorted((r[0], r[1]) for r in K.rows_of_matching_keys(d, F.col("v") > 5).collect()) == [("a", 1), ("a", 9)]
