"""Drift and calibration metrics against hand-computed / brute-force values."""

import math

import numpy as np
import pytest

from ledgerlens.operators import drift as G
from ledgerlens.operators import metrics as H


def _psi_numpy(ref, cur, n_bins):
    ref, cur = np.asarray(ref, float), np.asarray(cur, float)
    edges = np.unique(np.quantile(ref, np.linspace(0, 1, n_bins + 1)))
    if edges.size < 3:
        lo, hi = ref.min(), ref.max()
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        edges = np.linspace(lo, hi, n_bins + 1)
    edges[0], edges[-1] = -np.inf, np.inf
    r = np.clip(np.histogram(ref, edges)[0] / ref.size, 1e-6, None)
    c = np.clip(np.histogram(cur, edges)[0] / cur.size, 1e-6, None)
    return max(0.0, float(np.sum((c - r) * np.log(c / r))))


def test_psi_matches_brute_force(spark):
    cases = [(list(range(100, 171, 10)), list(range(500, 641, 20)), 4),
             (list(range(10, 16)), list(range(80, 91, 2)), 3),
             ([5.0] * 6, [5.0, 6.0, 7.0], 3)]
    for ref, cur, nb in cases:
        r = spark.createDataFrame([(float(x),) for x in ref], "x double")
        c = spark.createDataFrame([(float(x),) for x in cur], "x double")
        got = G.numeric_drift(r, c, ["x"], n_bins=nb).first()
        assert math.isclose(got.population_stability_index, _psi_numpy(ref, cur, nb), rel_tol=1e-12)
    assert got.alert_level in ("OK", "WARN", "ALERT")


def test_tvd_decisions(spark):
    r = spark.createDataFrame([("A",), ("A",), ("R",), ("B",)], "d string")
    c = spark.createDataFrame([("B",), ("B",), ("B",), ("R",)], "d string")
    got = G.decision_drift(r, c, "d").first()
    assert math.isclose(got.total_variation_distance, 0.5) and got.alert_level == "ALERT"


def _auc_brute(y, p):
    pos = [pi for yi, pi in zip(y, p) if yi == 1]
    neg = [pi for yi, pi in zip(y, p) if yi == 0]
    s = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg)
    return s / (len(pos) * len(neg))


def _ap_brute(y, p):
    order = sorted(set(p), reverse=True)
    P = sum(y)
    ap, prev_r = 0.0, 0.0
    for t in order:
        tp = sum(1 for yi, pi in zip(y, p) if pi >= t and yi == 1)
        fp = sum(1 for yi, pi in zip(y, p) if pi >= t and yi == 0)
        r = tp / P
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    return ap


def test_ranking_metrics_brute_force(spark):
    rng = np.random.default_rng(7)
    y = [int(v) for v in rng.integers(0, 2, 400)]
    p = [float(round(v, 2)) for v in rng.random(400)]
    long = spark.createDataFrame([("m", yi, pi, int(pi >= 0.5)) for yi, pi in zip(y, p)],
                                 "model string, y int, p double, pred int")
    got = H.ranking_metrics(long, buckets=7).first()  # few buckets: offsets are exercised
    assert math.isclose(got.roc_auc, _auc_brute(y, p), rel_tol=1e-12)
    assert math.isclose(got.average_precision, _ap_brute(y, p), rel_tol=1e-12)


def test_calibration_fixture(spark):
    y = [0, 0, 1, 1, 0, 1]
    p = [0.05, 0.20, 0.70, 0.90, 0.30, 0.80]
    long = spark.createDataFrame([("m", a, b, int(b >= 0.5)) for a, b in zip(y, p)],
                                 "model string, y int, p double, pred int")
    s = H.calibration_summary(long, n_bins=5).first()
    assert s.sample_count == 6 and s.positive_count == 3
    assert math.isclose(s.brier_score, np.mean((np.array(p) - np.array(y)) ** 2), rel_tol=1e-12)
    assert s.roc_auc == 1.0
    bins = H.reliability_bins(long, 5).orderBy("bin_index").collect()
    assert [b["count"] for b in bins] == [1, 2, 0, 1, 2]  # 0.20 opens bin 1, 0.80 opens bin 4


def _raises(df, text):
    with pytest.raises(Exception, match=text):
        df.collect()


def test_bad_inputs_fail_the_query(spark):
    schema = "model string, y int, p double, pred int"
    nan = spark.createDataFrame([("m", 0, 0.2, 0), ("m", 1, float("nan"), 1)], schema)
    lab = spark.createDataFrame([("m", 0, 0.2, 0), ("m", 2, 0.4, 1)], schema)
    for metric in (H.brier_logloss, H.ranking_metrics, H.reliability_bins):
        _raises(metric(nan), "NaN or infinite")
    for metric in (H.brier_logloss, H.ranking_metrics, H.reliability_bins, H.confusion_metrics, H.class_report):
        _raises(metric(lab), "binary values only")
    side = spark.createDataFrame([(None,), (None,)], "amount double")
    _raises(G.numeric_drift(side, spark.createDataFrame([(1.0,), (2.0,)], "amount double"), ["amount"]), "must contain numeric data")


def test_calibrators(spark):
    one = spark.createDataFrame([(0, 0.1), (0, 0.2), (0, 0.3)], "y int, p double")
    for method in ("sigmoid", "isotonic"):
        with pytest.raises(ValueError):
            H.fit_calibrator(one, method)
    rng = np.random.default_rng(5)
    p = [float(v) / 20 for v in rng.integers(1, 20, 300)]
    y = [int(rng.random() < v * v) for v in p]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p double")
    got = {r.p: r.p_calibrated for r in H.apply_calibrator(H.fit_calibrator(df, "isotonic"), df).collect()}
    xs = sorted(set(p))
    mean = lambda a, b: np.mean([yi for yi, pi in zip(y, p) if xs[a] <= pi <= xs[b]])
    for i, x in enumerate(xs):  # the max-min formula of the weighted isotonic fit
        want = max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1))
        assert math.isclose(got[x], min(max(want, 1e-9), 1 - 1e-9), abs_tol=1e-9)
    sig = {r.p: r.p_calibrated for r in H.apply_calibrator(H.fit_calibrator(df, "sigmoid"), df).collect()}
    assert [sig[x] for x in xs] == sorted(sig[x] for x in xs)
    # the optimum of sum(loss) + w^2 / 2
    w0 = np.array([0.0, 0.0])
    X, Y = np.c_[np.ones(len(p)), p], np.array(y)
    for _ in range(50):
        q = 1 / (1 + np.exp(-X @ w0))
        g = X.T @ (q - Y) + np.array([0.0, w0[1]])
        h = X.T @ (X * (q * (1 - q))[:, None]) + np.diag([0.0, 1.0])
        w0 = w0 - np.linalg.solve(h, g)
    assert all(math.isclose(sig[x], 1 / (1 + math.exp(-(w0[0] + w0[1] * x))), abs_tol=1e-4) for x in xs)
