"""Calibration and classification metrics over a long score table
``(model, y, p[, pred])`` — every metric for every model in grouped passes
(SURVEY §2.H).

Exact ROC-AUC / average precision need running sums over scores in order.
A window over all scores would put a whole model in one task, so
:func:`ranked_prefix_sums` first aggregates by distinct score, splits each
model's distinct scores into ``buckets`` ranges (approximate quantiles: a
tiny, broadcast boundary table), computes bucket totals (a tiny table whose
exclusive prefix gives each bucket's offset) and finishes with a window
partitioned by (model, bucket). The result is exact whatever the bucket
boundaries are.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import ranked_prefix_sums

P_LO, P_HI = 1e-9, 1.0 - 1e-9


class MetricInputError(ValueError):
    pass


def validate_scores(long: DataFrame, label: str = "y", prob: str = "p") -> None:
    """H1: labels in {0,1}, no NaN/inf probabilities, non-empty. One global
    aggregate (a single-row action), then raise."""
    p = F.col(prob).cast("double")
    row = long.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(~F.col(label).isin(0, 1) | F.col(label).isNull()).alias("bad_y"),
        F.count_if(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))).alias("bad_p"),
    ).first()
    if row["n"] == 0:
        raise MetricInputError("Input array cannot be empty.")
    if row["bad_y"]:
        raise MetricInputError("y_true must contain binary values only: 0/1 or False/True.")
    if row["bad_p"]:
        raise MetricInputError("Probability array cannot contain NaN or infinite values.")


def checked_label(label: str = "y") -> F.Column:
    """H1 inside the plan: the label as an int; a query that meets another value (or null) fails."""
    y = F.col(label).cast("double")
    return F.when(y.isin(0.0, 1.0), y.cast("int")).otherwise(
        F.raise_error("y_true must contain binary values only: 0/1 or False/True.").cast("int"))


def checked_probability(prob: str = "p") -> F.Column:
    """H1 and H2 inside the plan: the clipped probability; null, NaN and infinity fail the query."""
    p = F.col(prob).cast("double")
    bad = p.isNull() | F.isnan(p) | (F.abs(p) == float("inf"))
    return F.when(bad, F.raise_error("Probability array cannot contain NaN or infinite values.").cast("double")) \
        .otherwise(clip_probability(p))


def clip_probability(c) -> F.Column:
    """H2: clip to [1e-9, 1 - 1e-9]."""
    return F.least(F.lit(P_HI), F.greatest(F.lit(P_LO), c.cast("double")))


def brier_logloss(long: DataFrame, model: str = "model") -> DataFrame:
    """H3, H4 (+counts): per model."""
    y, p = F.col("y").cast("double"), F.col("p")
    return long.select(model, checked_label().alias("y"), checked_probability().alias("p")).groupBy(model).agg(
        F.count(F.lit(1)).alias("sample_count"),
        F.sum(F.col("y")).cast("long").alias("positive_count"),
        F.avg(F.pow(p - y, 2)).alias("brier_score"),
        (-F.avg(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss"))


def ranking_metrics(long: DataFrame, model: str = "model", buckets: int = 256) -> DataFrame:
    """H5, H6: exact ROC-AUC (ties count 1/2) and step-wise average precision
    per model; null when a model has a single class."""
    d = (long.select(model, checked_probability().alias("score"), checked_label().cast("long").alias("y"))
         .groupBy(model, "score").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg")))
    c = ranked_prefix_sums(d, [model], "score", ["pos", "neg"], descending=True, buckets=buckets)
    per = c.groupBy(model).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / 2.0)).alias("_auc_num"),
        F.sum(F.col("pos") * (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))).alias("_ap_num"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return per.select(model,
                      F.when(both, F.col("_auc_num") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
                      F.when(both, F.col("_ap_num") / F.col("P")).alias("average_precision"))


def reliability_edges(n_bins: int) -> list[float]:
    if n_bins < 2:
        raise MetricInputError("n_bins must be at least 2.")
    return [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]


def reliability_bins(long: DataFrame, n_bins: int = 10, model: str = "model") -> DataFrame:
    """H7: equal-width bins, left-closed, last bin closed on both ends, empty
    bins emitted as zeros (bin grid x models, right-joined)."""
    edges = reliability_edges(n_bins)
    # literal edges: a sum of comparisons stays in whole-stage codegen
    bin_expr = sum((F.when(F.col("p") >= F.lit(e), F.lit(1)).otherwise(F.lit(0)) for e in edges[2:-1]),
                   F.when(F.col("p") >= F.lit(edges[1]), F.lit(1)).otherwise(F.lit(0)))
    binned = long.select(model, checked_label().cast("double").alias("y"), checked_probability().alias("p")) \
        .withColumn("bin_index", bin_expr)
    agg = binned.groupBy(model, "bin_index").agg(
        F.count(F.lit(1)).alias("count"), F.avg("p").alias("mean_predicted_probability"),
        F.avg("y").alias("observed_fraud_rate"))
    # bin grid per model without a cross join: explode the bin range per model
    edge_arr = F.array(*[F.lit(e) for e in edges])
    g = (long.select(model).distinct()
         .select(model, F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))).alias("bin_index"))
         .withColumns({"lower_bound": F.element_at(edge_arr, F.col("bin_index") + 1),
                       "upper_bound": F.element_at(edge_arr, F.col("bin_index") + 2)}))
    out = g.join(agg, [model, "bin_index"], "left")
    mp = F.coalesce("mean_predicted_probability", F.lit(0.0))
    rate = F.coalesce("observed_fraud_rate", F.lit(0.0))
    return out.select(model, "bin_index", "lower_bound", "upper_bound",
                      F.coalesce("count", F.lit(0)).alias("count"),
                      mp.alias("mean_predicted_probability"), rate.alias("observed_fraud_rate"),
                      F.abs(mp - rate).alias("absolute_gap"))


def calibration_errors(bins: DataFrame, model: str = "model") -> DataFrame:
    """H8: ECE = sum (n_b / n) * gap, MCE = max gap."""
    w = Window.partitionBy(model)
    return (bins.withColumn("_n", F.sum("count").over(w))
            .groupBy(model).agg(
                F.sum(F.col("count") / F.col("_n") * F.col("absolute_gap")).alias("expected_calibration_error"),
                F.max("absolute_gap").alias("maximum_calibration_error")))


def _safe_div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_metrics(long: DataFrame, model: str = "model", digits: int | None = 4) -> DataFrame:
    """H14 (+H16 selection score from unrounded parts needs AP; see
    :func:`leaderboard`): counts, accuracy, precision, recall, F1."""
    y, pr = F.col("y"), F.col("pred")
    c = long.select(model, checked_label().alias("y"), "pred").groupBy(model).agg(
        F.count_if((y == 0) & (pr == 0)).alias("true_negative"),
        F.count_if((y == 0) & (pr == 1)).alias("false_positive"),
        F.count_if((y == 1) & (pr == 0)).alias("false_negative"),
        F.count_if((y == 1) & (pr == 1)).alias("true_positive"))
    tp, fp, fn, tn = (F.col(n) for n in ("true_positive", "false_positive", "false_negative", "true_negative"))
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    f1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    accuracy = (tp + tn) / (tp + tn + fp + fn)
    r = (lambda x: F.bround(x, digits)) if digits is not None else (lambda x: x)
    return c.select(model, "true_negative", "false_positive", "false_negative", "true_positive",
                    r(accuracy).alias("accuracy"), r(precision).alias("precision"),
                    r(recall).alias("recall"), r(f1).alias("f1_score"),
                    precision.alias("_precision"), recall.alias("_recall"), f1.alias("_f1"))


def class_report(long: DataFrame, model: str = "model") -> DataFrame:
    """Per-class precision / recall / F1 / support plus macro and
    weighted averages (zero division -> 0), from one grouped pass."""
    cm = confusion_metrics(long, model, digits=None)
    tp, fp, fn, tn = (F.col(n) for n in ("true_positive", "false_positive", "false_negative", "true_negative"))
    rows = F.array(
        F.struct(F.lit("0").alias("label"), _safe_div(tn, tn + fn).alias("precision"),
                 _safe_div(tn, tn + fp).alias("recall"), _safe_div(2 * tn, 2 * tn + fn + fp).alias("f1_score"),
                 (tn + fp).alias("support")),
        F.struct(F.lit("1").alias("label"), _safe_div(tp, tp + fp).alias("precision"),
                 _safe_div(tp, tp + fn).alias("recall"), _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                 (tp + fn).alias("support")))
    per = cm.select(model, F.inline(rows))
    sums = per.groupBy(model).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        F.sum(F.col("precision") * F.col("support")).alias("sp"),
        F.sum(F.col("recall") * F.col("support")).alias("sr"),
        F.sum(F.col("f1_score") * F.col("support")).alias("sf"), F.sum("support").alias("ts"))
    macro = sums.select(model, F.lit("macro avg").alias("label"), F.col("mp").alias("precision"),
                        F.col("mr").alias("recall"), F.col("mf").alias("f1_score"), F.col("ts").alias("support"))
    weighted = sums.select(model, F.lit("weighted avg").alias("label"),
                           _safe_div(F.col("sp"), F.col("ts")).alias("precision"),
                           _safe_div(F.col("sr"), F.col("ts")).alias("recall"),
                           _safe_div(F.col("sf"), F.col("ts")).alias("f1_score"), F.col("ts").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def leaderboard(long: DataFrame, model: str = "model", buckets: int = 256) -> DataFrame:
    """H14 + H5 + H6 + H16 + H17: one row per model, sorted by selection
    score, AP, recall, F1 (all descending)."""
    cm = confusion_metrics(long, model)
    rk = ranking_metrics(long, model, buckets)
    j = cm.join(rk, model)
    sel = (F.lit(0.45) * F.coalesce("average_precision", F.lit(0.0)) + F.lit(0.30) * F.col("_recall")
           + F.lit(0.20) * F.col("_f1") + F.lit(0.05) * F.col("_precision"))
    return (j.select(model, "accuracy", "precision", "recall", "f1_score",
                     F.bround("roc_auc", 4).alias("roc_auc"), F.bround("average_precision", 4).alias("average_precision"),
                     "true_negative", "false_positive", "false_negative", "true_positive",
                     F.bround(sel, 4).alias("selection_score"), sel.alias("_sel"),
                     F.col("average_precision").alias("_ap"))
            .orderBy(F.desc("_sel"), F.desc("_ap"), F.desc("recall"), F.desc("f1_score"), F.asc(model))
            .drop("_sel", "_ap"))


def calibration_summary(long: DataFrame, n_bins: int = 10, model: str = "model", stage: str | None = None) -> DataFrame:
    """One row per model (and stage) with every calibration metric."""
    base = brier_logloss(long, model)
    rk = ranking_metrics(long, model)
    ce = calibration_errors(reliability_bins(long, n_bins, model), model)
    out = base.join(rk, model).join(ce, model).withColumn(
        "negative_count", F.col("sample_count") - F.col("positive_count"))
    if stage is not None:
        out = out.withColumn("stage", F.lit(stage))
    return out


# ---------------- H9-H11: fitting calibrators with Spark ML ----------------

def fit_calibrator(calib: DataFrame, method: str = "sigmoid"):
    """Fit a sigmoid (Platt) or isotonic calibrator on (y, p). Raises if
    the labels hold a single class (checked with one aggregate)."""
    if method not in ("sigmoid", "isotonic"):
        raise MetricInputError("method must be either 'sigmoid' or 'isotonic'.")
    validate_scores(calib)
    k = calib.agg(F.countDistinct("y").alias("k"), F.count(F.lit(1)).alias("n")).first()
    if k["k"] < 2:
        raise MetricInputError("Calibration labels must contain both classes: 0 and 1.")
    from pyspark.ml.feature import VectorAssembler
    y, p = F.col("y").cast("int").cast("double"), clip_probability(F.col("p"))
    if method == "sigmoid":
        # one weighted row per (probability, label): the same loss on far fewer rows
        rows = calib.groupBy(p.alias("p_clip"), y.alias("label")).agg(F.count(F.lit(1)).cast("double").alias("w"))
        from pyspark.ml.classification import LogisticRegression
        # sklearn: 1/2 ||w||^2 + C * sum(loss), C = 1  <=>  Spark: mean(loss) + reg/2 ||w||^2, reg = 1/n
        est = LogisticRegression(regParam=1.0 / k["n"], elasticNetParam=0.0, standardization=False,
                                 maxIter=200, tol=1e-10, weightCol="w")
    else:
        # Spark pools in one place, so it gets one row per distinct probability: the mean label, weighted
        rows = calib.groupBy(p.alias("p_clip")).agg(F.avg(y).alias("label"), F.count(F.lit(1)).cast("double").alias("w"))
        from pyspark.ml.regression import IsotonicRegression
        est = IsotonicRegression(isotonic=True, weightCol="w")
    return est.fit(VectorAssembler(inputCols=["p_clip"], outputCol="features").transform(rows))


def apply_calibrator(model, target: DataFrame, prob: str = "p") -> DataFrame:
    """Calibrated probability column ``p_calibrated`` clipped to [1e-9, 1-1e-9]."""
    from pyspark.ml.classification import LogisticRegressionModel
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    t = VectorAssembler(inputCols=["_pc"], outputCol="features").transform(
        target.withColumn("_pc", clip_probability(F.col(prob))))
    if isinstance(model, LogisticRegressionModel):
        out = model.setProbabilityCol("_prob").setPredictionCol("_pred").setRawPredictionCol("_raw") \
            .transform(t).withColumn("p_calibrated", vector_to_array("_prob")[1])
        out = out.drop("_prob", "_pred", "_raw")
    else:
        out = model.setPredictionCol("p_calibrated").transform(t)
    return out.withColumn("p_calibrated", clip_probability(F.col("p_calibrated"))).drop("_pc", "features")


def calibration_text(summary: DataFrame, model: str = "model") -> DataFrame:
    """The ten-line calibration summary per model (and stage)."""
    f4 = lambda c: F.format_string("%.4f", F.col(c))
    na = lambda c: F.coalesce(F.format_string("%.4f", F.col(c)), F.lit("N/A"))
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Calibration summary for "), F.col(model), F.lit(":")),
        F.concat(F.lit("- Samples: "), F.col("sample_count").cast("string")),
        F.concat(F.lit("- Positives: "), F.col("positive_count").cast("string")),
        F.concat(F.lit("- Negatives: "), F.col("negative_count").cast("string")),
        F.concat(F.lit("- Brier score: "), f4("brier_score")),
        F.concat(F.lit("- Log loss: "), f4("log_loss")),
        F.concat(F.lit("- ROC-AUC: "), na("roc_auc")),
        F.concat(F.lit("- Average precision: "), na("average_precision")),
        F.concat(F.lit("- Expected calibration error: "), f4("expected_calibration_error")),
        F.concat(F.lit("- Maximum calibration error: "), f4("maximum_calibration_error")))
    keep = [model] + (["stage"] if "stage" in summary.columns else [])
    return summary.select(*keep, text.alias("summary_text"))
