"""Registered metric queries (H) over long score tables built from the
decision flow (seven score columns vs ``is_fraud``) and from ``labels`` x
``documents`` (a length-based score vs quality / toxicity labels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import metrics as H
from ledgerlens.operators import models as M
from ledgerlens.plans import decisions as D
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import FINAL_CTE, with_
from ledgerlens.sources.tables import read_table

# (model name, 0-100 score column) scored against is_fraud; pred = score >= 50.
SCORE_MODELS = [
    ("ml_fraud", "ml_fraud_score"),
    ("isolation_forest", "isolation_forest_anomaly_score"),
    ("autoencoder", "autoencoder_anomaly_score"),
    ("gradient_boosting", "gradient_boosting_score"),
    ("random_forest", "random_forest_score"),
    ("logistic_regression", "logistic_regression_score"),
    ("mlp_neural_network", "mlp_neural_network_score"),
]
# (model name, label column, probability SQL over documents.n_chars)
DOC_MODELS = [
    ("doc_length_quality", "quality", "n_chars / (n_chars + 1000e0)"),
    ("doc_length_toxic", "toxic", "1000e0 / (n_chars + 1000e0)"),
]
N_BINS = 10
R9 = 9


def score_long(spark, sf):
    """Long (model, y, p, pred) table: one row per (transaction, model) plus
    one per (labelled document, model)."""
    final = D.final_decisions(spark, sf)
    arr = F.array(*[F.struct(F.lit(m).alias("model"), (F.col(c) / F.lit(100.0)).alias("p"),
                             F.when(F.col(c) >= 50, 1).otherwise(0).alias("pred")) for m, c in SCORE_MODELS])
    tx = final.select(F.col("is_fraud").alias("y"), F.inline(arr)).select("model", "y", "p", "pred")
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    lab = read_table(spark, sf, "labels").join(docs, "doc_id")
    parts = [tx]
    for m, label, expr in DOC_MODELS:
        p = F.expr(expr)
        parts.append(lab.select(F.lit(m).alias("model"), F.col(label).alias("y"), p.alias("p"),
                                F.when(p >= 0.5, 1).otherwise(0).alias("pred")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _long_sql() -> str:
    parts = [f"SELECT '{m}' AS model, is_fraud AS y, {c} / 100e0 AS p, CASE WHEN {c} >= 50 THEN 1 ELSE 0 END AS pred FROM final"
             for m, c in SCORE_MODELS]
    for m, label, expr in DOC_MODELS:
        parts.append(f"SELECT '{m}', {label}, {expr}, CASE WHEN {expr} >= 0.5 THEN 1 ELSE 0 END "
                     f"FROM labels JOIN (SELECT doc_id, n_chars FROM documents) d ON labels.doc_id = d.doc_id")
    return "\n  UNION ALL ".join(parts)


METRIC_CTE = FINAL_CTE + f""",
lt AS ({_long_sql()}),
lc AS (SELECT model, y, pred, least(1e0 - 1e-9, greatest(1e-9, p)) AS pc FROM lt),
bl AS (SELECT model, count(*) AS sample_count, CAST(sum(y) AS BIGINT) AS positive_count,
         avg(pow(pc - y, 2)) AS brier_score, -avg(y * ln(pc) + (1 - y) * ln(1 - pc)) AS log_loss FROM lc GROUP BY model),
dd AS (SELECT model, pc AS score, sum(y) AS pos, count(*) - sum(y) AS neg FROM lc GROUP BY ALL),
cu AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_pos,
              sum(neg) OVER (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cum_neg FROM dd),
rk AS (SELECT model, sum(pos) AS P, sum(neg) AS N,
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(neg * (cum_pos - pos + pos / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) END AS roc_auc,
         CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cum_pos / CAST(cum_pos + cum_neg AS DOUBLE))) / sum(pos) END AS average_precision
       FROM cu GROUP BY model),
bins AS (SELECT model, len(list_filter([{', '.join(f"'{e!r}'::DOUBLE" for e in H.reliability_edges(N_BINS)[1:-1])}], lambda e: e <= pc)) AS bin_index,
           count(*) AS cnt, avg(pc) AS mp, avg(y) AS rate FROM lc GROUP BY ALL),
grid AS (SELECT model, unnest(range(0, {N_BINS})) AS bin_index FROM (SELECT DISTINCT model FROM lc)),
rb AS (SELECT g.model, g.bin_index, coalesce(b.cnt, 0) AS cnt, coalesce(b.mp, 0e0) AS mp, coalesce(b.rate, 0e0) AS rate,
         abs(coalesce(b.mp, 0e0) - coalesce(b.rate, 0e0)) AS gap
       FROM grid g LEFT JOIN bins b ON g.model = b.model AND g.bin_index = b.bin_index),
cm AS (SELECT model, count_if(y = 0 AND pred = 0) AS tn, count_if(y = 0 AND pred = 1) AS fp,
         count_if(y = 1 AND pred = 0) AS fn, count_if(y = 1 AND pred = 1) AS tp FROM lc GROUP BY model),
cmm AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0e0 END AS prec,
          CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0e0 END AS rec,
          CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0e0 END AS f1,
          (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE) AS acc FROM cm)"""


@register("brier_logloss", with_(METRIC_CTE, f"""SELECT model, sample_count, positive_count,
  round_even(brier_score, {R9}) AS brier_score, round_even(log_loss, {R9}) AS log_loss FROM bl"""))
def q_brier_logloss(spark, sf):
    b = H.brier_logloss(score_long(spark, sf))
    return b.select("model", "sample_count", "positive_count", F.bround("brier_score", R9).alias("brier_score"),
                    F.bround("log_loss", R9).alias("log_loss"))


@register("roc_auc", with_(METRIC_CTE, f"SELECT model, round_even(roc_auc, {R9}) AS roc_auc FROM rk"))
def q_roc_auc(spark, sf):
    return H.ranking_metrics(score_long(spark, sf)).select("model", F.bround("roc_auc", R9).alias("roc_auc"))


@register("average_precision", with_(METRIC_CTE, f"SELECT model, round_even(average_precision, {R9}) AS average_precision FROM rk"))
def q_average_precision(spark, sf):
    return H.ranking_metrics(score_long(spark, sf)).select(
        "model", F.bround("average_precision", R9).alias("average_precision"))


@register("reliability_bins", with_(METRIC_CTE, f"""SELECT model, bin_index, CAST(cnt AS BIGINT) AS count,
  round_even(mp, {R9}) AS mean_predicted_probability, round_even(rate, {R9}) AS observed_fraud_rate,
  round_even(gap, {R9}) AS absolute_gap FROM rb"""))
def q_reliability_bins(spark, sf):
    b = H.reliability_bins(score_long(spark, sf), N_BINS)
    return b.select("model", "bin_index", "count",
                    *[F.bround(c, R9).alias(c) for c in ("mean_predicted_probability", "observed_fraud_rate",
                                                          "absolute_gap")])


@register("ece_mce", with_(METRIC_CTE, f""", tot AS (SELECT model, sum(cnt) AS n FROM rb GROUP BY model)
SELECT rb.model, round_even(sum(cnt / CAST(n AS DOUBLE) * gap), {R9}) AS expected_calibration_error,
  round_even(max(gap), {R9}) AS maximum_calibration_error FROM rb JOIN tot ON rb.model = tot.model GROUP BY rb.model"""))
def q_ece_mce(spark, sf):
    e = H.calibration_errors(H.reliability_bins(score_long(spark, sf), N_BINS))
    return e.select("model", F.bround("expected_calibration_error", R9).alias("expected_calibration_error"),
                    F.bround("maximum_calibration_error", R9).alias("maximum_calibration_error"))


@register("confusion_metrics", with_(METRIC_CTE, """SELECT model, tn AS true_negative, fp AS false_positive,
  fn AS false_negative, tp AS true_positive, round_even(acc, 4) AS accuracy, round_even(prec, 4) AS precision,
  round_even(rec, 4) AS recall, round_even(f1, 4) AS f1_score FROM cmm"""))
def q_confusion_metrics(spark, sf):
    return H.confusion_metrics(score_long(spark, sf)).drop("_precision", "_recall", "_f1")


@register("class_report", with_(METRIC_CTE, f""", pc AS (
  SELECT model, '0' AS label, CASE WHEN tn + fn > 0 THEN tn / CAST(tn + fn AS DOUBLE) ELSE 0e0 END AS precision,
    CASE WHEN tn + fp > 0 THEN tn / CAST(tn + fp AS DOUBLE) ELSE 0e0 END AS recall,
    CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) ELSE 0e0 END AS f1_score, tn + fp AS support FROM cm
  UNION ALL
  SELECT model, '1', CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0e0 END,
    CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0e0 END,
    CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0e0 END, tp + fn FROM cm),
allr AS (
  SELECT * FROM pc
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1_score), sum(support) FROM pc GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1_score * support) / sum(support), sum(support) FROM pc GROUP BY model)
SELECT model, label, round_even(precision, {R9}) AS precision, round_even(recall, {R9}) AS recall,
  round_even(f1_score, {R9}) AS f1_score, CAST(support AS BIGINT) AS support FROM allr"""))
def q_class_report(spark, sf):
    r = H.class_report(score_long(spark, sf))
    return r.select("model", "label", *[F.bround(c, R9).alias(c) for c in ("precision", "recall", "f1_score")],
                    F.col("support").cast("long").alias("support"))


@register("model_leaderboard", with_(METRIC_CTE, """SELECT cmm.model, round_even(acc, 4) AS accuracy,
  round_even(prec, 4) AS precision, round_even(rec, 4) AS recall, round_even(f1, 4) AS f1_score,
  round_even(roc_auc, 4) AS roc_auc, round_even(average_precision, 4) AS average_precision,
  tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive,
  round_even(0.45e0 * coalesce(average_precision, 0e0) + 0.30e0 * rec + 0.20e0 * f1 + 0.05e0 * prec, 4) AS selection_score
FROM cmm JOIN rk ON cmm.model = rk.model"""))
def q_model_leaderboard(spark, sf):
    return H.leaderboard(score_long(spark, sf))


@register("best_model", with_(METRIC_CTE, """SELECT cmm.model,
  round_even(0.45e0 * coalesce(average_precision, 0e0) + 0.30e0 * rec + 0.20e0 * f1 + 0.05e0 * prec, 4) AS selection_score
FROM cmm JOIN rk ON cmm.model = rk.model
ORDER BY 0.45e0 * coalesce(average_precision, 0e0) + 0.30e0 * rec + 0.20e0 * f1 + 0.05e0 * prec DESC,
  average_precision DESC, round_even(rec, 4) DESC, round_even(f1, 4) DESC, cmm.model LIMIT 1"""))
def q_best_model(spark, sf):
    """H17 top-1 summary."""
    return H.leaderboard(score_long(spark, sf)).select("model", "selection_score").limit(1)


@register("calibration_summary", with_(METRIC_CTE, f""", tot AS (SELECT model, sum(cnt) AS n FROM rb GROUP BY model),
ce2 AS (SELECT rb.model, sum(cnt / CAST(n AS DOUBLE) * gap) AS ece, max(gap) AS mce FROM rb JOIN tot ON rb.model = tot.model GROUP BY rb.model)
SELECT bl.model, sample_count, positive_count, sample_count - positive_count AS negative_count,
  round_even(brier_score, {R9}) AS brier_score, round_even(log_loss, {R9}) AS log_loss,
  round_even(roc_auc, {R9}) AS roc_auc, round_even(average_precision, {R9}) AS average_precision,
  round_even(ece, {R9}) AS expected_calibration_error, round_even(mce, {R9}) AS maximum_calibration_error
FROM bl JOIN rk ON bl.model = rk.model JOIN ce2 ON bl.model = ce2.model"""))
def q_calibration_summary(spark, sf):
    s = H.calibration_summary(score_long(spark, sf), N_BINS)
    return s.select("model", "sample_count", "positive_count", "negative_count",
                    *[F.bround(c, R9).alias(c) for c in ("brier_score", "log_loss", "roc_auc", "average_precision",
                                                          "expected_calibration_error", "maximum_calibration_error")])


def _calibrated(spark, sf, method):
    """The calibrator of the ml_fraud score is fitted on the training part of the hash
    split; the summaries before and after are of the held-out part."""
    final = D.final_decisions(spark, sf)
    long = final.select(M.hash_split(final, "transaction_id").alias("held_out"), F.lit("ml_fraud").alias("model"),
                        F.col("is_fraud").alias("y"), (F.col("ml_fraud_score") / F.lit(100.0)).alias("p"),
                        F.when(F.col("ml_fraud_score") >= 50, 1).otherwise(0).alias("pred"))
    held_out = long.where("held_out").drop("held_out")
    model = H.fit_calibrator(long.where("not held_out"), method)
    after = H.apply_calibrator(model, held_out).select("model", "y", F.col("p_calibrated").alias("p"), "pred")
    return (H.calibration_summary(held_out, N_BINS, stage="before")
            .unionByName(H.calibration_summary(after, N_BINS, stage="after")))


@register("sigmoid_calibration")
def q_sigmoid_calibration(spark, sf):
    """Platt calibration of the ml_fraud score (Spark ML LR), then the before/after
    calibration summary of held-out rows (rows-only: model fits differ in bits)."""
    return _calibrated(spark, sf, "sigmoid")


@register("isotonic_calibration")
def q_isotonic_calibration(spark, sf):
    """Isotonic calibration (Spark ML PAV), before/after summary of held-out rows."""
    return _calibrated(spark, sf, "isotonic")
