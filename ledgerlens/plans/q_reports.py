"""Registered report queries: summary texts."""

from __future__ import annotations

from ledgerlens.operators import drift as G
from ledgerlens.operators import metrics as H
from ledgerlens.plans import q_drift as QD
from ledgerlens.plans import q_metrics as QM
from ledgerlens.plans.registry import ORACLES, register
from ledgerlens.plans.sql_twins import with_


@register("monitoring_summary_text", with_(QD.DRIFT_CTE, f""",
lv AS (SELECT 0 AS kind, feature_name, alert_level FROM num
       UNION ALL SELECT 1, feature_name, alert_level FROM catd WHERE feature_name <> '{QD.DECISION}'),
dl AS (SELECT total_variation_distance AS tvd, alert_level FROM catd WHERE feature_name = '{QD.DECISION}'),
al AS (SELECT string_agg(feature_name, ', ' ORDER BY kind, feature_name) FILTER (alert_level = 'ALERT') AS a,
              string_agg(feature_name, ', ' ORDER BY kind, feature_name) FILTER (alert_level = 'WARN') AS w,
              count_if(kind = 0) AS n, count_if(kind = 1) AS c FROM lv),
ov AS (SELECT CASE max(CASE alert_level WHEN 'ALERT' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARN' ELSE 'OK' END AS o
       FROM (SELECT alert_level FROM lv UNION ALL SELECT alert_level FROM dl))
SELECT o AS overall_alert_level, concat_ws(chr(10), 'Model monitoring summary:', '- Overall status: ' || o,
  '- Numeric features checked: ' || n, '- Categorical features checked: ' || c,
  '- Decision distribution drift: ' || printf('%.4f', tvd) || ' (' || dl.alert_level || ')',
  '- Alert features: ' || a, '- Warning features: ' || w,
  CASE WHEN a IS NULL AND w IS NULL AND dl.alert_level = 'OK' THEN '- No major drift detected.' END) AS summary_text
FROM al, ov, dl"""))
def q_monitoring_summary_text(spark, sf):
    """Report frames -> summary text."""
    return G.monitoring_summary_text(QD.report_frames(spark, sf))


@register("calibration_text", f"""WITH s AS ({ORACLES['calibration_summary']})
SELECT model, 'Calibration summary for ' || model || E':\\n- Samples: ' || sample_count || E'\\n- Positives: ' || positive_count
  || E'\\n- Negatives: ' || negative_count || E'\\n- Brier score: ' || printf('%.4f', brier_score)
  || E'\\n- Log loss: ' || printf('%.4f', log_loss) || E'\\n- ROC-AUC: ' || coalesce(printf('%.4f', roc_auc), 'N/A')
  || E'\\n- Average precision: ' || coalesce(printf('%.4f', average_precision), 'N/A')
  || E'\\n- Expected calibration error: ' || printf('%.4f', expected_calibration_error)
  || E'\\n- Maximum calibration error: ' || printf('%.4f', maximum_calibration_error) AS summary_text FROM s""")
def q_calibration_text(spark, sf):
    """Per-model calibration summary text."""
    return H.calibration_text(H.calibration_summary(QM.score_long(spark, sf), QM.N_BINS))
