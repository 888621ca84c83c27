"""Independent DuckDB SQL twins of the decision-system-1 operators.

These are hand-written SQL restatements used only as the correctness oracle
(driver tables are pre-registered as views). Double literals use exponent
notation so both engines do IEEE double arithmetic (``0.45`` would be a
DECIMAL in DuckDB).
"""

from __future__ import annotations

from ledgerlens.sources.fixtures import bench_sql, requests_sql, txn_sql

FLAGS = ["daily_limit_breach", "large_amount_anomaly", "velocity_spike", "new_beneficiary_risk",
         "account_takeover_signal", "high_merchant_risk", "suspicious_hour_activity",
         "failed_login_risk"]


def _ieee(a: str, b: str) -> str:
    return (f"CASE WHEN ({b}) <> 0 THEN ({a}) / ({b}) WHEN ({a}) > 0 THEN 'Infinity'::DOUBLE "
            f"WHEN ({a}) < 0 THEN '-Infinity'::DOUBLE ELSE 'NaN'::DOUBLE END")


RULES_CTE = f"""
t AS ({txn_sql()}),
d AS (
  SELECT *, daily_total_before_txn + amount AS total_after_txn,
    {_ieee('daily_total_before_txn + amount', 'daily_limit')} AS daily_limit_utilization,
    {_ieee('amount', 'avg_amount_30d')} AS amount_to_avg_ratio
  FROM t),
f AS (
  SELECT *,
    CASE WHEN total_after_txn > daily_limit THEN 1 ELSE 0 END AS daily_limit_breach,
    CASE WHEN NOT isnan(amount_to_avg_ratio) AND amount_to_avg_ratio >= 5e0 THEN 1 ELSE 0 END AS large_amount_anomaly,
    CASE WHEN tx_count_2min >= 5 THEN 1 ELSE 0 END AS velocity_spike,
    CASE WHEN beneficiary_age_days <= 7 AND NOT isnan(amount_to_avg_ratio) AND amount_to_avg_ratio >= 3e0 THEN 1 ELSE 0 END AS new_beneficiary_risk,
    CASE WHEN is_new_device = 1 AND is_new_location = 1 AND failed_login_count_1h >= 3 THEN 1 ELSE 0 END AS account_takeover_signal,
    CASE WHEN merchant_risk_score >= 70 THEN 1 ELSE 0 END AS high_merchant_risk,
    CASE WHEN hour_of_day <= 4 OR hour_of_day >= 23 THEN 1 ELSE 0 END AS suspicious_hour_activity,
    CASE WHEN failed_login_count_1h >= 3 THEN 1 ELSE 0 END AS failed_login_risk
  FROM d),
s AS (
  SELECT *,
    least(100, greatest(0, 30 * daily_limit_breach + 20 * large_amount_anomaly + 20 * velocity_spike
      + 15 * new_beneficiary_risk + 30 * account_takeover_signal + 10 * high_merchant_risk
      + 5 * suspicious_hour_activity + 10 * failed_login_risk)) AS rule_risk_score,
    coalesce(nullif(concat_ws('|',
      CASE WHEN daily_limit_breach = 1 THEN 'DAILY_LIMIT_BREACH' END,
      CASE WHEN large_amount_anomaly = 1 THEN 'LARGE_AMOUNT_ANOMALY' END,
      CASE WHEN velocity_spike = 1 THEN 'VELOCITY_SPIKE' END,
      CASE WHEN new_beneficiary_risk = 1 THEN 'NEW_BENEFICIARY_RISK' END,
      CASE WHEN account_takeover_signal = 1 THEN 'ACCOUNT_TAKEOVER_SIGNAL' END,
      CASE WHEN high_merchant_risk = 1 THEN 'HIGH_MERCHANT_RISK' END,
      CASE WHEN suspicious_hour_activity = 1 THEN 'SUSPICIOUS_HOUR_ACTIVITY' END,
      CASE WHEN failed_login_risk = 1 THEN 'FAILED_LOGIN_RISK' END), ''), 'NO_RULE_TRIGGERED') AS reason_codes,
    daily_limit_breach + velocity_spike + new_beneficiary_risk + large_amount_anomaly + high_merchant_risk AS cluster
  FROM f),
r AS (
  SELECT * EXCLUDE (cluster),
    CASE
      WHEN account_takeover_signal = 1 AND cluster >= 2 THEN 'LOCK'
      WHEN rule_risk_score >= 85 THEN 'LOCK'
      WHEN daily_limit_breach = 1 THEN 'BLOCK'
      WHEN account_takeover_signal = 1 THEN 'BLOCK'
      WHEN velocity_spike = 1 AND cluster >= 2 THEN 'BLOCK'
      WHEN new_beneficiary_risk = 1 AND high_merchant_risk = 1 THEN 'BLOCK'
      WHEN large_amount_anomaly = 1 AND high_merchant_risk = 1 THEN 'BLOCK'
      WHEN rule_risk_score >= 65 THEN 'BLOCK'
      WHEN velocity_spike = 1 THEN 'WARN'
      WHEN new_beneficiary_risk = 1 THEN 'WARN'
      WHEN large_amount_anomaly = 1 THEN 'WARN'
      WHEN failed_login_risk = 1 THEN 'WARN'
      WHEN rule_risk_score >= 35 THEN 'WARN'
      ELSE 'ALLOW' END AS rule_action
  FROM s),
rules AS (
  SELECT *, CASE rule_action WHEN 'ALLOW' THEN 0 WHEN 'WARN' THEN 1 WHEN 'BLOCK' THEN 2 WHEN 'LOCK' THEN 3 END AS rule_action_code
  FROM r)"""

FINAL_CTE = RULES_CTE + f""",
b AS ({bench_sql()}),
m AS (
  SELECT rules.*,
    CAST(trunc(coalesce(b.gradient_boosting_score, 0)) AS INTEGER) AS gradient_boosting_score,
    CAST(trunc(coalesce(b.random_forest_score, 0)) AS INTEGER) AS random_forest_score,
    CAST(trunc(coalesce(b.logistic_regression_score, 0)) AS INTEGER) AS logistic_regression_score,
    CAST(trunc(coalesce(b.mlp_neural_network_score, 0)) AS INTEGER) AS mlp_neural_network_score,
    CAST(trunc(coalesce(b.isolation_forest_anomaly_score, 0)) AS INTEGER) AS isolation_forest_anomaly_score,
    CAST(trunc(coalesce(b.autoencoder_anomaly_score, 0)) AS INTEGER) AS autoencoder_anomaly_score,
    coalesce(b.autoencoder_reconstruction_error, 0e0) AS autoencoder_reconstruction_error
  FROM rules LEFT JOIN b ON rules.transaction_id = b.transaction_id),
fs AS (
  SELECT *,
    CAST(greatest(0e0, least(100e0, round_even(
      CASE WHEN model_confidence >= 75 THEN 0.45e0 * ml_fraud_score + 0.30e0 * rule_risk_score + 0.25e0 * greatest(autoencoder_anomaly_score, isolation_forest_anomaly_score)
           WHEN model_confidence >= 55 THEN 0.30e0 * ml_fraud_score + 0.40e0 * rule_risk_score + 0.30e0 * greatest(autoencoder_anomaly_score, isolation_forest_anomaly_score)
           ELSE 0.20e0 * ml_fraud_score + 0.45e0 * rule_risk_score + 0.35e0 * greatest(autoencoder_anomaly_score, isolation_forest_anomaly_score) END
      + CASE WHEN account_takeover_signal = 1 THEN 15 ELSE 0 END
      + CASE WHEN daily_limit_breach = 1 THEN 10 ELSE 0 END
      + CASE WHEN velocity_spike = 1 AND new_beneficiary_risk = 1 THEN 10 ELSE 0 END
      + CASE WHEN autoencoder_anomaly_score >= 85 AND ml_fraud_score >= 60 THEN 8 ELSE 0 END
      + CASE WHEN isolation_forest_anomaly_score >= 85 AND rule_risk_score >= 35 THEN 5 ELSE 0 END, 0))) AS INTEGER) AS final_risk_score
  FROM m),
fa AS (
  SELECT *,
    CASE
      WHEN rule_action = 'LOCK' THEN 'LOCK'
      WHEN account_takeover_signal = 1 AND ml_fraud_score >= 70 THEN 'LOCK'
      WHEN autoencoder_anomaly_score >= 95 AND ml_fraud_score >= 85 THEN 'LOCK'
      WHEN final_risk_score >= 90 THEN 'LOCK'
      WHEN rule_action = 'BLOCK' THEN 'BLOCK'
      WHEN ml_fraud_score >= 90 AND model_confidence >= 80 THEN 'BLOCK'
      WHEN ml_fraud_score >= 75 AND rule_risk_score >= 35 THEN 'BLOCK'
      WHEN autoencoder_anomaly_score >= 85 AND rule_risk_score >= 35 THEN 'BLOCK'
      WHEN isolation_forest_anomaly_score >= 90 AND rule_risk_score >= 35 THEN 'BLOCK'
      WHEN daily_limit_breach = 1 THEN 'BLOCK'
      WHEN final_risk_score >= 65 THEN 'BLOCK'
      WHEN rule_action = 'WARN' THEN 'WARN'
      WHEN ml_fraud_score >= 55 THEN 'WARN'
      WHEN autoencoder_anomaly_score >= 70 THEN 'WARN'
      WHEN isolation_forest_anomaly_score >= 75 THEN 'WARN'
      WHEN model_confidence < 60 AND ml_fraud_score >= 40 THEN 'WARN'
      ELSE 'ALLOW' END AS final_action
  FROM fs),
final AS (
  SELECT *,
    CASE final_action WHEN 'ALLOW' THEN 0 WHEN 'WARN' THEN 1 WHEN 'BLOCK' THEN 2 WHEN 'LOCK' THEN 3 END AS final_action_code,
    CASE WHEN final_action = 'ALLOW' THEN
           CASE WHEN reason_codes <> 'NO_RULE_TRIGGERED' THEN 'LOW_RISK_SIGNAL_MONITORED|' || reason_codes ELSE 'NO_RISK_SIGNAL' END
         ELSE coalesce(nullif(concat_ws('|',
           CASE WHEN rule_action <> 'ALLOW' THEN 'RULE_' || rule_action END,
           CASE WHEN reason_codes <> 'NO_RULE_TRIGGERED' THEN reason_codes END,
           CASE WHEN ml_fraud_score >= 85 AND model_confidence >= 75 THEN 'HIGH_CONFIDENCE_ML_FRAUD' END,
           CASE WHEN ml_fraud_score >= 70 AND model_confidence < 70 THEN 'HIGH_RISK_LOW_CONFIDENCE' END,
           CASE WHEN predicted_fraud = 1 THEN 'ML_PREDICTED_FRAUD' END,
           CASE WHEN autoencoder_anomaly_score >= 85 THEN 'DEEP_AUTOENCODER_ANOMALY' END,
           CASE WHEN isolation_forest_anomaly_score >= 85 THEN 'ISOLATION_FOREST_ANOMALY' END,
           CASE WHEN account_takeover_signal = 1 THEN 'ATO_SECURITY_OVERRIDE' END), ''), 'RISK_ESCALATION_BY_FINAL_ENGINE') END AS final_reason
  FROM fa)"""

SEVERITY_SQL = ("CASE final_action WHEN 'ALLOW' THEN 'LOW' WHEN 'WARN' THEN 'MEDIUM' "
                "WHEN 'BLOCK' THEN 'HIGH' WHEN 'LOCK' THEN 'CRITICAL' ELSE 'UNKNOWN' END")

DECISION_SOURCE_SQL = """CASE
      WHEN rule_action <> 'ALLOW' AND (predicted_fraud = 1 OR ml_fraud_score >= 55) AND (autoencoder_anomaly_score >= 70 OR isolation_forest_anomaly_score >= 75) THEN 'ML_RULE_ANOMALY_ENGINE'
      WHEN (predicted_fraud = 1 OR ml_fraud_score >= 55) AND (autoencoder_anomaly_score >= 70 OR isolation_forest_anomaly_score >= 75) THEN 'ML_AND_ANOMALY_ENGINE'
      WHEN rule_action <> 'ALLOW' AND (autoencoder_anomaly_score >= 70 OR isolation_forest_anomaly_score >= 75) THEN 'RULE_AND_ANOMALY_ENGINE'
      WHEN rule_action <> 'ALLOW' AND (predicted_fraud = 1 OR ml_fraud_score >= 55) THEN 'ML_AND_RULE_ENGINE'
      WHEN autoencoder_anomaly_score >= 70 OR isolation_forest_anomaly_score >= 75 THEN 'ANOMALY_ENGINE'
      WHEN predicted_fraud = 1 OR ml_fraud_score >= 55 THEN 'ML_ENGINE'
      WHEN rule_action <> 'ALLOW' THEN 'RULE_ENGINE'
      WHEN reason_codes <> 'NO_RULE_TRIGGERED' THEN 'RULE_ENGINE_MONITORED'
      ELSE 'NO_RISK_ENGINE_TRIGGERED' END"""

ANOMALY_SEVERITY_SQL = ("CASE WHEN autoencoder_anomaly_score >= 85 OR isolation_forest_anomaly_score >= 85 THEN 'HIGH' "
                        "WHEN autoencoder_anomaly_score >= 70 OR isolation_forest_anomaly_score >= 75 THEN 'MEDIUM' "
                        "ELSE 'LOW' END")

AUDIT_CTE = FINAL_CTE + f""",
audit AS (
  SELECT 'AUD_' || transaction_id AS audit_id, transaction_id,
    strftime(timestamp, '%Y-%m-%dT%H:%M:%S') AS timestamp,
    {SEVERITY_SQL} AS severity,
    {DECISION_SOURCE_SQL} AS decision_source,
    amount, rule_risk_score, ml_fraud_score, model_confidence, autoencoder_anomaly_score,
    isolation_forest_anomaly_score, autoencoder_reconstruction_error, final_risk_score,
    rule_action, final_action, final_reason, risk_type, is_fraud
  FROM final),
dash AS (
  SELECT final.*, a.severity, a.decision_source
  FROM final LEFT JOIN (SELECT transaction_id, arg_min(severity, audit_id) AS severity,
                               arg_min(decision_source, audit_id) AS decision_source
                        FROM audit GROUP BY transaction_id) a
  ON final.transaction_id = a.transaction_id)"""

REQUESTS_CTE = f"req AS ({requests_sql()})"


def with_(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"
