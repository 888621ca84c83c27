"""Registered queries for the rule engine (B), final decision (C), audit (E)
and dashboard (K) groups, with their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import audit as A
from ledgerlens.operators import dashboard as K
from ledgerlens.operators import final_decision as C
from ledgerlens.operators import rules as B
from ledgerlens.plans import decisions as D
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import ANOMALY_SEVERITY_SQL, AUDIT_CTE, FINAL_CTE, RULES_CTE, with_

FLAG_COLS = ", ".join(B.RULE_FLAGS)

# ---------------- B: rule engine ----------------


@register("rule_flags", with_(RULES_CTE, f"SELECT transaction_id, total_after_txn, daily_limit_utilization, "
                                         f"amount_to_avg_ratio, {FLAG_COLS} FROM rules"))
def q_rule_flags(spark, sf):
    return D.rule_scored(spark, sf).select("transaction_id", "total_after_txn", "daily_limit_utilization",
                                           "amount_to_avg_ratio", *B.RULE_FLAGS)


@register("rule_score", with_(RULES_CTE, "SELECT transaction_id, rule_risk_score FROM rules"))
def q_rule_score(spark, sf):
    return D.rule_scored(spark, sf).select("transaction_id", "rule_risk_score")


@register("rule_reason_codes", with_(RULES_CTE, "SELECT transaction_id, reason_codes FROM rules"))
def q_rule_reason_codes(spark, sf):
    return D.rule_scored(spark, sf).select("transaction_id", "reason_codes")


@register("rule_action", with_(RULES_CTE, "SELECT transaction_id, rule_action, rule_action_code FROM rules"))
def q_rule_action(spark, sf):
    return D.rule_scored(spark, sf).select("transaction_id", "rule_action", "rule_action_code")


@register("rule_trace", with_(RULES_CTE, f"SELECT {', '.join(B.RULE_TRACE_COLUMNS)} FROM rules"))
def q_rule_trace(spark, sf):
    return B.rule_trace(D.rule_scored(spark, sf))


@register("rule_action_counts", with_(RULES_CTE, "SELECT rule_action, count(*) AS n FROM rules GROUP BY rule_action"))
def q_rule_action_counts(spark, sf):
    return B.rule_action_counts(D.rule_scored(spark, sf))


@register("rule_score_by_segment", with_(RULES_CTE, """SELECT risk_type, round_even(avg(rule_risk_score), 2) AS mean_rule_risk_score,
  count(*) AS n FROM rules GROUP BY risk_type"""))
def q_rule_score_by_segment(spark, sf):
    return B.rule_score_by_segment(D.rule_scored(spark, sf))


@register("top_reason_codes", with_(RULES_CTE, """SELECT reason_codes, count(*) AS n FROM rules GROUP BY reason_codes
  ORDER BY n DESC, reason_codes LIMIT 10"""))
def q_top_reason_codes(spark, sf):
    return B.top_values(D.rule_scored(spark, sf), "reason_codes", 10)


# ---------------- C: final decision ----------------

BENCH_COLS = ", ".join(C.BENCHMARK_COLUMNS)


@register("benchmark_left_join", with_(FINAL_CTE, f"SELECT {BENCH_COLS} FROM m"))
def q_benchmark_left_join(spark, sf):
    merged = C.merge_benchmark_scores(D.rule_scored(spark, sf), D.benchmark_scores(spark, sf))
    return merged.select(*C.BENCHMARK_COLUMNS)


@register("final_score", with_(FINAL_CTE, "SELECT transaction_id, final_risk_score FROM final"))
def q_final_score(spark, sf):
    return D.final_decisions(spark, sf).select("transaction_id", "final_risk_score")


@register("final_action", with_(FINAL_CTE, "SELECT transaction_id, final_action, final_action_code FROM final"))
def q_final_action(spark, sf):
    return D.final_decisions(spark, sf).select("transaction_id", "final_action", "final_action_code")


@register("final_reason", with_(FINAL_CTE, "SELECT transaction_id, final_reason FROM final"))
def q_final_reason(spark, sf):
    return D.final_decisions(spark, sf).select("transaction_id", "final_reason")


@register("final_trace", with_(FINAL_CTE, f"SELECT {', '.join(C.FINAL_TRACE_COLUMNS)} FROM final"))
def q_final_trace(spark, sf):
    return C.final_trace(D.final_decisions(spark, sf))


@register("final_action_matrix", with_(FINAL_CTE, """SELECT rule_action, final_action, count(*) AS n,
  CAST(sum(final_risk_score) AS BIGINT) AS sum_final_risk_score FROM final GROUP BY rule_action, final_action"""))
def q_final_action_matrix(spark, sf):
    return (D.final_decisions(spark, sf).groupBy("rule_action", "final_action")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("final_risk_score").alias("sum_final_risk_score")))


_SEG_SQL = """SELECT risk_type,
  round_even(avg(ml_fraud_score), 2) AS mean_ml_fraud_score,
  round_even(avg(rule_risk_score), 2) AS mean_rule_risk_score,
  round_even(avg(autoencoder_anomaly_score), 2) AS mean_autoencoder_anomaly_score,
  round_even(avg(isolation_forest_anomaly_score), 2) AS mean_isolation_forest_anomaly_score,
  round_even(avg(final_risk_score), 2) AS mean_final_risk_score,
  count(*) AS n
FROM final GROUP BY risk_type"""


@register("final_score_by_segment", with_(FINAL_CTE, _SEG_SQL))
def q_final_score_by_segment(spark, sf):
    return C.score_by_segment(D.final_decisions(spark, sf))


@register("top_final_reasons", with_(FINAL_CTE, """SELECT final_reason, count(*) AS n FROM final GROUP BY final_reason
  ORDER BY n DESC, final_reason LIMIT 10"""))
def q_top_final_reasons(spark, sf):
    return B.top_values(D.final_decisions(spark, sf), "final_reason", 10)


# ---------------- E: audit ----------------

AUDIT_VIEW_COLS = ("audit_id, transaction_id, timestamp, severity, decision_source, amount, rule_risk_score, "
                   "ml_fraud_score, model_confidence, autoencoder_anomaly_score, isolation_forest_anomaly_score, "
                   "autoencoder_reconstruction_error, final_risk_score, rule_action, final_action, final_reason, "
                   "risk_type, is_fraud")


@register("audit_severity", with_(AUDIT_CTE, "SELECT transaction_id, severity FROM audit"))
def q_audit_severity(spark, sf):
    return D.final_decisions(spark, sf).select(
        "transaction_id", A.severity_column(F.col("final_action")).alias("severity"))


@register("decision_source", with_(AUDIT_CTE, "SELECT transaction_id, decision_source FROM audit"))
def q_decision_source(spark, sf):
    return D.final_decisions(spark, sf).select("transaction_id", A.decision_source_column().alias("decision_source"))


@register("anomaly_severity", with_(FINAL_CTE, f"""SELECT transaction_id,
  autoencoder_anomaly_score >= 70 AS autoencoder_anomaly_flag,
  isolation_forest_anomaly_score >= 75 AS isolation_forest_anomaly_flag,
  {ANOMALY_SEVERITY_SQL} AS anomaly_severity FROM final"""))
def q_anomaly_severity(spark, sf):
    docs = D.audit_docs(spark, sf)
    return docs.select("transaction_id", "anomaly_decision.autoencoder_anomaly_flag",
                       "anomaly_decision.isolation_forest_anomaly_flag", "anomaly_decision.anomaly_severity")


@register("audit_view", with_(AUDIT_CTE, f"SELECT {AUDIT_VIEW_COLS} FROM audit"))
def q_audit_view(spark, sf):
    return D.audit_flat(spark, sf)


@register("audit_summary", with_(FINAL_CTE, """SELECT count(*) AS total_audit_records,
  count_if(final_action IN ('BLOCK', 'LOCK')) AS blocked_or_locked_transactions,
  count_if(final_action = 'WARN') AS warned_transactions,
  count_if(final_action = 'ALLOW') AS allowed_transactions,
  count_if(autoencoder_anomaly_score >= 70) AS autoencoder_anomaly_flags,
  count_if(isolation_forest_anomaly_score >= 75) AS isolation_forest_anomaly_flags
FROM final"""))
def q_audit_summary(spark, sf):
    return A.audit_summary_totals(D.final_decisions(spark, sf))


@register("audit_summary_counts", with_(AUDIT_CTE, f"""SELECT dimension, value, count(*) AS n FROM (
  SELECT 'final_action' AS dimension, final_action AS value FROM final
  UNION ALL SELECT 'severity', severity FROM audit
  UNION ALL SELECT 'decision_source', decision_source FROM audit
  UNION ALL SELECT 'anomaly_severity', {ANOMALY_SEVERITY_SQL} FROM final)
GROUP BY dimension, value"""))
def q_audit_summary_counts(spark, sf):
    return A.audit_summary_counts(D.final_decisions(spark, sf))


@register("audit_documents", with_(AUDIT_CTE, """SELECT 'AUD_' || f.transaction_id AS audit_id, 'TRANSACTION_RISK_DECISION' AS event_type, f.transaction_id,
  f.account_id, CAST(f.amount AS DOUBLE) AS amount, CAST(f.daily_limit AS DOUBLE) AS daily_limit, CAST(f.total_after_txn AS DOUBLE) AS total_after_txn,
  concat_ws(',', CAST(daily_limit_breach AS INT), CAST(velocity_spike AS INT), CAST(large_amount_anomaly AS INT), CAST(new_beneficiary_risk AS INT),
    CAST(account_takeover_signal AS INT), CAST(high_merchant_risk AS INT), CAST(failed_login_risk AS INT)) AS risk_signals,
  rule_action, reason_codes, CAST(predicted_fraud AS INT) AS predicted_fraud,
  autoencoder_anomaly_score >= 70 AS autoencoder_anomaly_flag, isolation_forest_anomaly_score >= 75 AS isolation_forest_anomaly_flag,
  final_action, CAST(final_action_code AS INT) AS final_action_code, final_reason, risk_type, CAST(is_fraud AS INT) AS is_fraud, true AS hardware_packet_ready
FROM final f"""))
def q_audit_documents(spark, sf):
    """E4 + E6: the nested audit documents, their groups laid out as columns."""
    r = D.audit_docs(spark, sf)
    return r.select("audit_id", "event_type", "transaction_id", "transaction.*", F.concat_ws(",", *[F.col(f"risk_signals.{n}").cast("string") for n in r.schema["risk_signals"].dataType.names]).alias("risk_signals"),
                    "rule_decision.*", "ml_decision.predicted_fraud", "anomaly_decision.autoencoder_anomaly_flag", "anomaly_decision.isolation_forest_anomaly_flag",
                    "final_decision.*", "ground_truth.*", "hardware_packet_ready")


# ---------------- K: dashboard ----------------


def _dash(spark, sf):
    # one decision-flow DataFrame feeds both sides (built once; identical
    # exchanges below it are reused by the planner)
    final = D.final_decisions(spark, sf)
    return K.audit_lookup_join(final, A.audit_view(A.audit_records(final)))


@register("audit_lookup_join", with_(AUDIT_CTE, "SELECT transaction_id, final_action, severity, decision_source FROM dash"))
def q_audit_lookup_join(spark, sf):
    return _dash(spark, sf).select("transaction_id", "final_action", "severity", "decision_source")


_KPI_SQL = """SELECT count(*) AS total_transactions,
  count_if(final_action = 'ALLOW') AS allow_count, count_if(final_action = 'WARN') AS warn_count,
  count_if(final_action = 'BLOCK') AS block_count, count_if(final_action = 'LOCK') AS lock_count,
  coalesce(round_even(avg(ml_fraud_score), 2), 0e0) AS avg_ml_fraud_score,
  coalesce(round_even(avg(rule_risk_score), 2), 0e0) AS avg_rule_risk_score,
  coalesce(round_even(avg(final_risk_score), 2), 0e0) AS avg_final_risk_score,
  coalesce(round_even(avg(autoencoder_anomaly_score), 2), 0e0) AS avg_autoencoder_anomaly_score,
  coalesce(round_even(avg(isolation_forest_anomaly_score), 2), 0e0) AS avg_isolation_anomaly_score,
  count_if(final_action IN ('BLOCK', 'LOCK')) AS enforcement_count,
  count_if(autoencoder_anomaly_score >= 70) AS autoencoder_flags,
  count_if(isolation_forest_anomaly_score >= 75) AS isolation_flags,
  CASE WHEN count(*) > 0 THEN count_if(final_action IN ('BLOCK', 'LOCK')) / count(*) ELSE 0e0 END AS enforcement_rate
FROM dash"""


@register("kpis", with_(AUDIT_CTE, _KPI_SQL))
def q_kpis(spark, sf):
    return K.kpis(_dash(spark, sf))


@register("kpis_filtered", with_(AUDIT_CTE, _KPI_SQL.replace(
    "FROM dash", "FROM dash WHERE risk_type = '1-URGENT' AND severity = 'HIGH' AND final_risk_score >= 40")))
def q_kpis_filtered(spark, sf):
    return K.kpis(K.slicer_filter(_dash(spark, sf), risk_type="1-URGENT", severity="HIGH", min_final_score=40))


@register("action_distribution", with_(AUDIT_CTE, """SELECT d.ord, d.final_action, coalesce(c.n, 0) AS n
FROM (VALUES (0, 'ALLOW'), (1, 'WARN'), (2, 'BLOCK'), (3, 'LOCK')) d(ord, final_action)
LEFT JOIN (SELECT final_action, count(*) AS n FROM dash GROUP BY final_action) c ON d.final_action = c.final_action
ORDER BY d.ord"""))
def q_action_distribution(spark, sf):
    return K.action_distribution(_dash(spark, sf))


@register("segment_distribution", with_(AUDIT_CTE, """SELECT dimension, value, count(*) AS n FROM (
  SELECT 'severity' AS dimension, severity AS value FROM dash
  UNION ALL SELECT 'decision_source', decision_source FROM dash
  UNION ALL SELECT 'risk_type', risk_type FROM dash) GROUP BY dimension, value"""))
def q_segment_distribution(spark, sf):
    return K.frequencies(_dash(spark, sf), ["severity", "decision_source", "risk_type"])


@register("score_by_segment", with_(AUDIT_CTE, _SEG_SQL.replace("FROM final", "FROM dash")))
def q_score_by_segment(spark, sf):
    return C.score_by_segment(_dash(spark, sf))


@register("anomaly_by_segment", with_(AUDIT_CTE, """SELECT risk_type,
  round_even(avg(autoencoder_anomaly_score), 2) AS mean_autoencoder_anomaly_score,
  round_even(avg(isolation_forest_anomaly_score), 2) AS mean_isolation_forest_anomaly_score,
  round_even(avg(final_risk_score), 2) AS mean_final_risk_score, count(*) AS n
FROM dash GROUP BY risk_type"""))
def q_anomaly_by_segment(spark, sf):
    return C.score_by_segment(_dash(spark, sf), columns=[
        "autoencoder_anomaly_score", "isolation_forest_anomaly_score", "final_risk_score"])


HIGH_RISK_COLS = ["transaction_id", "account_id", "timestamp", "risk_type", "amount", "ml_fraud_score",
                  "model_confidence", "rule_risk_score", "autoencoder_anomaly_score",
                  "isolation_forest_anomaly_score", "final_risk_score", "severity", "decision_source",
                  "final_action", "final_reason"]


@register("high_risk_top100", with_(AUDIT_CTE, f"""SELECT {', '.join(HIGH_RISK_COLS)} FROM dash
WHERE final_action IN ('BLOCK', 'LOCK')
ORDER BY final_risk_score DESC, ml_fraud_score DESC, transaction_id LIMIT 100"""))
def q_high_risk_top100(spark, sf):
    # The order does not need the audit columns: take the top rows first, look up only those.
    top = K.high_risk_review(D.final_decisions(spark, sf), 100)
    return K.high_risk_review(K.audit_lookup_join(top, A.audit_view(A.audit_records(top))), 100).select(*HIGH_RISK_COLS)


_FILTER_SQL = "risk_type = '2-HIGH' AND final_action = 'BLOCK' AND final_risk_score >= 50"


@register("audit_semi_join", with_(AUDIT_CTE, f"""SELECT {AUDIT_VIEW_COLS} FROM audit
WHERE transaction_id IN (SELECT transaction_id FROM dash WHERE {_FILTER_SQL})"""))
def q_audit_semi_join(spark, sf):
    return A.audit_view(A.audit_records(_matching_flow(spark, sf)))


def _matching_flow(spark, sf):
    """The decision flow's rows whose transaction has a row that passes the slicers."""
    return K.rows_of_matching_keys(D.final_decisions(spark, sf), K.slicer_condition(risk_type="2-HIGH", action="BLOCK", min_final_score=50))


@register("trace_semi_join", with_(AUDIT_CTE, f"""SELECT {', '.join(C.FINAL_TRACE_COLUMNS)} FROM final
WHERE transaction_id IN (SELECT transaction_id FROM dash WHERE {_FILTER_SQL})"""))
def q_trace_semi_join(spark, sf):
    return C.final_trace(_matching_flow(spark, sf))


@register("record_lookup", with_(AUDIT_CTE, f"SELECT {', '.join(HIGH_RISK_COLS)} FROM dash WHERE transaction_id = 'TXN_7'"))
def q_record_lookup(spark, sf):
    return K.record_lookup(_dash(spark, sf), "TXN_7").select(*HIGH_RISK_COLS)


@register("slicer_values", with_(AUDIT_CTE, """SELECT DISTINCT slicer, value FROM (
  SELECT 'risk_type' AS slicer, risk_type AS value FROM dash
  UNION ALL SELECT 'final_action', final_action FROM dash
  UNION ALL SELECT 'severity', severity FROM dash
  UNION ALL SELECT 'decision_source', decision_source FROM dash) WHERE value IS NOT NULL ORDER BY slicer, value"""))
def q_slicer_values(spark, sf):
    return K.slicer_values(_dash(spark, sf), ["risk_type", "final_action", "severity", "decision_source"])
