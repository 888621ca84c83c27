"""Audit records, the flat audit view and the one-pass audit summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.rules import NO_RULE

# Action -> severity and the anomaly thresholds.
SEVERITY = {"ALLOW": "LOW", "WARN": "MEDIUM", "BLOCK": "HIGH", "LOCK": "CRITICAL"}
AE_FLAG, ISO_FLAG, ANOMALY_HIGH = 70, 75, 85


def severity_column(action: Column) -> Column:
    """ALLOW->LOW, WARN->MEDIUM, BLOCK->HIGH, LOCK->CRITICAL, else UNKNOWN."""
    out = F.when(action == "ALLOW", "LOW")
    for a, s in list(SEVERITY.items())[1:]:
        out = out.when(action == a, s)
    return out.otherwise("UNKNOWN")


def decision_source_column() -> Column:
    """9-way cascade over the four engine activity signals."""
    c = F.col
    rule_enforced = c("rule_action") != "ALLOW"
    rule_monitored = c("reason_codes") != NO_RULE
    ml_active = (c("predicted_fraud") == 1) | (c("ml_fraud_score") >= 55)
    anomaly_active = (c("autoencoder_anomaly_score") >= AE_FLAG) | (c("isolation_forest_anomaly_score") >= ISO_FLAG)
    return (F.when(rule_enforced & ml_active & anomaly_active, "ML_RULE_ANOMALY_ENGINE")
            .when(ml_active & anomaly_active, "ML_AND_ANOMALY_ENGINE")
            .when(rule_enforced & anomaly_active, "RULE_AND_ANOMALY_ENGINE")
            .when(rule_enforced & ml_active, "ML_AND_RULE_ENGINE")
            .when(anomaly_active, "ANOMALY_ENGINE")
            .when(ml_active, "ML_ENGINE")
            .when(rule_enforced, "RULE_ENGINE")
            .when(rule_monitored, "RULE_ENGINE_MONITORED")
            .otherwise("NO_RISK_ENGINE_TRIGGERED"))


def anomaly_severity_column() -> Column:
    """E5: HIGH if either score >= 85, MEDIUM if either flag, else LOW."""
    ae, iso = F.col("autoencoder_anomaly_score"), F.col("isolation_forest_anomaly_score")
    return (F.when((ae >= ANOMALY_HIGH) | (iso >= ANOMALY_HIGH), "HIGH")
            .when((ae >= AE_FLAG) | (iso >= ISO_FLAG), "MEDIUM")
            .otherwise("LOW"))


def nan_to_null(c: Column) -> Column:
    """NaN -> null for doubles (``clean_value``)."""
    return F.when(~F.isnan(c), c)


def iso_timestamp(c: Column) -> Column:
    """``datetime.isoformat()``: seconds, plus microseconds only when non-zero."""
    base = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def audit_records(final: DataFrame) -> DataFrame:
    """One nested audit document per transaction (a single projection)."""
    c = F.col
    i = lambda n: c(n).cast("int")
    d = lambda n: c(n).cast("double")
    ae, iso = c("autoencoder_anomaly_score"), c("isolation_forest_anomaly_score")
    return final.select(
        F.concat(F.lit("AUD_"), c("transaction_id")).alias("audit_id"),
        F.lit("TRANSACTION_RISK_DECISION").alias("event_type"),
        c("transaction_id"),
        iso_timestamp(c("timestamp")).alias("timestamp"),
        severity_column(c("final_action")).alias("severity"),
        decision_source_column().alias("decision_source"),
        F.struct(c("account_id"), d("amount").alias("amount"), d("daily_limit").alias("daily_limit"),
                 d("total_after_txn").alias("total_after_txn")).alias("transaction"),
        F.struct(*[i(n).alias(n) for n in [
            "daily_limit_breach", "velocity_spike", "large_amount_anomaly", "new_beneficiary_risk",
            "account_takeover_signal", "high_merchant_risk", "failed_login_risk"]]).alias("risk_signals"),
        F.struct(i("rule_risk_score").alias("rule_risk_score"),
                 i("ml_fraud_score").alias("ml_fraud_score"),
                 i("model_confidence").alias("model_confidence"),
                 i("autoencoder_anomaly_score").alias("autoencoder_anomaly_score"),
                 i("isolation_forest_anomaly_score").alias("isolation_forest_anomaly_score"),
                 d("autoencoder_reconstruction_error").alias("autoencoder_reconstruction_error"),
                 i("final_risk_score").alias("final_risk_score")).alias("risk_scores"),
        F.struct(c("rule_action"), c("reason_codes")).alias("rule_decision"),
        F.struct(i("predicted_fraud").alias("predicted_fraud"), i("ml_fraud_score").alias("ml_fraud_score"),
                 i("model_confidence").alias("model_confidence")).alias("ml_decision"),
        F.struct(i("autoencoder_anomaly_score").alias("autoencoder_anomaly_score"),
                 i("isolation_forest_anomaly_score").alias("isolation_forest_anomaly_score"),
                 d("autoencoder_reconstruction_error").alias("autoencoder_reconstruction_error"),
                 (ae >= AE_FLAG).alias("autoencoder_anomaly_flag"),
                 (iso >= ISO_FLAG).alias("isolation_forest_anomaly_flag"),
                 anomaly_severity_column().alias("anomaly_severity")).alias("anomaly_decision"),
        F.struct(c("final_action"), i("final_action_code").alias("final_action_code"),
                 c("final_reason")).alias("final_decision"),
        F.struct(c("risk_type"), i("is_fraud").alias("is_fraud")).alias("ground_truth"),
        F.lit(True).alias("hardware_packet_ready"),
    )


def audit_view(records: DataFrame) -> DataFrame:
    """Flatten to the 18-column view (nested-field pruning applies)."""
    return records.select(
        "audit_id", "transaction_id", "timestamp", "severity", "decision_source",
        F.col("transaction.amount").alias("amount"),
        *[F.col(f"risk_scores.{n}").alias(n) for n in [
            "rule_risk_score", "ml_fraud_score", "model_confidence", "autoencoder_anomaly_score",
            "isolation_forest_anomaly_score", "autoencoder_reconstruction_error", "final_risk_score"]],
        F.col("rule_decision.rule_action").alias("rule_action"),
        F.col("final_decision.final_action").alias("final_action"),
        F.col("final_decision.final_reason").alias("final_reason"),
        F.col("ground_truth.risk_type").alias("risk_type"),
        F.col("ground_truth.is_fraud").alias("is_fraud"),
    )


def audit_summary_totals(final: DataFrame) -> DataFrame:
    """E8 (scalar part): one global aggregate -> one row."""
    a = F.col("final_action")
    return final.agg(
        F.count(F.lit(1)).alias("total_audit_records"),
        F.count_if(a.isin("BLOCK", "LOCK")).alias("blocked_or_locked_transactions"),
        F.count_if(a == "WARN").alias("warned_transactions"),
        F.count_if(a == "ALLOW").alias("allowed_transactions"),
        F.count_if(F.col("autoencoder_anomaly_score") >= AE_FLAG).alias("autoencoder_anomaly_flags"),
        F.count_if(F.col("isolation_forest_anomaly_score") >= ISO_FLAG).alias("isolation_forest_anomaly_flags"),
    )


def audit_summary_counts(final: DataFrame) -> DataFrame:
    """E8 (count maps): long format (dimension, value, n) from ONE scan: each
    row emits its four (dimension, value) pairs, then a single partial +
    final aggregation."""
    pairs = F.array(
        F.struct(F.lit("final_action").alias("dimension"), F.col("final_action").alias("value")),
        F.struct(F.lit("severity").alias("dimension"), severity_column(F.col("final_action")).alias("value")),
        F.struct(F.lit("decision_source").alias("dimension"), decision_source_column().alias("value")),
        F.struct(F.lit("anomaly_severity").alias("dimension"), anomaly_severity_column().alias("value")),
    )
    return (final.select(F.inline(pairs))
            .groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n")))
