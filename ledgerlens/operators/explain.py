"""Evidence, focus, actions and rollups of records and cases as projections over
record / case tables (SURVEY §2.J, J13, J14, J19, J22, J24, J28)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import (clip01, first_present, fmt3, ordered_nonnull, prob_from, safe_str,
                                       to_double, truthy_text)
from ledgerlens.operators.cost import RULE_FLAG_NAMES

# Rule descriptions used in explanations, in flag order.
RULE_DESCRIPTIONS = {
    "amount_limit_violation": "Transaction amount exceeded the configured risk threshold.",
    "daily_limit_violation": "Daily transaction activity exceeded the configured threshold.",
    "velocity_violation": "Transaction velocity is higher than expected.",
    "foreign_ip": "Transaction context includes a foreign IP or unusual location signal.",
    "new_device": "Transaction was initiated from a new or unfamiliar device.",
    "multiple_failed_logins": "Multiple failed login attempts were observed.",
    "account_takeover_pattern": "Combined signals suggest possible account takeover behavior.",
    "blacklisted_merchant": "Merchant appears in a blocked or high-risk merchant list.",
    "high_risk_country": "Transaction is associated with a high-risk country or region.",
    "unusual_time": "Transaction occurred at an unusual time for the user.",
}

# Recommended investigation actions.
INVESTIGATION_ACTIONS = {
    "block": "Keep the transaction blocked while the investigation is open.",
    "review": "Route the transaction to step-up authentication or analyst review.",
    "ato": "Verify user identity and review recent login and device activity.",
    "anomaly": "Compare this transaction with recent user behavior and anomaly history.",
    "low_conf": "Avoid fully automated resolution because model confidence is low.",
    "escalate": "Escalate to fraud operations if evidence remains consistent after review.",
    "default": "Preserve the audit trace and continue monitoring.",
}

ATO_SOURCES = ["foreign_ip", "new_device", "multiple_failed_logins", "account_takeover_pattern"]


def triggered_rules_column(df: DataFrame) -> Column:
    """Flag names in fixed order whose value is truthy (case-module rule)."""
    return ordered_nonnull([F.when(truthy_text(df, n), F.lit(n)) for n in RULE_DESCRIPTIONS])


def evidence_summary(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Normalised evidence fields and ordered evidence sentences. The
    risk alias order here is adjusted -> risk -> final (falls back to the
    clipped probability). ``keep`` names record columns to carry."""
    df = records
    prob = prob_from(df, ["fraud_probability", "ml_fraud_probability", "fraud_score"], 0.0)
    rname = first_present(df, ["adjusted_risk_score", "risk_score", "final_risk_score"])
    base = df.select(
        *keep,
        safe_str(df, ["transaction_id", "txn_id", "id"], "UNKNOWN_TRANSACTION").alias("transaction_id"),
        safe_str(df, ["user_id", "customer_id", "account_id"], "UNKNOWN_USER").alias("user_id"),
        F.upper(safe_str(df, ["final_decision", "decision", "final_action"], "REVIEW")).alias("final_decision"),
        prob.alias("fraud_probability"),
        (clip01(to_double(df, rname, 0.0)) if rname else F.lit(None).cast("double")).alias("_risk"),
        prob_from(df, ["model_confidence", "ml_confidence", "confidence_score"], 1.0).alias("model_confidence"),
        truthy_text(df, first_present(df, ["anomaly_flag", "is_anomaly", "anomaly_detected"])).alias("anomaly_flag"),
        triggered_rules_column(df).alias("triggered_rules"))
    base = base.withColumn("risk_score", F.col("_risk") if rname else F.col("fraud_probability")).drop("_risk")
    p, r, c = F.col("fraud_probability"), F.col("risk_score"), F.col("model_confidence")
    # The evidence sentences.
    desc = F.create_map(*[x for k, v in RULE_DESCRIPTIONS.items() for x in (F.lit(k), F.lit(v))])
    points = F.concat(
        F.array(
            F.when(p >= 0.75, F.concat(F.lit("Fraud probability is high at "), fmt3(p), F.lit(".")))
            .when(p >= 0.35, F.concat(F.lit("Fraud probability is elevated at "), fmt3(p), F.lit(".")))
            .otherwise(F.concat(F.lit("Fraud probability is low at "), fmt3(p), F.lit(".")))),
        F.array(
            F.when(r >= 0.75, F.concat(F.lit("Adjusted risk score is block-level at "), fmt3(r), F.lit(".")))
            .when(r >= 0.35, F.concat(F.lit("Adjusted risk score is review-level at "), fmt3(r), F.lit(".")))
            .otherwise(F.concat(F.lit("Adjusted risk score is low at "), fmt3(r), F.lit(".")))),
        ordered_nonnull([F.when(F.col("anomaly_flag"),
                                F.lit("Anomaly detection flagged unusual transaction behavior."))]),
        F.array(F.when(c < 0.55, F.concat(F.lit("Model confidence is low at "), fmt3(c), F.lit(".")))
                .otherwise(F.concat(F.lit("Model confidence is acceptable at "), fmt3(c), F.lit(".")))),
        F.transform("triggered_rules", lambda t: F.element_at(desc, t)))
    return base.withColumn("evidence_points", points)


def investigation_focus(cases: DataFrame) -> Column:
    """Sorted distinct focus tags (default standard_audit_review)."""
    c = F.col
    etypes = c("evidence.evidence_type")
    esrc = c("evidence.source")
    tags = ordered_nonnull([
        F.when(c("decision") == "BLOCK", F.lit("blocked_transaction")),
        F.when(c("priority").isin("HIGH", "CRITICAL"), F.lit("high_priority_case")),
        F.when(c("fraud_probability") >= 0.75, F.lit("high_model_risk"))
        .when(c("fraud_probability") >= 0.35, F.lit("elevated_model_risk")),
        F.when(c("risk_score") >= 0.75, F.lit("block_level_adjusted_risk"))
        .when(c("risk_score") >= 0.35, F.lit("review_level_adjusted_risk")),
        F.when(c("anomaly_flag") | F.array_contains(etypes, "anomaly"), F.lit("anomaly_investigation")),
        F.when(F.array_contains(etypes, "account_takeover")
               | F.arrays_overlap(esrc, F.array(*[F.lit(s) for s in ATO_SOURCES])),
               F.lit("account_takeover_review")),
        F.when(F.array_contains(etypes, "model_confidence") | (c("model_confidence") < 0.55),
               F.lit("low_confidence_review")),
        F.when(F.array_contains(etypes, "rule"), F.lit("rule_trigger_review")),
    ])
    return F.when(F.size(tags) == 0, F.array(F.lit("standard_audit_review"))).otherwise(
        F.array_sort(F.array_distinct(tags)))


def recommended_actions(cases: DataFrame, focus: Column) -> Column:
    """Ordered, de-duplicated action list (+ the case's own action)."""
    c = F.col
    a = INVESTIGATION_ACTIONS
    acts = ordered_nonnull([
        F.when(c("decision") == "BLOCK", F.lit(a["block"])),
        F.when(c("decision") == "REVIEW", F.lit(a["review"])),
        F.when(F.array_contains(focus, "account_takeover_review"), F.lit(a["ato"])),
        F.when(F.array_contains(focus, "anomaly_investigation"), F.lit(a["anomaly"])),
        F.when(F.array_contains(focus, "low_confidence_review"), F.lit(a["low_conf"])),
        F.when(F.array_contains(focus, "high_model_risk") | F.array_contains(focus, "block_level_adjusted_risk"),
               F.lit(a["escalate"])),
    ])
    acts = F.when(F.size(acts) == 0, F.array(F.lit(a["default"]))).otherwise(acts)
    own = F.when(F.coalesce(c("recommended_action"), F.lit("")) != "", F.array(c("recommended_action"))) \
        .otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(acts, own))


def investigations(cases: DataFrame) -> DataFrame:
    """J19 + J22 per case (the case table from ``cases.create_cases``)."""
    focus = investigation_focus(cases)
    out = cases.withColumn("investigation_focus", focus)
    return out.withColumn("recommended_actions", recommended_actions(out, F.col("investigation_focus")))


def investigation_rollup(inv: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(totals row, focus counts sorted by tag) from one scan each."""
    totals = inv.agg(
        F.count(F.lit(1)).alias("total_cases"),
        F.count_if(F.col("priority") == "CRITICAL").alias("critical_cases"),
        F.count_if(F.col("priority") == "HIGH").alias("high_priority_cases"),
        F.count_if(F.col("decision") == "REVIEW").alias("review_cases"),
        F.count_if(F.col("decision") == "BLOCK").alias("blocked_cases"))
    focus = (inv.select(F.explode_outer("investigation_focus").alias("focus")).where(F.col("focus").isNotNull())
             .groupBy("focus").agg(F.count(F.lit(1)).alias("n")).orderBy("focus"))
    return totals, focus


def normalize_record(df: DataFrame) -> DataFrame:
    """Alias + type normalisation of any scored row to the request shape."""
    def fl(names, default):
        n = first_present(df, names)
        return to_double(df, n, default) if n else F.lit(float(default))
    return df.select(
        safe_str(df, ["transaction_id", "txn_id", "id"], "UNKNOWN_TRANSACTION").alias("transaction_id"),
        safe_str(df, ["user_id", "customer_id", "account_id"], "UNKNOWN_USER").alias("user_id"),
        F.upper(safe_str(df, ["final_decision", "decision", "final_action"], "REVIEW")).alias("final_decision"),
        fl(["fraud_probability", "ml_fraud_probability", "fraud_score"], 0.0).alias("fraud_probability"),
        fl(["risk_score", "adjusted_risk_score", "final_risk_score"], 0.0).alias("risk_score"),
        fl(["model_confidence", "ml_confidence", "confidence_score"], 1.0).alias("model_confidence"),
        truthy_text(df, first_present(df, ["anomaly_flag", "is_anomaly", "anomaly_detected"])).alias("anomaly_flag"),
        *[truthy_text(df, n).alias(n) for n in RULE_FLAG_NAMES])
