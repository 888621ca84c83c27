"""Hybrid rule + model + anomaly final decision engine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import ordered_nonnull
from ledgerlens.operators.rules import NO_RULE, action_code
from ledgerlens.sources.tables import project_declared, require_columns

# Fixed column contracts of the final stage.
BENCHMARK_COLUMNS = [
    "transaction_id",
    "gradient_boosting_score",
    "random_forest_score",
    "logistic_regression_score",
    "mlp_neural_network_score",
    "isolation_forest_anomaly_score",
    "autoencoder_anomaly_score",
    "autoencoder_reconstruction_error",
]
SCORE_COLUMNS = BENCHMARK_COLUMNS[1:7]

REQUIRED_COLUMNS = [
    "transaction_id", "account_id", "amount", "daily_limit", "total_after_txn",
    "daily_limit_breach", "velocity_spike", "large_amount_anomaly", "new_beneficiary_risk",
    "account_takeover_signal", "high_merchant_risk", "failed_login_risk", "rule_risk_score",
    "rule_action", "rule_action_code", "reason_codes", "ml_fraud_score", "model_confidence",
    "predicted_fraud",
]

FINAL_TRACE_COLUMNS = [
    "transaction_id", "daily_limit_breach", "velocity_spike", "large_amount_anomaly",
    "new_beneficiary_risk", "account_takeover_signal", "high_merchant_risk", "failed_login_risk",
    "rule_risk_score", "ml_fraud_score", "model_confidence", "autoencoder_anomaly_score",
    "isolation_forest_anomaly_score", "final_risk_score", "final_action_code", "final_action",
]


def merge_benchmark_scores(scored: DataFrame, bench: DataFrame, bench_unique: bool = True) -> DataFrame:
    """Left equi-join on transaction_id, scores null -> 0 then truncated
    to int, reconstruction error null -> 0.

    ``bench_unique=False`` de-duplicates the right side first (one arbitrary
    but deterministic row per id: the max score tuple) so the join never fans
    out. The join strategy is Catalyst/AQE's choice.
    """
    require_columns(scored, REQUIRED_COLUMNS)
    right = project_declared(bench, BENCHMARK_COLUMNS)
    if not bench_unique:
        right = (right.groupBy("transaction_id")
                 .agg(F.max(F.struct(*BENCHMARK_COLUMNS[1:])).alias("_s"))
                 .select("transaction_id", "_s.*"))
    overlap = [c for c in BENCHMARK_COLUMNS[1:] if c in scored.columns]
    merged = scored.drop(*overlap).join(right, "transaction_id", "left")
    fills = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)).cast("int") for c in SCORE_COLUMNS}
    fills["autoencoder_reconstruction_error"] = F.coalesce(
        F.col("autoencoder_reconstruction_error").cast("double"), F.lit(0.0))
    return merged.withColumns(fills)


def final_score_column() -> Column:
    """Anomaly fusion, confidence-tiered blend, overrides, half-even
    round, clip to 0..100."""
    c = F.col
    ml, rule, conf = c("ml_fraud_score"), c("rule_risk_score"), c("model_confidence")
    ae, iso = c("autoencoder_anomaly_score"), c("isolation_forest_anomaly_score")
    anomaly = F.greatest(ae, iso)
    blend = (F.when(conf >= 75, F.lit(0.45) * ml + F.lit(0.30) * rule + F.lit(0.25) * anomaly)
             .when(conf >= 55, F.lit(0.30) * ml + F.lit(0.40) * rule + F.lit(0.30) * anomaly)
             .otherwise(F.lit(0.20) * ml + F.lit(0.45) * rule + F.lit(0.35) * anomaly))
    boosted = (blend
               + F.when(c("account_takeover_signal") == 1, F.lit(15)).otherwise(F.lit(0))
               + F.when(c("daily_limit_breach") == 1, F.lit(10)).otherwise(F.lit(0))
               + F.when((c("velocity_spike") == 1) & (c("new_beneficiary_risk") == 1),
                        F.lit(10)).otherwise(F.lit(0))
               + F.when((ae >= 85) & (ml >= 60), F.lit(8)).otherwise(F.lit(0))
               + F.when((iso >= 85) & (rule >= 35), F.lit(5)).otherwise(F.lit(0)))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.bround(boosted, 0))).cast("int")


def final_action_column() -> Column:
    """17-way first-match cascade."""
    c = F.col
    ml, rule, conf = c("ml_fraud_score"), c("rule_risk_score"), c("model_confidence")
    ae, iso, fin = c("autoencoder_anomaly_score"), c("isolation_forest_anomaly_score"), c("final_risk_score")
    ra = c("rule_action")
    return (F.when(ra == "LOCK", "LOCK")
            .when((c("account_takeover_signal") == 1) & (ml >= 70), "LOCK")
            .when((ae >= 95) & (ml >= 85), "LOCK")
            .when(fin >= 90, "LOCK")
            .when(ra == "BLOCK", "BLOCK")
            .when((ml >= 90) & (conf >= 80), "BLOCK")
            .when((ml >= 75) & (rule >= 35), "BLOCK")
            .when((ae >= 85) & (rule >= 35), "BLOCK")
            .when((iso >= 90) & (rule >= 35), "BLOCK")
            .when(c("daily_limit_breach") == 1, "BLOCK")
            .when(fin >= 65, "BLOCK")
            .when(ra == "WARN", "WARN")
            .when(ml >= 55, "WARN")
            .when(ae >= 70, "WARN")
            .when(iso >= 75, "WARN")
            .when((conf < 60) & (ml >= 40), "WARN")
            .otherwise("ALLOW"))


def final_reason_column() -> Column:
    """Ordered, de-duplicated reasons joined by '|'."""
    c = F.col
    ml, conf = c("ml_fraud_score"), c("model_confidence")
    rc = c("reason_codes")
    items = ordered_nonnull([
        F.when(c("rule_action") != "ALLOW", F.concat(F.lit("RULE_"), c("rule_action"))),
        F.when(rc != NO_RULE, rc),
        F.when((ml >= 85) & (conf >= 75), F.lit("HIGH_CONFIDENCE_ML_FRAUD")),
        F.when((ml >= 70) & (conf < 70), F.lit("HIGH_RISK_LOW_CONFIDENCE")),
        F.when(c("predicted_fraud") == 1, F.lit("ML_PREDICTED_FRAUD")),
        F.when(c("autoencoder_anomaly_score") >= 85, F.lit("DEEP_AUTOENCODER_ANOMALY")),
        F.when(c("isolation_forest_anomaly_score") >= 85, F.lit("ISOLATION_FOREST_ANOMALY")),
        F.when(c("account_takeover_signal") == 1, F.lit("ATO_SECURITY_OVERRIDE")),
    ])
    joined = F.array_join(F.array_distinct(items), "|")
    return (F.when(c("final_action") == "ALLOW",
                   F.when(rc != NO_RULE, F.concat(F.lit("LOW_RISK_SIGNAL_MONITORED|"), rc))
                   .otherwise(F.lit("NO_RISK_SIGNAL")))
            .when(F.size(items) == 0, F.lit("RISK_ESCALATION_BY_FINAL_ENGINE"))
            .otherwise(joined))


def apply_final_decisions(merged: DataFrame) -> DataFrame:
    """C2-C7 composed; one narrow stage after the C1 join."""
    df = merged.withColumn("final_risk_score", final_score_column())
    df = df.withColumn("final_action", final_action_column())
    return df.withColumns({
        "final_action_code": action_code(F.col("final_action")),
        "final_reason": final_reason_column(),
    })


def final_trace(final: DataFrame) -> DataFrame:
    """16-column decision trace."""
    return final.select(*FINAL_TRACE_COLUMNS)


FINAL_SEGMENT_SCORES = ["ml_fraud_score", "rule_risk_score", "autoencoder_anomaly_score",
                        "isolation_forest_anomaly_score", "final_risk_score"]


def score_by_segment(final: DataFrame, segment: str = "risk_type",
                     columns: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Mean scores per segment (half-even rounding), sorted by
    the mean final score descending."""
    cols = columns or FINAL_SEGMENT_SCORES
    out = final.groupBy(segment).agg(
        *[F.bround(F.avg(c), digits).alias(f"mean_{c}") for c in cols],
        F.count(F.lit(1)).alias("n"))
    order = "mean_final_risk_score" if "final_risk_score" in cols else f"mean_{cols[-1]}"
    return out.orderBy(F.desc(order), F.asc(segment))
