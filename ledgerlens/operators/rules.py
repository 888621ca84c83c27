"""Derived features and the deterministic rule engine.

Everything here is a narrow projection: no shuffle, no Python evaluation.
Columns are materialised in three ``select`` layers (flags -> score/cluster ->
action) so shared sub-expressions are computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import flag, ieee_div

# Fixed values that must equal the reference: action codes, flag order,
# rule weights and reason-code names.
ACTION_TO_CODE = {"ALLOW": 0, "WARN": 1, "BLOCK": 2, "LOCK": 3}

RULE_FLAGS = [
    "daily_limit_breach",
    "large_amount_anomaly",
    "velocity_spike",
    "new_beneficiary_risk",
    "account_takeover_signal",
    "high_merchant_risk",
    "suspicious_hour_activity",
    "failed_login_risk",
]
RULE_WEIGHTS = {
    "daily_limit_breach": 30,
    "large_amount_anomaly": 20,
    "velocity_spike": 20,
    "new_beneficiary_risk": 15,
    "account_takeover_signal": 30,
    "high_merchant_risk": 10,
    "suspicious_hour_activity": 5,
    "failed_login_risk": 10,
}
NO_RULE = "NO_RULE_TRIGGERED"

RULE_TRACE_COLUMNS = [
    "transaction_id", "daily_limit_breach", "velocity_spike", "large_amount_anomaly",
    "new_beneficiary_risk", "account_takeover_signal", "high_merchant_risk",
    "failed_login_risk", "rule_risk_score", "rule_action_code", "rule_action",
]


def action_code(c: Column) -> Column:
    """ALLOW 0, WARN 1, BLOCK 2, LOCK 3 (unknown -> null)."""
    out = None
    for name, code in ACTION_TO_CODE.items():
        out = (F.when(c == name, F.lit(code)) if out is None
               else out.when(c == name, F.lit(code)))
    return out


def add_derived_features(df: DataFrame) -> DataFrame:
    """Each column only when absent (user-provided values win)."""
    new = {}
    cols = set(df.columns)
    if "total_after_txn" not in cols:
        new["total_after_txn"] = F.col("daily_total_before_txn") + F.col("amount")
    total = new.get("total_after_txn", F.col("total_after_txn"))
    if "daily_limit_utilization" not in cols:
        new["daily_limit_utilization"] = ieee_div(total, F.col("daily_limit"))
    if "amount_to_avg_ratio" not in cols:
        new["amount_to_avg_ratio"] = ieee_div(F.col("amount"), F.col("avg_amount_30d"))
    if "hour_of_day" not in cols:
        new["hour_of_day"] = F.hour(F.col("timestamp"))
    return df.withColumns(new) if new else df


def rule_flag_columns() -> dict[str, Column]:
    """B5-B12 as Column expressions (input must carry the derived features)."""
    ratio = F.col("amount_to_avg_ratio")
    return {
        "daily_limit_breach": flag(F.col("total_after_txn") > F.col("daily_limit"),
                                   "total_after_txn", "daily_limit"),
        "large_amount_anomaly": flag(ratio >= 5.0, ratio),
        "velocity_spike": flag(F.col("tx_count_2min") >= 5),
        "new_beneficiary_risk": flag((F.col("beneficiary_age_days") <= 7) & (ratio >= 3.0), ratio),
        "account_takeover_signal": flag((F.col("is_new_device") == 1)
                                        & (F.col("is_new_location") == 1)
                                        & (F.col("failed_login_count_1h") >= 3)),
        "high_merchant_risk": flag(F.col("merchant_risk_score") >= 70),
        "suspicious_hour_activity": flag((F.col("hour_of_day") <= 4) | (F.col("hour_of_day") >= 23)),
        "failed_login_risk": flag(F.col("failed_login_count_1h") >= 3),
    }


def add_rule_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(rule_flag_columns())


def rule_score_column(weights: dict[str, int] | None = None) -> Column:
    """Weighted flag sum clipped to 0..100."""
    w = weights or RULE_WEIGHTS
    total = sum((F.col(n) * F.lit(w[n]) for n in RULE_FLAGS), F.lit(0))
    return F.greatest(F.lit(0), F.least(F.lit(100), total)).cast("int")


def reason_codes_column() -> Column:
    """Upper-case flag names joined by '|' in flag order."""
    joined = F.concat_ws("|", *[F.when(F.col(n) == 1, F.lit(n.upper())) for n in RULE_FLAGS])
    return F.when(joined == "", F.lit(NO_RULE)).otherwise(joined)


def rule_action_column() -> Column:
    """First-match cascade (needs flags, rule_risk_score, _cluster)."""
    c = F.col
    cluster = c("_cluster")
    return (F.when((c("account_takeover_signal") == 1) & (cluster >= 2), "LOCK")
            .when(c("rule_risk_score") >= 85, "LOCK")
            .when(c("daily_limit_breach") == 1, "BLOCK")
            .when(c("account_takeover_signal") == 1, "BLOCK")
            .when((c("velocity_spike") == 1) & (cluster >= 2), "BLOCK")
            .when((c("new_beneficiary_risk") == 1) & (c("high_merchant_risk") == 1), "BLOCK")
            .when((c("large_amount_anomaly") == 1) & (c("high_merchant_risk") == 1), "BLOCK")
            .when(c("rule_risk_score") >= 65, "BLOCK")
            .when(c("velocity_spike") == 1, "WARN")
            .when(c("new_beneficiary_risk") == 1, "WARN")
            .when(c("large_amount_anomaly") == 1, "WARN")
            .when(c("failed_login_risk") == 1, "WARN")
            .when(c("rule_risk_score") >= 35, "WARN")
            .otherwise("ALLOW"))


def apply_rules(df: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """T1 -> T2 as one narrow stage."""
    df = add_rule_flags(add_derived_features(df))
    df = df.withColumns({
        "rule_risk_score": rule_score_column(weights),
        "reason_codes": reason_codes_column(),
        "_cluster": (F.col("daily_limit_breach") + F.col("velocity_spike")
                     + F.col("new_beneficiary_risk") + F.col("large_amount_anomaly")
                     + F.col("high_merchant_risk")),
    })
    df = df.withColumn("rule_action", rule_action_column())
    return df.withColumn("rule_action_code", action_code(F.col("rule_action"))).drop("_cluster")


def rule_trace(scored: DataFrame) -> DataFrame:
    """The 11-column rule decision trace."""
    return scored.select(*RULE_TRACE_COLUMNS)


# ---- B19 reports ----

def rule_action_counts(scored: DataFrame) -> DataFrame:
    return scored.groupBy("rule_action").agg(F.count(F.lit(1)).alias("n"))


def rule_score_by_segment(scored: DataFrame, segment: str = "risk_type") -> DataFrame:
    """Mean rule score per segment, rounded half-even to 2 places."""
    return (scored.groupBy(segment)
            .agg(F.bround(F.avg("rule_risk_score"), 2).alias("mean_rule_risk_score"),
                 F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("mean_rule_risk_score"), F.asc(segment)))


def top_values(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """``value_counts().head(k)`` with a deterministic tie-break."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(column)).limit(k))
