"""Cost-sensitive ALLOW / REVIEW / BLOCK decisioning.

Row-wise, so every function is a projection usable on batch tables and on
Structured Streaming sources alike. Alias resolution happens at plan time.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import clip01, first_present, fmt3, ordered_nonnull, to_double, truthy_py


@dataclass(frozen=True)
class CostPolicy:
    """Fixed default policy values (thresholds, boosts, costs)."""
    review_threshold: float = 0.35
    block_threshold: float = 0.75
    anomaly_review_boost: float = 0.10
    anomaly_block_boost: float = 0.15
    low_confidence_threshold: float = 0.55
    low_confidence_review_boost: float = 0.08
    severe_rule_block_score: int = 80
    medium_rule_review_score: int = 40
    false_positive_cost: float = 1.0
    false_negative_cost: float = 8.0
    review_cost: float = 0.75


# Rule flag weights in their reference order.
RULE_WEIGHTS = {
    "amount_limit_violation": 35,
    "daily_limit_violation": 35,
    "velocity_violation": 25,
    "foreign_ip": 20,
    "new_device": 15,
    "multiple_failed_logins": 30,
    "account_takeover_pattern": 50,
    "blacklisted_merchant": 45,
    "high_risk_country": 35,
    "unusual_time": 15,
}
RULE_FLAG_NAMES = list(RULE_WEIGHTS)

PROBABILITY_ALIASES = ["fraud_probability", "ml_fraud_probability", "risk_score", "fraud_score"]
CONFIDENCE_ALIASES = ["model_confidence", "ml_confidence", "confidence_score"]
ANOMALY_ALIASES = ["anomaly_flag", "is_anomaly", "anomaly_detected"]

REQUEST_DEFAULTS = {"transaction_id": "TXN-API-001", "user_id": "USER-API-001",
                    "fraud_probability": 0.50, "model_confidence": 0.90, "anomaly_flag": False,
                    **{n: False for n in RULE_FLAG_NAMES}}


def rule_severity_column(df: DataFrame, weights: dict[str, int] | None = None) -> Column:
    """D3: sum of weights of truthy flags (Python ``bool``), capped at 100;
    absent flags count as False."""
    w = weights or RULE_WEIGHTS
    total = sum((F.when(truthy_py(df, n), F.lit(v)).otherwise(F.lit(0)) for n, v in w.items()), F.lit(0))
    return F.least(F.lit(100), total).cast("int")


def decision_inputs(df: DataFrame) -> DataFrame:
    """D9 + D1 + D2 + D3: resolve aliases by presence and add
    ``_raw, _conf, _anomaly, _severity``."""
    p = first_present(df, PROBABILITY_ALIASES)
    c = first_present(df, CONFIDENCE_ALIASES)
    a = first_present(df, ANOMALY_ALIASES)
    raw = clip01(to_double(df, p, 0.0)) if p else clip01(F.lit(0.0))
    conf = clip01(to_double(df, c, 1.0)) if c else clip01(F.lit(1.0))
    return df.withColumns({
        "_raw": raw,
        "_conf": conf,
        "_anomaly": truthy_py(df, a),
        "_severity": rule_severity_column(df),
    })


def add_adjusted_risk(df: DataFrame, policy: CostPolicy) -> DataFrame:
    """Adjustments applied in the reference's order (float order matters).
    Each step is its own column so no sub-expression is duplicated."""
    raw, sev = F.col("_raw"), F.col("_severity")
    anomaly, conf = F.col("_anomaly"), F.col("_conf")
    df = df.withColumn("_a", F.when(sev >= policy.severe_rule_block_score,
                                    F.greatest(raw + F.lit(0.25), F.lit(policy.block_threshold)))
                       .when(sev >= policy.medium_rule_review_score, raw + F.lit(0.12))
                       .when(sev > 0, raw + F.lit(0.05))
                       .otherwise(raw))
    a = F.col("_a")
    # x + 0.0 == x, so each boost references the running value once.
    zero = F.lit(0.0)
    df = df.withColumn("_a", a + F.when(anomaly, F.lit(policy.anomaly_review_boost)).otherwise(zero))
    df = df.withColumn("_a", a + F.when(anomaly & (raw >= policy.review_threshold),
                                        F.lit(policy.anomaly_block_boost)).otherwise(zero))
    df = df.withColumn("_a", a + F.when(conf < policy.low_confidence_threshold,
                                        F.lit(policy.low_confidence_review_boost)).otherwise(zero))
    return df.withColumn("adjusted_risk_score", clip01(a)).drop("_a")


def decision_column(adj: Column, policy: CostPolicy) -> Column:
    """Thresholds only (expected costs are reported, not used)."""
    return (F.when(adj >= policy.block_threshold, "BLOCK")
            .when(adj >= policy.review_threshold, "REVIEW")
            .otherwise("ALLOW"))


def reasons_column(policy: CostPolicy) -> Column:
    """Ordered reason strings (numbers formatted ``%.3f``)."""
    raw, sev, adj = F.col("_raw"), F.col("_severity"), F.col("adjusted_risk_score")
    anomaly, conf = F.col("_anomaly"), F.col("_conf")
    sev_s = sev.cast("string")
    bt, rt = (fmt3(t) if isinstance(t, Column) else F.lit(f"{t:.3f}") for t in (policy.block_threshold, policy.review_threshold))
    return ordered_nonnull([
        F.concat(F.lit("Base fraud probability: "), fmt3(raw)),
        F.when(sev >= policy.severe_rule_block_score,
               F.concat(F.lit("Severe rule risk detected with severity score "), sev_s, F.lit("/100")))
        .when(sev >= policy.medium_rule_review_score,
              F.concat(F.lit("Moderate rule risk detected with severity score "), sev_s, F.lit("/100")))
        .when(sev > 0, F.concat(F.lit("Minor rule risk detected with severity score "), sev_s, F.lit("/100"))),
        F.when(sev >= policy.severe_rule_block_score, F.lit("Severe rule risk forces a block-level decision")),
        F.when(anomaly, F.lit("Anomaly detector flagged unusual transaction behavior")),
        F.when(anomaly & (raw >= policy.review_threshold),
               F.lit("Anomaly flag combined with elevated fraud probability")),
        F.when(conf < policy.low_confidence_threshold,
               F.concat(F.lit("Model confidence is low at "), fmt3(conf))),
        F.when(adj >= policy.block_threshold,
               F.concat(F.lit("Adjusted risk "), fmt3(adj), F.lit(" exceeds block threshold "), bt))
        .when(adj >= policy.review_threshold,
              F.concat(F.lit("Adjusted risk "), fmt3(adj), F.lit(" exceeds review threshold "), rt))
        .otherwise(F.concat(F.lit("Adjusted risk "), fmt3(adj), F.lit(" is below review threshold "), rt)),
    ])


def cost_decisions(df: DataFrame, policy: CostPolicy | None = None, keep_inputs: bool = True) -> DataFrame:
    """D4-D7 over any frame carrying (aliases of) probability, confidence,
    anomaly and rule flags. Adds the RiskDecisionResult fields."""
    policy = policy or CostPolicy()
    x = add_adjusted_risk(decision_inputs(df), policy)
    adj = F.col("adjusted_risk_score")
    x = x.withColumns({
        "decision": decision_column(adj, policy),
        "raw_fraud_probability": F.col("_raw"),
        "rule_severity_score": F.col("_severity"),
        "anomaly_flag_resolved": F.col("_anomaly"),
        "model_confidence_resolved": F.col("_conf"),
        "expected_allow_cost": adj * F.lit(policy.false_negative_cost),
        "expected_review_cost": F.lit(policy.review_cost),
        "expected_block_cost": (F.lit(1.0) - adj) * F.lit(policy.false_positive_cost),
    })
    x = x.withColumn("reasons", reasons_column(policy))
    x = x.drop("_raw", "_conf", "_anomaly", "_severity")
    return x if keep_inputs else x.select(*RESULT_COLUMNS)


RESULT_COLUMNS = ["decision", "raw_fraud_probability", "adjusted_risk_score", "rule_severity_score",
                  "anomaly_flag_resolved", "model_confidence_resolved", "expected_allow_cost",
                  "expected_review_cost", "expected_block_cost", "reasons"]


#: A policy table is broadcast up to so many rows (they are counted).
POLICY_ROWS = 100_000


def policy_intervals(policies: DataFrame) -> DataFrame:
    """Versions (segment, valid_from, review_threshold, block_threshold) -> one row per
    version with the time until which it holds (null: still). Of versions of one segment and
    time the strictest block threshold counts."""
    one = policies.groupBy("segment", "valid_from").agg(F.min_by(F.struct("review_threshold", "block_threshold"), F.struct("block_threshold", "review_threshold")).alias("_t"))
    return one.select("segment", "valid_from", F.lead("valid_from").over(Window.partitionBy("segment").orderBy("valid_from")).alias("valid_until"), "_t.*")


def with_policy(df: DataFrame, policies: DataFrame, segment: str, ts: str, default: CostPolicy | None = None) -> DataFrame:
    """D10, the as-of range join: each row gets the thresholds in force for its segment at its
    time (``policy_review``, ``policy_block``, ``policy_from``), the default's where none is.
    The versions of a segment do not overlap, so no row is doubled. The policy table is
    broadcast only if its counted rows allow; else it is an equi-join on the segment."""
    default = default or CostPolicy()
    versions = policy_intervals(policies).toDF("_segment", "policy_from", "_until", "_review", "_block")
    if policies.limit(POLICY_ROWS + 1).count() <= POLICY_ROWS:
        versions = F.broadcast(versions)
    at = F.col(ts)
    held = (F.col(segment) == F.col("_segment")) & (at >= F.col("policy_from")) & (F.col("_until").isNull() | (at < F.col("_until")))
    return df.join(versions, held, "left").withColumns({
        "policy_review": F.coalesce("_review", F.lit(default.review_threshold)),
        "policy_block": F.coalesce("_block", F.lit(default.block_threshold))}).drop("_segment", "_until", "_review", "_block")


def cost_decisions_by_policy(df: DataFrame, policies: DataFrame, segment: str, ts: str, default: CostPolicy | None = None) -> DataFrame:
    """D4-D7 with the thresholds of the policy in force for each row (:func:`with_policy`)."""
    default = default or CostPolicy()
    at = with_policy(df, policies, segment, ts, default)
    return cost_decisions(at, replace(default, review_threshold=F.col("policy_review"), block_threshold=F.col("policy_block")))


def explanation_text(df: DataFrame) -> Column:
    """The multi-line decision explanation."""
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Decision: "), F.col("decision")),
        F.concat(F.lit("Raw fraud probability: "), fmt3(F.col("raw_fraud_probability"))),
        F.concat(F.lit("Adjusted risk score: "), fmt3(F.col("adjusted_risk_score"))),
        F.concat(F.lit("Rule severity score: "), F.col("rule_severity_score").cast("string"), F.lit("/100")),
        F.concat(F.lit("Anomaly flag: "), F.when(F.col("anomaly_flag_resolved"), "True").otherwise("False")),
        F.concat(F.lit("Model confidence: "), fmt3(F.col("model_confidence_resolved"))),
        F.lit("Reasons:"),
        F.array_join(F.transform(F.col("reasons"), lambda r: F.concat(F.lit("- "), r)), "\n"),
    )


# ---------------- D11-D13: request contract and scoring ----------------

def validate_requests(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Default-fill absent fields, then split into (valid, quarantine)
    where quarantine rows carry ``reject_reason`` (probabilities outside
    [0, 1] or not numbers)."""
    fills = {k: F.lit(v) for k, v in REQUEST_DEFAULTS.items() if k not in requests.columns}
    r = requests.withColumns(fills) if fills else requests
    nulls = {k: F.coalesce(F.col(k), F.lit(v)) for k, v in REQUEST_DEFAULTS.items()}
    r = r.withColumns(nulls)
    p = F.col("fraud_probability").try_cast("double")
    c = F.col("model_confidence").try_cast("double")
    reason = (F.when(p.isNull() | F.isnan(p), "fraud_probability is not a number")
              .when((p < 0) | (p > 1), "fraud_probability must be within [0, 1]")
              .when(c.isNull() | F.isnan(c), "model_confidence is not a number")
              .when((c < 0) | (c > 1), "model_confidence must be within [0, 1]"))
    r = r.withColumn("reject_reason", reason)
    valid = r.where(F.col("reject_reason").isNull()).drop("reject_reason")
    quarantine = r.where(F.col("reject_reason").isNotNull())
    return valid, quarantine


def score_requests(requests: DataFrame, policy: CostPolicy | None = None) -> DataFrame:
    """Response rows (+ nested audit record) for a batch or stream of
    validated scoring requests."""
    scored = cost_decisions(requests, policy)
    tid = F.coalesce(F.col("transaction_id").cast("string"), F.lit("UNKNOWN_TRANSACTION")) \
        if "transaction_id" in requests.columns else F.lit("UNKNOWN_TRANSACTION")
    uid = F.coalesce(F.col("user_id").cast("string"), F.lit("UNKNOWN_USER")) \
        if "user_id" in requests.columns else F.lit("UNKNOWN_USER")
    return scored.select(
        tid.alias("transaction_id"), uid.alias("user_id"), "decision", "raw_fraud_probability",
        "adjusted_risk_score", "rule_severity_score", F.col("anomaly_flag_resolved").alias("anomaly_flag"),
        F.col("model_confidence_resolved").alias("model_confidence"), "expected_allow_cost",
        "expected_review_cost", "expected_block_cost", "reasons",
        F.struct(tid.alias("transaction_id"), uid.alias("user_id"), F.col("decision").alias("final_decision"),
                 F.col("raw_fraud_probability").alias("fraud_probability"), "adjusted_risk_score",
                 "rule_severity_score", F.col("anomaly_flag_resolved").alias("anomaly_flag"),
                 F.col("model_confidence_resolved").alias("model_confidence"),
                 F.col("reasons").alias("decision_reasons")).alias("audit_record"),
    )


def enrich_with_scores(requests: DataFrame, policy: CostPolicy | None = None) -> DataFrame:
    """Overwrite the record fields with the scored ones (input for the
    explanation and investigation operators)."""
    scored = cost_decisions(requests, policy)
    return scored.withColumns({
        "final_decision": F.col("decision"),
        "fraud_probability": F.col("raw_fraud_probability"),
        "risk_score": F.col("adjusted_risk_score"),
        "model_confidence": F.col("model_confidence_resolved"),
        "anomaly_flag": F.col("anomaly_flag_resolved"),
    }).drop(*[c for c in RESULT_COLUMNS if c not in ("decision", "adjusted_risk_score", "reasons")])
