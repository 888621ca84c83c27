"""Cost-sensitive decisions and case creation (reference fixture rows R4, R11, R12)."""

from ledgerlens.operators import cases as CS
from ledgerlens.operators import cost as CO

FLAGS = ", ".join(f"{n} boolean" for n in CO.RULE_FLAG_NAMES)


def _score(spark, p, conf, anomaly, **flags):
    row = (str(p) if p is not None else None, conf, anomaly, *[flags.get(n, False) for n in CO.RULE_FLAG_NAMES])
    df = spark.createDataFrame([row], f"fraud_probability string, model_confidence double, anomaly_flag boolean, {FLAGS}")
    return CO.cost_decisions(df).first()


def test_cost_cases(spark):
    assert _score(spark, 0.10, 0.95, False).decision == "ALLOW"
    r = _score(spark, 0.42, 0.90, False)
    assert r.decision == "REVIEW" and 0.35 <= r.adjusted_risk_score < 0.75
    assert _score(spark, 0.82, 0.88, False).decision == "BLOCK"
    r = _score(spark, 0.28, 0.90, True)
    assert r.decision == "REVIEW" and abs(r.adjusted_risk_score - 0.38) < 1e-12
    r = _score(spark, 0.40, 0.90, False, account_takeover_pattern=True, multiple_failed_logins=True)
    assert r.rule_severity_score == 80 and r.decision == "BLOCK" and r.adjusted_risk_score == 0.75
    r = _score(spark, 0.1, 0.9, False, **{n: True for n in CO.RULE_FLAG_NAMES})
    assert r.rule_severity_score == 100


def test_invalid_probability_is_safe(spark):
    r = _score(spark, "not-a-number", 0.9, False)
    assert r.decision == "ALLOW" and r.raw_fraud_probability == 0.0
    r = _score(spark, None, 0.9, False)
    assert r.raw_fraud_probability == 0.0


def test_custom_policy(spark):
    df = spark.createDataFrame([(0.62, 0.9)], "fraud_probability double, model_confidence double")
    r = CO.cost_decisions(df, CO.CostPolicy(review_threshold=0.25, block_threshold=0.60)).first()
    assert r.decision == "BLOCK"


def test_alias_row_and_case(spark):
    df = spark.createDataFrame(
        [("T1", "C1", "block", "0.88", "0.91", "0.80", "true", 1)],
        "txn_id string, customer_id string, decision string, ml_fraud_probability string, "
        "adjusted_risk_score string, ml_confidence string, anomaly_detected string, velocity_violation int")
    c = CS.create_cases(df, as_of="2026-01-01T00:00:00+00:00").first()
    assert (c.transaction_id, c.user_id, c.decision, c.status) == ("T1", "C1", "BLOCK", "OPEN")
    assert c.priority == "CRITICAL" and abs(c.risk_score - 0.91) < 1e-12
    assert [e.source for e in c.evidence] == ["velocity_violation", "anomaly_detector", "fraud_model"]
    assert c.case_id.startswith("CASE-") and len(c.case_id) == 15


def test_case_summary_counts(spark):
    df = spark.createDataFrame([("a", "REVIEW", 0.5), ("b", "BLOCK", 0.9)],
                               "transaction_id string, final_decision string, fraud_probability double")
    cases = CS.cases_from_records(df, as_of="x")
    got = {(r.dimension, r.value): r.n for r in CS.case_summary_counts(cases).collect()}
    assert got[("decision", "REVIEW")] == 1 and got[("decision", "BLOCK")] == 1
