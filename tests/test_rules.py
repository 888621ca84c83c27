"""Rule engine and final decision: single-row cases from the reference's
fixture rows (exact values derived by reading the rules) plus the
exhaustive 2^8 flag-vector table."""

import itertools

from pyspark.sql import functions as F

from ledgerlens.operators import final_decision as C
from ledgerlens.operators import rules as B

BASE = dict(transaction_id="TXN_TEST_001", account_id="ACC_TEST", amount=1000.0, daily_total_before_txn=10000.0,
            daily_limit=50000.0, tx_count_2min=1, beneficiary_age_days=100, is_new_device=0, is_new_location=0,
            failed_login_count_1h=0, hour_of_day=10, merchant_risk_score=20, account_age_days=500,
            avg_amount_30d=1200.0, risk_type="NORMAL", is_fraud=0)
SCHEMA = ("transaction_id string, account_id string, amount double, daily_total_before_txn double, "
          "daily_limit double, tx_count_2min int, beneficiary_age_days int, is_new_device int, is_new_location int, "
          "failed_login_count_1h int, hour_of_day int, merchant_risk_score int, account_age_days int, "
          "avg_amount_30d double, risk_type string, is_fraud int")


def _rule_row(spark, **over):
    row = {**BASE, **over}
    cols = [c.split()[0] for c in SCHEMA.split(", ")]
    return B.apply_rules(spark.createDataFrame([tuple(row[c] for c in cols)], SCHEMA)).first()


def test_base_row_allows(spark):
    r = _rule_row(spark)
    assert (r.rule_action, r.rule_action_code, r.rule_risk_score, r.reason_codes) == ("ALLOW", 0, 0, "NO_RULE_TRIGGERED")


def test_limit_breach_blocks(spark):
    r = _rule_row(spark, amount=60000.0)
    assert r.daily_limit_breach == 1 and r.large_amount_anomaly == 1
    assert r.rule_action in ("BLOCK", "LOCK")
    assert r.reason_codes.startswith("DAILY_LIMIT_BREACH|LARGE_AMOUNT_ANOMALY")


def test_velocity_warns(spark):
    r = _rule_row(spark, tx_count_2min=6)
    assert (r.velocity_spike, r.rule_risk_score, r.rule_action) == (1, 20, "WARN")


def test_account_takeover_blocks(spark):
    r = _rule_row(spark, is_new_device=1, is_new_location=1, failed_login_count_1h=4)
    assert r.account_takeover_signal == 1 and r.failed_login_risk == 1
    assert (r.rule_risk_score, r.rule_action) == (40, "BLOCK")


def test_zero_average_gives_infinite_ratio(spark):
    r = _rule_row(spark, avg_amount_30d=0.0)
    assert r.amount_to_avg_ratio == float("inf") and r.large_amount_anomaly == 1


def test_exhaustive_flag_vectors(spark):
    """All 2^8 flag vectors: score = clipped weighted sum, action cascade in Python."""
    rows = list(itertools.product([0, 1], repeat=8))
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n in B.RULE_FLAGS))
    df = df.withColumn("rule_risk_score", B.rule_score_column()).withColumn(
        "_cluster", F.col("daily_limit_breach") + F.col("velocity_spike") + F.col("new_beneficiary_risk")
        + F.col("large_amount_anomaly") + F.col("high_merchant_risk"))
    got = {tuple(r[:8]): (r.rule_risk_score, r.a) for r in
           df.withColumn("a", B.rule_action_column()).collect()}
    for v in rows:
        f = dict(zip(B.RULE_FLAGS, v))
        score = min(100, sum(B.RULE_WEIGHTS[k] * f[k] for k in B.RULE_FLAGS))
        cl = f["daily_limit_breach"] + f["velocity_spike"] + f["new_beneficiary_risk"] + f["large_amount_anomaly"] + f["high_merchant_risk"]
        ato = f["account_takeover_signal"]
        if ato and cl >= 2 or score >= 85:
            a = "LOCK"
        elif (f["daily_limit_breach"] or ato or (f["velocity_spike"] and cl >= 2)
              or (f["new_beneficiary_risk"] and f["high_merchant_risk"])
              or (f["large_amount_anomaly"] and f["high_merchant_risk"]) or score >= 65):
            a = "BLOCK"
        elif f["velocity_spike"] or f["new_beneficiary_risk"] or f["large_amount_anomaly"] or f["failed_login_risk"] or score >= 35:
            a = "WARN"
        else:
            a = "ALLOW"
        assert got[v] == (score, a), v


FINAL_BASE = dict(rule_risk_score=0, rule_action="ALLOW", reason_codes="NO_RULE_TRIGGERED", ml_fraud_score=5,
                  model_confidence=95, predicted_fraud=0, autoencoder_anomaly_score=10,
                  isolation_forest_anomaly_score=10, account_takeover_signal=0, daily_limit_breach=0,
                  velocity_spike=0, new_beneficiary_risk=0)


def _final(spark, **over):
    row = {**FINAL_BASE, **over}
    cols = list(row)
    types = {k: ("string" if isinstance(v, str) else "int") for k, v in row.items()}
    df = spark.createDataFrame([tuple(row[c] for c in cols)], ", ".join(f"{c} {types[c]}" for c in cols))
    return C.apply_final_decisions(df).first()


def test_final_base_allows(spark):
    r = _final(spark)
    # 0.45*5 + 0.30*0 + 0.25*10 = 4.75 -> 5
    assert (r.final_action, r.final_action_code, r.final_risk_score, r.final_reason) == ("ALLOW", 0, 5, "NO_RISK_SIGNAL")


def test_final_ato_high_ml_locks(spark):
    r = _final(spark, account_takeover_signal=1, ml_fraud_score=90)
    assert (r.final_action, r.final_action_code) == ("LOCK", 3)


def test_final_autoencoder_and_ml_lock(spark):
    assert _final(spark, autoencoder_anomaly_score=96, ml_fraud_score=90).final_action == "LOCK"


def test_final_autoencoder_warn(spark):
    assert _final(spark, autoencoder_anomaly_score=75).final_action == "WARN"


def test_final_rule_block_reason(spark):
    r = _final(spark, rule_action="BLOCK", rule_risk_score=30, reason_codes="DAILY_LIMIT_BREACH",
               daily_limit_breach=1)
    assert r.final_action == "BLOCK"
    assert r.final_reason == "RULE_BLOCK|DAILY_LIMIT_BREACH"


def test_half_even_rounding(spark):
    # conf 60 -> .30*ml + .40*rule + .30*anom: ml=5, rule=0, anom=5 -> 3.0 ; use ml=15,anom=0 -> 4.5 -> 4
    r = _final(spark, model_confidence=60, ml_fraud_score=15, autoencoder_anomaly_score=0,
               isolation_forest_anomaly_score=0)
    assert r.final_risk_score == 4
