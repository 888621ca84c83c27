"""Registered queries for cost-sensitive decisions (D) and cases (F)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from ledgerlens.operators import cases as CS
from ledgerlens.operators import cost as CO
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import REQUESTS_CTE, with_
from ledgerlens.sources.fixtures import REQUEST_COLUMNS, case_events_orders, requests_orders
from ledgerlens.session import ensure_checkpoint_dir
from ledgerlens.sources.tables import read_table, read_tolerant

AS_OF = "2026-01-01T00:00:00+00:00"

_SEV = " + ".join(f"CASE WHEN {n} THEN {w} ELSE 0 END" for n, w in CO.RULE_WEIGHTS.items())

COST_CTE = REQUESTS_CTE + f""",
cs AS (
  SELECT *, greatest(0e0, least(1e0, fraud_probability)) AS raw,
    greatest(0e0, least(1e0, model_confidence)) AS conf, anomaly_flag AS anom,
    least(100, {_SEV}) AS sev
  FROM req),
ca AS (SELECT *, CASE WHEN sev >= 80 THEN greatest(raw + 0.25e0, 0.75e0) WHEN sev >= 40 THEN raw + 0.12e0
                      WHEN sev > 0 THEN raw + 0.05e0 ELSE raw END AS a1 FROM cs),
cb AS (SELECT *, CASE WHEN anom THEN a1 + 0.10e0 ELSE a1 END AS a2 FROM ca),
cc AS (SELECT *, CASE WHEN anom AND raw >= 0.35e0 THEN a2 + 0.15e0 ELSE a2 END AS a3 FROM cb),
cd AS (SELECT *, CASE WHEN conf < 0.55e0 THEN a3 + 0.08e0 ELSE a3 END AS a4 FROM cc),
cost AS (
  SELECT *, greatest(0e0, least(1e0, a4)) AS adjusted_risk_score FROM cd),
costd AS (
  SELECT *, CASE WHEN adjusted_risk_score >= 0.75e0 THEN 'BLOCK' WHEN adjusted_risk_score >= 0.35e0 THEN 'REVIEW'
                 ELSE 'ALLOW' END AS decision,
    adjusted_risk_score * 8.0e0 AS expected_allow_cost, 0.75e0 AS expected_review_cost,
    (1.0e0 - adjusted_risk_score) * 1.0e0 AS expected_block_cost
  FROM cost)"""


def _requests(spark, sf):
    return requests_orders(read_table(spark, sf, "orders"))


def _scored(spark, sf):
    return CO.cost_decisions(_requests(spark, sf))


POLICY_CUT = 50


def policy_versions(orders):
    """A policy table from the orders: per priority and year, in force from the first order on,
    with thresholds that follow the share of large orders."""
    year = orders.groupBy(F.col("o_orderpriority").alias("segment"), F.year("o_orderdate").alias("y")).agg(
        F.min("o_orderdate").alias("valid_from"), F.count(F.lit(1)).alias("n"))
    return year.select("segment", "valid_from", (0.2 + (F.col("n") % POLICY_CUT) / 200e0).alias("review_threshold"),
                       (0.6 + (F.col("n") % POLICY_CUT) / 250e0).alias("block_threshold"))


@register("cost_decision_by_policy", with_(COST_CTE, f""",
pv AS (SELECT o_orderpriority AS segment, year(o_orderdate) AS y, min(o_orderdate) AS valid_from,
         2e-1 + (count(*) % {POLICY_CUT}) / 200e0 AS rt, 6e-1 + (count(*) % {POLICY_CUT}) / 250e0 AS bt FROM orders GROUP BY ALL),
po AS (SELECT concat('TXN_', CAST(o_orderkey AS STRING)) AS transaction_id, p.rt, p.bt
       FROM orders ASOF LEFT JOIN pv p ON o_orderpriority = p.segment AND o_orderdate >= p.valid_from)
SELECT transaction_id, round_even(rt, 9) AS policy_review, round_even(bt, 9) AS policy_block, adj AS adjusted_risk_score,
  CASE WHEN adj >= bt THEN 'BLOCK' WHEN adj >= rt THEN 'REVIEW' ELSE 'ALLOW' END AS decision
FROM (SELECT transaction_id, rt, bt, greatest(0e0, least(1e0,
        CASE WHEN conf < 0.55e0 THEN a3 + 0.08e0 ELSE a3 END)) AS adj
      FROM (SELECT *, CASE WHEN anom AND raw >= rt THEN a2 + 0.15e0 ELSE a2 END AS a3
            FROM (SELECT *, CASE WHEN anom THEN a1 + 0.10e0 ELSE a1 END AS a2
                  FROM (SELECT cs.transaction_id, raw, conf, anom, rt, bt, CASE WHEN sev >= 80 THEN greatest(raw + 0.25e0, bt) WHEN sev >= 40 THEN raw + 0.12e0
                                 WHEN sev > 0 THEN raw + 0.05e0 ELSE raw END AS a1 FROM cs JOIN po USING (transaction_id)))))"""))
def q_cost_decision_by_policy(spark, sf):
    """Thresholds by segment and time from a table of policy versions."""
    orders = read_table(spark, sf, "orders")
    rows = orders.select("o_orderpriority", "o_orderdate", *[F.expr(e).alias(n) for n, e in REQUEST_COLUMNS])
    d = CO.cost_decisions_by_policy(rows, policy_versions(orders), "o_orderpriority", "o_orderdate")
    return d.select("transaction_id", F.bround("policy_review", 9).alias("policy_review"), F.bround("policy_block", 9).alias("policy_block"),
                    "adjusted_risk_score", "decision")


@register("rule_severity", with_(COST_CTE, "SELECT transaction_id, sev AS rule_severity_score FROM costd"))
def q_rule_severity(spark, sf):
    return _scored(spark, sf).select("transaction_id", "rule_severity_score")


@register("cost_adjusted_risk", with_(COST_CTE, """SELECT transaction_id, raw AS raw_fraud_probability,
  adjusted_risk_score FROM costd"""))
def q_cost_adjusted_risk(spark, sf):
    return _scored(spark, sf).select("transaction_id", "raw_fraud_probability", "adjusted_risk_score")


@register("expected_costs", with_(COST_CTE, """SELECT transaction_id, expected_allow_cost, expected_review_cost,
  expected_block_cost FROM costd"""))
def q_expected_costs(spark, sf):
    return _scored(spark, sf).select("transaction_id", "expected_allow_cost", "expected_review_cost",
                                     "expected_block_cost")


@register("cost_decision", with_(COST_CTE, "SELECT transaction_id, decision FROM costd"))
def q_cost_decision(spark, sf):
    return _scored(spark, sf).select("transaction_id", "decision")


@register("cost_decision_counts", with_(COST_CTE, """SELECT decision, count(*) AS n,
  round_even(avg(adjusted_risk_score), 9) AS mean_adjusted_risk FROM costd GROUP BY decision"""))
def q_cost_decision_counts(spark, sf):
    return (_scored(spark, sf).groupBy("decision")
            .agg(F.count(F.lit(1)).alias("n"), F.bround(F.avg("adjusted_risk_score"), 9).alias("mean_adjusted_risk")))


@register("scored_requests", with_(COST_CTE, """SELECT transaction_id, user_id, decision, raw AS raw_fraud_probability,
  adjusted_risk_score, sev AS rule_severity_score, anom AS anomaly_flag, conf AS model_confidence FROM costd"""))
def q_scored_requests(spark, sf):
    return CO.score_requests(_requests(spark, sf)).select(
        "transaction_id", "user_id", "decision", "raw_fraud_probability", "adjusted_risk_score",
        "rule_severity_score", "anomaly_flag", "model_confidence")


# The reason and explanation sentences, as the operator must give them.
@register("cost_reasons", with_(COST_CTE, """,
rs AS (SELECT *, list_filter([
    'Base fraud probability: ' || printf('%.3f', raw),
    CASE WHEN sev >= 80 THEN 'Severe rule risk detected with severity score ' || sev || '/100'
         WHEN sev >= 40 THEN 'Moderate rule risk detected with severity score ' || sev || '/100'
         WHEN sev > 0 THEN 'Minor rule risk detected with severity score ' || sev || '/100' END,
    CASE WHEN sev >= 80 THEN 'Severe rule risk forces a block-level decision' END,
    CASE WHEN anom THEN 'Anomaly detector flagged unusual transaction behavior' END,
    CASE WHEN anom AND raw >= 0.35e0 THEN 'Anomaly flag combined with elevated fraud probability' END,
    CASE WHEN conf < 0.55e0 THEN 'Model confidence is low at ' || printf('%.3f', conf) END,
    'Adjusted risk ' || printf('%.3f', adjusted_risk_score) || CASE WHEN adjusted_risk_score >= 0.75e0 THEN ' exceeds block threshold 0.750'
      WHEN adjusted_risk_score >= 0.35e0 THEN ' exceeds review threshold 0.350' ELSE ' is below review threshold 0.350' END],
  lambda x: x IS NOT NULL) AS r FROM costd)
SELECT transaction_id, array_to_string(r, '|') AS reasons, concat_ws(chr(10), 'Decision: ' || decision,
  'Raw fraud probability: ' || printf('%.3f', raw), 'Adjusted risk score: ' || printf('%.3f', adjusted_risk_score),
  'Rule severity score: ' || sev || '/100', 'Anomaly flag: ' || CASE WHEN anom THEN 'True' ELSE 'False' END,
  'Model confidence: ' || printf('%.3f', conf), 'Reasons:', array_to_string(list_transform(r, lambda x: '- ' || x), chr(10))) AS explanation
FROM rs"""))
def q_cost_reasons(spark, sf):
    """D7 + D8: reason lists and explanation texts."""
    s = _scored(spark, sf)
    return s.select("transaction_id", F.array_join("reasons", "|").alias("reasons"), CO.explanation_text(s).alias("explanation"))


_QPROB = "(CAST(o_orderkey * 53 % 101 AS INT) - 3) / 95e0"


@register("request_quarantine", f"""SELECT concat('TXN_', CAST(o_orderkey AS STRING)) AS transaction_id,
  CASE WHEN {_QPROB} < 0 OR {_QPROB} > 1 THEN 'fraud_probability must be within [0, 1]' END AS reject_reason
FROM orders WHERE {_QPROB} < 0 OR {_QPROB} > 1""")
def q_request_quarantine(spark, sf):
    """Requests with a shifted probability; out-of-range rows are quarantined."""
    cols = [(n, _QPROB if n == "fraud_probability" else e) for n, e in REQUEST_COLUMNS]
    req = read_table(spark, sf, "orders").select(*[F.expr(e).alias(n) for n, e in cols])
    _, bad = CO.validate_requests(req)
    return bad.select("transaction_id", "reject_reason")


# ---------------- F: cases over D13-enriched requests ----------------

CASE_CTE = COST_CTE + """,
ci AS (
  SELECT *, decision AS final_decision, raw AS fp, adjusted_risk_score AS rs, conf AS mc FROM costd
  WHERE decision IN ('REVIEW', 'BLOCK') OR anom OR adjusted_risk_score >= 0.35e0),
ce AS (
  SELECT *,
    greatest(CASE WHEN amount_limit_violation THEN 60 ELSE 0 END, CASE WHEN daily_limit_violation THEN 65 ELSE 0 END,
      CASE WHEN velocity_violation THEN 55 ELSE 0 END, CASE WHEN foreign_ip THEN 50 ELSE 0 END,
      CASE WHEN new_device THEN 35 ELSE 0 END, CASE WHEN multiple_failed_logins THEN 70 ELSE 0 END,
      CASE WHEN account_takeover_pattern THEN 90 ELSE 0 END, CASE WHEN blacklisted_merchant THEN 85 ELSE 0 END,
      CASE WHEN high_risk_country THEN 70 ELSE 0 END, CASE WHEN unusual_time THEN 30 ELSE 0 END,
      CASE WHEN anom THEN 65 ELSE 0 END, CASE WHEN mc < 0.55e0 THEN 40 ELSE 0 END,
      CASE WHEN fp >= 0.75e0 THEN 80 WHEN fp >= 0.35e0 THEN 45 ELSE 0 END) AS max_sev,
    (foreign_ip OR new_device OR multiple_failed_logins OR account_takeover_pattern) AS has_ato
  FROM ci),
cp AS (
  SELECT *,
    CASE WHEN final_decision = 'BLOCK' AND (rs >= 0.90e0 OR fp >= 0.90e0 OR max_sev >= 85) THEN 'CRITICAL'
         WHEN final_decision = 'BLOCK' THEN 'HIGH'
         WHEN final_decision = 'REVIEW' AND (rs >= 0.65e0 OR fp >= 0.65e0 OR anom) THEN 'HIGH'
         WHEN final_decision = 'REVIEW' THEN 'MEDIUM'
         WHEN anom OR max_sev >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS priority
  FROM ce),
cases AS (
  SELECT 'CASE-' || upper(substr(sha256(transaction_id), 1, 10)) AS case_id, transaction_id, user_id,
    final_decision AS decision, priority,
    CASE WHEN final_decision IN ('REVIEW', 'BLOCK') THEN 'OPEN' ELSE 'CLOSED' END AS status,
    rs AS risk_score, fp AS fraud_probability, anom AS anomaly_flag, mc AS model_confidence,
    CASE WHEN final_decision = 'BLOCK' AND has_ato THEN 'Block the transaction, verify user identity, and review recent account activity for account takeover indicators.'
         WHEN final_decision = 'BLOCK' AND priority = 'CRITICAL' THEN 'Block the transaction immediately, escalate to fraud operations, and require analyst approval before resolution.'
         WHEN final_decision = 'BLOCK' THEN 'Block the transaction and send it for fraud analyst review.'
         WHEN final_decision = 'REVIEW' AND anom THEN 'Route to step-up authentication and analyst review because anomaly signals indicate unusual behavior.'
         WHEN final_decision = 'REVIEW' THEN 'Route to step-up authentication or manual review before allowing the transaction.'
         WHEN anom THEN 'Allow with monitoring. Keep the transaction in the audit trail because an anomaly signal was observed.'
         ELSE 'Allow the transaction and retain the standard audit trace.' END AS recommended_action,
    amount_limit_violation, daily_limit_violation, velocity_violation, foreign_ip, new_device, multiple_failed_logins,
    account_takeover_pattern, blacklisted_merchant, high_risk_country, unusual_time, anom, mc, fp
  FROM cp)"""

_EVIDENCE_ITEMS = [(n, t, d, s) for n, t, d, s in CS.EVIDENCE_RULES]


def _evidence_union_sql() -> str:
    parts = []
    for k, (name, etype, desc, sev) in enumerate(_EVIDENCE_ITEMS):
        parts.append(f"SELECT case_id, transaction_id, {k} AS k, '{etype}' AS evidence_type, '{desc}' AS description, "
                     f"{sev} AS severity, '{name}' AS source FROM cases WHERE {name}")
    n = len(_EVIDENCE_ITEMS)
    parts.append(f"SELECT case_id, transaction_id, {n} AS k, 'anomaly', 'Anomaly detector flagged this transaction as unusual.', "
                 f"65, 'anomaly_detector' FROM cases WHERE anom")
    parts.append(f"SELECT case_id, transaction_id, {n + 1}, 'model_confidence', 'Model confidence is low at ' || printf('%.3f', mc) || '.', "
                 f"40, 'model_confidence' FROM cases WHERE mc < 0.55e0")
    parts.append(f"SELECT case_id, transaction_id, {n + 2}, 'model_score', CASE WHEN fp >= 0.75e0 THEN 'Fraud model probability is high at ' "
                 f"ELSE 'Fraud model probability is elevated at ' END || printf('%.3f', fp) || '.', "
                 f"CASE WHEN fp >= 0.75e0 THEN 80 ELSE 45 END, 'fraud_model' FROM cases WHERE fp >= 0.35e0")
    return "\n  UNION ALL ".join(parts)


EVIDENCE_CTE = CASE_CTE + f""",
ev AS (
  SELECT case_id, transaction_id, CAST(row_number() OVER (PARTITION BY case_id ORDER BY k) - 1 AS INTEGER) AS pos,
    evidence_type, description, severity, source
  FROM ({_evidence_union_sql()}))"""


def _cases(spark, sf):
    enriched = CO.enrich_with_scores(_requests(spark, sf))
    return CS.cases_from_records(enriched, as_of=AS_OF)


@register("case_evidence", with_(EVIDENCE_CTE, "SELECT case_id, transaction_id, pos, evidence_type, description, "
                                               "severity, source FROM ev"))
def q_case_evidence(spark, sf):
    return CS.evidence_items(_cases(spark, sf))


@register("case_records", with_(EVIDENCE_CTE, """SELECT c.transaction_id, c.decision AS final_decision, coalesce(s.sources, '') AS sources
FROM cases c LEFT JOIN (SELECT transaction_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM ev GROUP BY transaction_id) s
ON c.transaction_id = s.transaction_id"""))
def q_case_records(spark, sf):
    """Cases as records; the flags' names as one sorted text."""
    r = CS.case_records(_cases(spark, sf))
    return r.select("transaction_id", "final_decision", F.array_join(F.array_sort(F.map_keys("flags")), ",").alias("sources"))


@register("case_priority", with_(CASE_CTE, "SELECT transaction_id, priority FROM cases"))
def q_case_priority(spark, sf):
    return _cases(spark, sf).select("transaction_id", "priority")


@register("case_action", with_(CASE_CTE, "SELECT transaction_id, recommended_action FROM cases"))
def q_case_action(spark, sf):
    return _cases(spark, sf).select("transaction_id", "recommended_action")


@register("cases", with_(EVIDENCE_CTE, """SELECT c.case_id, c.transaction_id, user_id, decision, priority, status,
  risk_score, fraud_probability, anomaly_flag, model_confidence, recommended_action,
  CAST(coalesce(e.cnt, 0) AS INTEGER) AS evidence_count, coalesce(e.txt, '') AS evidence_text
FROM cases c LEFT JOIN (SELECT case_id, count(*) AS cnt, string_agg(description, '; ' ORDER BY pos) AS txt
                        FROM ev GROUP BY case_id) e ON c.case_id = e.case_id"""))
def q_cases(spark, sf):
    return CS.case_table(_cases(spark, sf)).select(
        "case_id", "transaction_id", "user_id", "decision", "priority", "status", "risk_score",
        "fraud_probability", "anomaly_flag", "model_confidence", "recommended_action",
        "evidence_count", "evidence_text")


@register("case_summary", with_(CASE_CTE, """SELECT count(*) AS total_cases,
  round_even(coalesce(avg(risk_score), 0e0), 9) AS average_risk_score,
  round_even(coalesce(avg(fraud_probability), 0e0), 9) AS average_fraud_probability FROM cases"""))
def q_case_summary(spark, sf):
    t = CS.case_summary_totals(_cases(spark, sf))
    return t.select("total_cases", F.bround("average_risk_score", 9).alias("average_risk_score"),
                    F.bround("average_fraud_probability", 9).alias("average_fraud_probability"))


@register("case_summary_counts", with_(CASE_CTE, """SELECT dimension, value, count(*) AS n FROM (
  SELECT 'status' AS dimension, status AS value FROM cases
  UNION ALL SELECT 'priority', priority FROM cases
  UNION ALL SELECT 'decision', decision FROM cases) GROUP BY dimension, value ORDER BY dimension, value"""))
def q_case_summary_counts(spark, sf):
    return CS.case_summary_counts(_cases(spark, sf))


@register("case_latest_status", with_(CASE_CTE, """,
evs AS (
  SELECT concat('TXN_', CAST(o_orderkey AS STRING)) AS transaction_id, 'UNDER_REVIEW' AS status,
         o_orderdate + INTERVAL 1 DAY AS ts FROM orders
  UNION ALL
  SELECT concat('TXN_', CAST(o_orderkey AS STRING)),
         CASE o_orderstatus WHEN 'F' THEN 'RESOLVED_FRAUD' WHEN 'O' THEN 'ESCALATED' ELSE 'RESOLVED_GENUINE' END,
         o_orderdate + to_days(CAST(2 + o_orderkey % 3 AS INTEGER)) FROM orders),
lat AS (
  SELECT 'CASE-' || upper(substr(sha256(transaction_id), 1, 10)) AS case_id,
         arg_max(status, strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00') || status) AS status,
         max(strftime(ts, '%Y-%m-%dT%H:%M:%S+00:00')) AS updated_at
  FROM evs GROUP BY 1)
SELECT c.case_id, coalesce(l.status, c.status) AS status,
  coalesce(l.updated_at, '""" + AS_OF + """') AS updated_at
FROM cases c LEFT JOIN lat l ON c.case_id = l.case_id"""))
def q_case_latest_status(spark, sf):
    ev = case_events_orders(read_table(spark, sf, "orders"))
    ev = ev.select(CS.case_id_column(F.col("transaction_id")).alias("case_id"), "status",
                   F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("updated_at"))
    return CS.latest_status(_cases(spark, sf), ev).select("case_id", "status", "updated_at")


@register("csv_quarantine", """SELECT CAST(o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 AS BOOLEAN) AS bad, count(*) AS n,
  CAST(coalesce(sum(CASE WHEN NOT (o_orderkey % 97 = 0 OR o_orderkey % 89 = 0) THEN o_custkey END), 0) AS BIGINT) AS custkeys FROM orders GROUP BY 1""")
def q_csv_quarantine(spark, sf):
    """A1: the orders as a CSV file with damaged lines (a value that is no number; a value too
    few), read back into good rows and a quarantine table."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"csv-{uuid.uuid4().hex[:12]}")
    k = F.col("o_orderkey")
    line = F.when(k % 97 == 0, F.concat(k.cast("string"), F.lit(",x,1.5"))).when(k % 89 == 0, F.concat(k.cast("string"), F.lit(",7"))) \
        .otherwise(F.concat_ws(",", k.cast("string"), F.col("o_custkey").cast("string"), F.col("o_totalprice").cast("string")))
    read_table(spark, sf, "orders").select(line.alias("value")).write.text(path)
    good, bad = read_tolerant(spark, path, "o_orderkey bigint, o_custkey bigint, o_totalprice double", header=False)
    return (good.select(F.lit(False).alias("bad"), "o_custkey").unionByName(bad.select(F.lit(True).alias("bad"), F.lit(None).cast("bigint").alias("o_custkey")))
            .groupBy("bad").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("o_custkey"), F.lit(0)).alias("custkeys")))
