"""Fraud-case creation, triage and reporting as projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import (clip01, first_present, fmt3, ordered_nonnull, prob_from, py_strip,
                                       safe_str, to_double, truthy_text)

# Evidence catalogue (flag -> type, description, severity) in order.
EVIDENCE_RULES = [
    ("amount_limit_violation", "rule", "Transaction amount exceeded the configured risk threshold.", 60),
    ("daily_limit_violation", "rule", "User daily transaction activity exceeded the configured threshold.", 65),
    ("velocity_violation", "rule", "Transaction velocity is higher than expected for the user.", 55),
    ("foreign_ip", "account_takeover", "Transaction or login context includes a foreign IP indicator.", 50),
    ("new_device", "account_takeover", "Transaction was initiated from a new device.", 35),
    ("multiple_failed_logins", "account_takeover", "Multiple failed login attempts were observed.", 70),
    ("account_takeover_pattern", "account_takeover", "Combined signals suggest possible account takeover behavior.", 90),
    ("blacklisted_merchant", "rule", "Merchant appears in a high-risk or blocked merchant list.", 85),
    ("high_risk_country", "rule", "Transaction is associated with a high-risk country or region.", 70),
    ("unusual_time", "behavior", "Transaction occurred at an unusual time for the user.", 30),
]

# Recommended-action texts.
ACTION_TEXT = {
    "block_ato": ("Block the transaction, verify user identity, and review recent "
                  "account activity for account takeover indicators."),
    "block_critical": ("Block the transaction immediately, escalate to fraud operations, "
                       "and require analyst approval before resolution."),
    "block": "Block the transaction and send it for fraud analyst review.",
    "review_anomaly": ("Route to step-up authentication and analyst review because anomaly "
                       "signals indicate unusual behavior."),
    "review": "Route to step-up authentication or manual review before allowing the transaction.",
    "allow_anomaly": ("Allow with monitoring. Keep the transaction in the audit trail because "
                      "an anomaly signal was observed."),
    "allow": "Allow the transaction and retain the standard audit trace.",
}

TXN_ALIASES = ["transaction_id", "txn_id", "id"]
USER_ALIASES = ["user_id", "customer_id", "account_id"]
DECISION_ALIASES = ["final_decision", "decision", "final_action"]
PROB_ALIASES = ["fraud_probability", "ml_fraud_probability", "fraud_score"]
RISK_ALIASES = ["risk_score", "adjusted_risk_score"]
CONF_ALIASES = ["model_confidence", "ml_confidence", "confidence_score"]
ANOMALY_ALIASES = ["anomaly_flag", "is_anomaly", "anomaly_detected"]

CASE_STATUSES = ["OPEN", "UNDER_REVIEW", "ESCALATED", "RESOLVED_FRAUD", "RESOLVED_GENUINE", "CLOSED"]


def _ev(etype: str, desc: Column | str, severity: int, source: str) -> Column:
    d = desc if isinstance(desc, Column) else F.lit(desc)
    return F.struct(F.lit(etype).alias("evidence_type"), d.alias("description"),
                    F.lit(max(0, min(100, severity))).alias("severity"), F.lit(source).alias("source"))


def evidence_column() -> Column:
    """F3 (+F4 clamp): ordered evidence array<struct> over the normalised
    case input (flag booleans, anomaly_flag, model_confidence, fraud_probability)."""
    items = [F.when(F.col(name), _ev(t, d, s, name)) for name, t, d, s in EVIDENCE_RULES]
    items.append(F.when(F.col("anomaly_flag"), _ev(
        "anomaly", "Anomaly detector flagged this transaction as unusual.", 65, "anomaly_detector")))
    conf = F.col("model_confidence")
    items.append(F.when(conf < 0.55, _ev("model_confidence", F.concat(
        F.lit("Model confidence is low at "), fmt3(conf), F.lit(".")), 40, "model_confidence")))
    prob = F.col("fraud_probability")
    items.append(
        F.when(prob >= 0.75, _ev("model_score", F.concat(F.lit("Fraud model probability is high at "),
                                                         fmt3(prob), F.lit(".")), 80, "fraud_model"))
        .when(prob >= 0.35, _ev("model_score", F.concat(F.lit("Fraud model probability is elevated at "),
                                                        fmt3(prob), F.lit(".")), 45, "fraud_model")))
    return ordered_nonnull(items)


def priority_column(decision: Column, risk: Column, prob: Column, anomaly: Column, evidence: Column) -> Column:
    """CRITICAL / HIGH / MEDIUM / LOW."""
    max_sev = F.coalesce(F.array_max(evidence.getField("severity")), F.lit(0))
    return (F.when((decision == "BLOCK") & ((risk >= 0.90) | (prob >= 0.90) | (max_sev >= 85)), "CRITICAL")
            .when(decision == "BLOCK", "HIGH")
            .when((decision == "REVIEW") & ((risk >= 0.65) | (prob >= 0.65) | anomaly), "HIGH")
            .when(decision == "REVIEW", "MEDIUM")
            .when(anomaly | (max_sev >= 50), "MEDIUM")
            .otherwise("LOW"))


def recommended_action_column(decision: Column, priority: Column, anomaly: Column, evidence: Column) -> Column:
    """F6."""
    has_ato = F.array_contains(evidence.getField("evidence_type"), "account_takeover")
    return (F.when((decision == "BLOCK") & has_ato, ACTION_TEXT["block_ato"])
            .when((decision == "BLOCK") & (priority == "CRITICAL"), ACTION_TEXT["block_critical"])
            .when(decision == "BLOCK", ACTION_TEXT["block"])
            .when((decision == "REVIEW") & anomaly, ACTION_TEXT["review_anomaly"])
            .when(decision == "REVIEW", ACTION_TEXT["review"])
            .when(anomaly, ACTION_TEXT["allow_anomaly"])
            .otherwise(ACTION_TEXT["allow"]))


def case_id_column(transaction_id: Column) -> Column:
    """F8: deterministic id, stable across reruns (replaces a random uuid)."""
    return F.concat(F.lit("CASE-"), F.upper(F.substring(F.sha2(transaction_id, 256), 1, 10)))


def normalize_case_input(records: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Resolve every alias chain once (plan time) into canonical columns:
    ids, decision, clipped probabilities, booleans for the ten rule flags,
    and ``_create`` (the F9 case filter, which has its own alias order).
    Two projections: every alias value is computed once, and the derived
    columns (and a pushed-down case filter) reference those results instead
    of re-inlining the upstream expressions."""
    df = records.drop(*keep)  # carried columns are no aliases
    tid = safe_str(df, TXN_ALIASES, "")
    if first_present(df, TXN_ALIASES) is None:
        tid = F.concat(F.lit("TXN-"), F.upper(F.substring(
            F.sha2(F.to_json(F.struct(*[F.col(c) for c in df.columns])), 256), 1, 8)))
    dname = first_present(df, DECISION_ALIASES)
    dec_raw = F.upper(py_strip(F.col(dname).cast("string"))) if dname else F.lit(None).cast("string")
    risk_name = first_present(df, RISK_ALIASES)
    filter_risk = first_present(df, ["risk_score", "fraud_probability"])
    first = records.select(
        *keep, tid.alias("transaction_id"),
        safe_str(df, USER_ALIASES, "UNKNOWN_USER").alias("user_id"),
        dec_raw.alias("_dec_raw"),
        prob_from(df, PROB_ALIASES, 0.0).alias("fraud_probability"),
        (clip01(to_double(df, risk_name, 0.0)) if risk_name else F.lit(None).cast("double")).alias("_risk"),
        (clip01(to_double(df, filter_risk, 0.0)) if filter_risk else F.lit(0.0)).alias("_frisk"),
        truthy_text(df, first_present(df, ANOMALY_ALIASES)).alias("anomaly_flag"),
        prob_from(df, CONF_ALIASES, 1.0).alias("model_confidence"),
        safe_str(df, ["analyst_note"], "").alias("analyst_note"),
        *[truthy_text(df, name).alias(name) for name, _, _, _ in EVIDENCE_RULES],
    )
    dec = F.coalesce(F.nullif(F.col("_dec_raw"), F.lit("")), F.lit("REVIEW"))
    return first.withColumns({
        "decision": F.when(dec.isin("ALLOW", "REVIEW", "BLOCK"), dec).otherwise(F.lit("REVIEW")),
        "risk_score": F.col("_risk") if risk_name else F.col("fraud_probability"),
        "_create": (F.coalesce(F.col("_dec_raw").isin("REVIEW", "BLOCK"), F.lit(False))
                    | F.col("anomaly_flag") | (F.col("_frisk") >= 0.35)),
    }).drop("_dec_raw", "_risk", "_frisk")


def create_cases(records: DataFrame, as_of: str | None = None, only_flagged: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """one case row per input record (F10 filters first with ``only_flagged``); ``keep``
    names record columns to carry.

    ``as_of`` is the creation time string; when None the batch start time is
    used (``current_timestamp`` is fixed per query)."""
    base = normalize_case_input(records, keep)
    if only_flagged:
        # The condition rests on the whole scoring chain. Pushed below the projections it
        # would be written out in full (hundreds of kB) and planned for most of a minute, to
        # evaluate that chain twice; the row number, which is never negative, holds it here.
        base = base.withColumn("_row", F.monotonically_increasing_id()).where(F.col("_create") & (F.col("_row") >= 0)).drop("_row")
    now = (F.lit(as_of) if as_of is not None
           else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    c = F.col
    base = base.withColumns({"evidence": evidence_column(), "created_at": now})
    base = base.withColumn("priority", priority_column(c("decision"), c("risk_score"), c("fraud_probability"),
                                                       c("anomaly_flag"), c("evidence")))
    return base.select(
        *keep, case_id_column(c("transaction_id")).alias("case_id"), "transaction_id", "user_id", "decision",
        "priority",
        F.when(c("decision").isin("REVIEW", "BLOCK"), "OPEN").otherwise("CLOSED").alias("status"),
        "risk_score", "fraud_probability", "anomaly_flag", "model_confidence", "evidence",
        recommended_action_column(c("decision"), c("priority"), c("anomaly_flag"), c("evidence"))
        .alias("recommended_action"),
        "analyst_note", "created_at", c("created_at").alias("updated_at"))


def cases_from_records(records: DataFrame, as_of: str | None = None) -> DataFrame:
    """filter then create, in one narrow stage."""
    return create_cases(records, as_of, only_flagged=True)


def case_table(cases: DataFrame) -> DataFrame:
    """flat case table with evidence count and text."""
    return cases.withColumns({
        "evidence_count": F.size("evidence"),
        "evidence_text": F.array_join(F.col("evidence.description"), "; "),
    })


def evidence_items(cases: DataFrame) -> DataFrame:
    """F3 flat form: one row per evidence item with its position."""
    # The outer form keeps the optimizer from filtering on the array's size, which would
    # compute the whole scoring chain a second time below.
    return (cases.select("case_id", "transaction_id", F.posexplode_outer("evidence").alias("pos", "e"))
            .where(F.col("pos").isNotNull()).select("case_id", "transaction_id", "pos", "e.*"))


def case_records(cases: DataFrame) -> DataFrame:
    """The case as a transaction record: its scores under the record's names and a
    ``flags`` map that is true for every (non-empty) source of its evidence. The flags stay
    in a map, as a source may be called like a score (``model_confidence``)."""
    sources = F.array_distinct(F.filter("evidence.source", lambda s: s.isNotNull() & (s != "")))
    return cases.select(
        "transaction_id", "user_id", F.col("decision").alias("final_decision"), "risk_score", "fraud_probability",
        "model_confidence", "anomaly_flag",
        F.map_from_arrays(sources, F.transform(sources, lambda _: F.lit(True))).alias("flags"))


def latest_status(cases: DataFrame, status_events: DataFrame) -> DataFrame:
    """apply status-update events (case_id, status, updated_at[, analyst_note]):
    the latest event per case wins (``max_by``, partial aggregation before
    the shuffle), then a left join keeps cases without events unchanged."""
    note = F.col("analyst_note") if "analyst_note" in status_events.columns else F.lit(None).cast("string")
    latest = (status_events.select("case_id", "status", F.col("updated_at").cast("string").alias("updated_at"),
                                   note.alias("analyst_note"))
              .groupBy("case_id")
              .agg(F.max_by(F.struct("status", "updated_at", "analyst_note"),
                            F.struct("updated_at", "status")).alias("_e")))
    j = cases.join(latest, "case_id", "left")
    return j.withColumns({
        "status": F.coalesce(F.col("_e.status"), F.col("status")),
        "updated_at": F.coalesce(F.col("_e.updated_at"), F.col("updated_at")),
        "analyst_note": F.coalesce(F.col("_e.analyst_note"), F.col("analyst_note")),
    }).drop("_e")


def case_report_column() -> Column:
    """Markdown case report (one string column; written as a table)."""
    c = F.col
    ev_lines = F.when(F.size("evidence") > 0, F.array_join(F.transform("evidence", lambda e: F.concat(
        F.lit("- ["), e["evidence_type"], F.lit("] "), e["description"], F.lit(" (severity: "),
        e["severity"].cast("string"), F.lit("/100, source: "), e["source"], F.lit(")"))), "\n")) \
        .otherwise(F.lit("- No additional evidence items were recorded."))
    note = F.when(F.trim(c("analyst_note")) != "", c("analyst_note")).otherwise(F.lit("No analyst note recorded."))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("# Fraud Investigation Case Report: "), c("case_id")), F.lit(""),
        F.lit("## Case Summary"), F.lit(""),
        F.concat(F.lit("- Transaction ID: `"), c("transaction_id"), F.lit("`")),
        F.concat(F.lit("- User ID: `"), c("user_id"), F.lit("`")),
        F.concat(F.lit("- Final Decision: `"), c("decision"), F.lit("`")),
        F.concat(F.lit("- Priority: `"), c("priority"), F.lit("`")),
        F.concat(F.lit("- Status: `"), c("status"), F.lit("`")),
        F.concat(F.lit("- Risk Score: `"), fmt3(c("risk_score")), F.lit("`")),
        F.concat(F.lit("- Fraud Probability: `"), fmt3(c("fraud_probability")), F.lit("`")),
        F.concat(F.lit("- Model Confidence: `"), fmt3(c("model_confidence")), F.lit("`")),
        F.concat(F.lit("- Anomaly Flag: `"), F.when(c("anomaly_flag"), "True").otherwise("False"), F.lit("`")),
        F.concat(F.lit("- Created At: `"), c("created_at"), F.lit("`")),
        F.concat(F.lit("- Updated At: `"), c("updated_at"), F.lit("`")),
        F.lit(""), F.lit("## Evidence"), F.lit(""), ev_lines, F.lit(""),
        F.lit("## Recommended Action"), F.lit(""), c("recommended_action"), F.lit(""),
        F.lit("## Analyst Note"), F.lit(""), note, F.lit(""),
    )


def case_reports(cases: DataFrame) -> DataFrame:
    return cases.select("case_id", case_report_column().alias("report_md"))


def case_summary_totals(cases: DataFrame) -> DataFrame:
    """F14 scalar part: zeros when there are no cases."""
    return cases.agg(F.count(F.lit(1)).alias("total_cases"),
                     F.coalesce(F.avg("risk_score"), F.lit(0.0)).alias("average_risk_score"),
                     F.coalesce(F.avg("fraud_probability"), F.lit(0.0)).alias("average_fraud_probability"))


def case_summary_counts(cases: DataFrame) -> DataFrame:
    """F14 count maps in one scan: (dimension, value, n) sorted by value."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value"))
                      for d in ("status", "priority", "decision")])
    return (cases.select(F.inline(pairs)).groupBy("dimension", "value")
            .agg(F.count(F.lit(1)).alias("n")).orderBy("dimension", "value"))
