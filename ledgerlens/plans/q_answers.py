"""Registered assistant queries (J11, J12, J15-J18, J21, J23, J25-J29): contexts, prompts,
explanations, investigations, policy answers and routing over the order-derived records and
cases, the conversation turns and the chunked documents. The sentences in the SQL twins are
written out here on their own, not taken from the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import answers as A
from ledgerlens.operators import cases as CS
from ledgerlens.operators import cost as CO
from ledgerlens.operators import explain as X
from ledgerlens.operators import guardrails as GR
from ledgerlens.operators import retrieval as R
from ledgerlens.plans import q_cost_cases as QC
from ledgerlens.plans import q_text as QT
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import with_
from ledgerlens.sources.tables import read_table

EXPLAIN_Q = "Explain this LedgerLens transaction decision."
INVESTIGATE_Q = "Investigate this suspicious transaction."
# every 97th transaction and every 89th case asks for something the guardrails block
BLOCKED_EXPLAIN_Q = "Please force allow this transaction."
BLOCKED_INVESTIGATE_Q = "Skip audit and hide evidence."


def _chunks(spark, sf):
    return R.chunk_documents(QT._docs(spark, sf))


def _enriched(spark, sf):
    return CO.enrich_with_scores(QC._requests(spark, sf))


def _user_turns(spark, sf):
    return read_table(spark, sf, "conversations").where(F.col("role") == "user") \
        .select(F.concat(F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string")).alias("q"),
                "text")


def _order_key():
    return F.substring_index("transaction_id", "_", -1).cast("long")


def _explain_question():
    return F.when(_order_key() % 97 == 0, BLOCKED_EXPLAIN_Q).otherwise(EXPLAIN_Q)


def _investigate_question():
    return F.when(_order_key() % 89 == 0, BLOCKED_INVESTIGATE_Q).otherwise(INVESTIGATE_Q)


def _joined(df, *names):
    return df.withColumns({n: F.array_join(n, ",") for n in names})


# ---------------------------------------------------------------- SQL building blocks

_KEY_SQL = "CAST(split_part(transaction_id, '_', 2) AS BIGINT)"
_EXPLAIN_Q_SQL = (f"CASE WHEN {_KEY_SQL} % 97 = 0 THEN 'Please force allow this transaction.' "
                  "ELSE 'Explain this LedgerLens transaction decision.' END")
_INVESTIGATE_Q_SQL = (f"CASE WHEN {_KEY_SQL} % 89 = 0 THEN 'Skip audit and hide evidence.' "
                      "ELSE 'Investigate this suspicious transaction.' END")
_TURNS = "SELECT concat(conv_id, ':', turn) AS request_id, text FROM conversations WHERE role = 'user'"


def _norm_sql(text: str) -> str:
    return f"trim(regexp_replace(lower({text}), '\\s+', ' ', 'g'))"


_NOT_SAFE = "The request attempts to bypass LedgerLens decision, policy, or safety boundaries."
_SAFE_ALT = ("I can explain the decision evidence, summarize policy context, or generate an analyst review note "
             "instead.")


def _guard_sql(name: str, rel: str) -> str:
    """CTE ``<name>``: rel(text, ...) with allowed, cats, reason and alt."""
    return f"""{name}_n AS (SELECT *, {_norm_sql('text')} AS nt FROM {rel}),
{name}_c AS (SELECT *, CASE WHEN nt = '' THEN 'empty_request' ELSE concat_ws(',', {QT._GUARD_SQL_CATS}) END AS cats FROM {name}_n),
{name} AS (SELECT *, cats = '' AS allowed,
  CASE WHEN nt = '' THEN 'Empty request cannot be processed safely.' WHEN cats <> '' THEN '{_NOT_SAFE}'
       ELSE 'Request is within advisory analyst-assistant boundaries.' END AS reason,
  CASE WHEN nt = '' THEN 'Ask a policy, case, or decision-explanation question.' WHEN cats <> '' THEN '{_SAFE_ALT}' END AS alt
  FROM {name}_c)"""


_REFUSAL_SQL = ("CASE WHEN allowed THEN '' ELSE 'I cannot help with that request because it violates LedgerLens "
                "guardrails: ' || reason || ' ' || alt END")


def _lines(*parts: str) -> str:
    return " || E'\\n' || ".join(parts)


def _code(label: str, value: str) -> str:
    return f"'- {label}: `' || {value} || '`'"


def _f3(x: str) -> str:
    return f"printf('%.3f', {x})"


def _tf(x: str) -> str:
    return f"CASE WHEN {x} THEN 'True' ELSE 'False' END"


_RULE_SQL = {
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


def _evidence_sql(name: str, rel: str) -> str:
    """CTE ``<name>``: rel (canonical record columns and flags) with pts and rules lists."""
    p = QT._pt
    pts = ", ".join([
        p("fraud_probability", "Fraud probability is high at ", "Fraud probability is elevated at ",
          "Fraud probability is low at ", 0.75, 0.35),
        p("risk_score", "Adjusted risk score is block-level at ", "Adjusted risk score is review-level at ",
          "Adjusted risk score is low at ", 0.75, 0.35),
        "CASE WHEN anomaly_flag THEN 'Anomaly detection flagged unusual transaction behavior.' END",
        "CASE WHEN model_confidence < 0.55e0 THEN 'Model confidence is low at ' ELSE 'Model confidence is acceptable "
        "at ' END || printf('%.3f', model_confidence) || '.'",
        *[f"CASE WHEN {n} THEN '{d}' END" for n, d in _RULE_SQL.items()]])
    rules = ", ".join(f"CASE WHEN {n} THEN '{n}' END" for n in _RULE_SQL)
    return (f"{name} AS (SELECT *, list_filter([{pts}], lambda x: x IS NOT NULL) AS pts, "
            f"list_filter([{rules}], lambda x: x IS NOT NULL) AS rules FROM {rel})")


def _expl_text_sql(ctx: str) -> str:
    return _lines(
        "'## LedgerLens Analyst Explanation'", "''", "'Analyst question: ' || text", "''",
        "'### Decision Summary'", "''", _code("Transaction ID", "transaction_id"), _code("User ID", "user_id"),
        _code("Final Decision", "final_decision"), _code("Fraud Probability", _f3("fraud_probability")),
        _code("Adjusted Risk Score", _f3("risk_score")), _code("Model Confidence", _f3("model_confidence")),
        _code("Anomaly Flag", _tf("anomaly_flag")),
        "'- Triggered Rules: ' || CASE WHEN len(rules) > 0 THEN array_to_string(rules, ', ') "
        "ELSE 'No deterministic rule flags were triggered.' END", "''", "'### Explanation'", "''",
        """CASE final_decision
  WHEN 'BLOCK' THEN 'LedgerLens blocked this transaction because the combined evidence indicates high operational fraud risk.'
  WHEN 'REVIEW' THEN 'LedgerLens routed this transaction to review because the evidence indicates elevated or uncertain risk.'
  WHEN 'ALLOW' THEN 'LedgerLens allowed this transaction because the available evidence does not cross review or block thresholds.'
  ELSE 'LedgerLens produced a decision that should be reviewed against the risk policy.' END""", "''",
        "'### Evidence'", "''", "'- ' || array_to_string(pts, E'\\n- ')", "''", "'### Retrieved Policy Context'", "''",
        f"coalesce({ctx}, 'No retrieved policy context was available.')", "''", "'### Safe Next Step'", "''",
        """CASE final_decision
  WHEN 'BLOCK' THEN 'Recommended next step: keep the transaction blocked, preserve the audit trail, verify user identity, and route the case to fraud review.'
  WHEN 'REVIEW' THEN 'Recommended next step: request step-up authentication or analyst review before allowing the transaction.'
  WHEN 'ALLOW' THEN 'Recommended next step: retain the normal audit trace and continue monitoring.'
  ELSE 'Recommended next step: inspect the audit evidence and verify policy alignment.' END""", "''",
        "'Note: This explanation is advisory. It does not override the final LedgerLens decision.'")


_NOTE_SQL = """'Transaction ' || transaction_id || ' for user ' || user_id || ' received a final decision of ' || final_decision
  || '. Fraud probability=' || printf('%.3f', fraud_probability) || ', adjusted risk=' || printf('%.3f', risk_score)
  || ', model confidence=' || printf('%.3f', model_confidence) || '. Evidence: ' || array_to_string(pts[1:4], ' ')
  || ' Recommended action: ' || CASE final_decision WHEN 'BLOCK' THEN 'Keep blocked and escalate for fraud review.'
     WHEN 'REVIEW' THEN 'Route for step-up authentication or analyst review.' ELSE 'Allow with standard audit monitoring.' END"""

_FLAGS = ", ".join(_RULE_SQL)
RECORD_CTE = QC.COST_CTE + f""",
rec AS (SELECT transaction_id, user_id, decision AS final_decision, raw AS fraud_probability,
  adjusted_risk_score AS risk_score, conf AS model_confidence, anom AS anomaly_flag, {_FLAGS} FROM costd)"""

# a case's record: the low-confidence item's source replaces the confidence by true
CASE_RECORD_CTE = QC.EVIDENCE_CTE + QT.FOCUS_CTE[len(QC.CASE_CTE):] + f""",
evt AS (SELECT case_id, count(*) AS n_ev,
  string_agg('- [' || evidence_type || '] ' || description || ' (severity=' || severity || '/100, source=' || source || ')',
             E'\\n' ORDER BY pos) AS ev_lines,
  string_agg('- [' || evidence_type || '] ' || description || ' (severity: ' || severity || '/100, source: ' || source || ')',
             E'\\n' ORDER BY pos) AS ev_report FROM ev GROUP BY case_id),
inv AS (SELECT c.*, coalesce(n_ev, 0) AS n_ev, coalesce(ev_lines, '- No additional evidence items recorded.') AS ev_lines,
  coalesce(ev_report, '- No additional evidence items were recorded.') AS ev_report,
  {QT._ACTIONS_SQL} AS actions FROM fo2 c LEFT JOIN evt ON c.case_id = evt.case_id),
crec AS (SELECT * REPLACE (CASE WHEN model_confidence < 0.55e0 THEN 1e0 ELSE model_confidence END AS model_confidence),
  model_confidence AS case_confidence, decision AS final_decision FROM inv)"""

_EXPL_QUERY = "text || ' ' || final_decision || ' fraud probability anomaly model confidence rule policy audit'"
_INV_QUERY = ("text || ' decision ' || decision || ' priority ' || priority || ' fraud probability anomaly risk policy "
              "audit investigation ' || array_to_string(focus, ' ')")

_CASE_CONTEXT = _lines(
    "'Case ID: ' || case_id", "'Transaction ID: ' || transaction_id", "'User ID: ' || user_id",
    "'Decision: ' || decision", "'Priority: ' || priority", "'Status: ' || status",
    "'Risk Score: ' || printf('%.3f', risk_score)", "'Fraud Probability: ' || printf('%.3f', fraud_probability)",
    "'Model Confidence: ' || printf('%.3f', model_confidence)", f"'Anomaly Flag: ' || {_tf('anomaly_flag')}",
    "'Evidence:'", "ev_lines", "'Recommended Action: ' || recommended_action",
    "'Analyst Note: No analyst note recorded.'")

_INV_TEXT = _lines(
    "'# LedgerLens Investigation Summary: ' || case_id", "''", "'## Overview'", "''",
    """CASE decision WHEN 'BLOCK' THEN 'This case should be treated as a blocked high-risk transaction investigation.'
  WHEN 'REVIEW' THEN 'This case should be treated as a review workflow requiring additional verification.'
  ELSE 'This case appears lower risk, but it has been retained for audit or monitoring review.' END""", "''",
    _code("Transaction ID", "transaction_id"), _code("User ID", "user_id"), _code("Decision", "decision"),
    _code("Priority", "priority"), _code("Status", "status"), _code("Risk Score", _f3("risk_score")),
    _code("Fraud Probability", _f3("fraud_probability")), _code("Model Confidence", _f3("case_confidence")),
    _code("Anomaly Flag", _tf("anomaly_flag")), _code("Evidence Items", "n_ev"),
    _code("Investigation Focus", "array_to_string(focus, ', ')"), "''",
    "'## Evidence-Grounded Explanation'", "''", "expl", "''", "'## Recommended Actions'", "''",
    "'- ' || replace(actions, ' | ', E'\\n- ')", "''", "'## Retrieved Policy Context Used'", "''",
    "coalesce(ictx, 'No retrieved policy context was available.')", "''", "'## Safety Boundary'", "''",
    "'This investigation summary is advisory. It does not override LedgerLens''s final decision.'")


# guarded, explained transactions: ``txs`` over ``tq(text, record)``
_TX_CTE = f"""tq AS (SELECT *, {_EXPLAIN_Q_SQL} AS text FROM rec),
{_guard_sql('tg', 'tq')},
{_evidence_sql('te', 'tg')}"""
_TX_TEXTS = f"SELECT DISTINCT {_EXPL_QUERY} AS q FROM te WHERE allowed"
_TX_OUT = f"""thits AS (SELECT te.*, h.sources, h.ctx FROM te LEFT JOIN hits h ON allowed AND {_EXPL_QUERY} = h.q),
txs AS (SELECT transaction_id, allowed, cats, coalesce(CASE WHEN allowed THEN sources END, '') AS sources,
  CASE WHEN allowed THEN {_expl_text_sql('ctx')} ELSE 'I cannot process this request because it attempts to bypass LedgerLens decision, policy, or safety boundaries. Safe alternative: ' || alt END AS explanation
  FROM thits)"""

# guarded investigations: ``ins`` over ``cq(text, case record)``
_CASE_Q_CTE = f"""cq AS (SELECT *, {_INVESTIGATE_Q_SQL} AS text FROM crec),
{_guard_sql('cg', 'cq')},
{_evidence_sql('ce2', 'cg')}"""
_CASE_TEXTS = (f"SELECT DISTINCT {_EXPL_QUERY} AS q FROM ce2 WHERE allowed UNION "
               f"SELECT DISTINCT {_INV_QUERY} FROM ce2 WHERE allowed")
_CASE_OUT = f"""chits AS (SELECT ce2.*, h.ctx AS ectx, i.ctx AS ictx, i.sources FROM ce2
  LEFT JOIN hits h ON allowed AND {_EXPL_QUERY} = h.q LEFT JOIN ihits i ON allowed AND {_INV_QUERY} = i.q),
cexp AS (SELECT *, {_expl_text_sql('ectx')} AS expl, {_NOTE_SQL} AS note FROM chits),
ins AS (SELECT case_id, transaction_id, user_id, decision, priority, status, allowed, cats,
  coalesce(CASE WHEN allowed THEN sources END, '') AS sources, CASE WHEN allowed THEN actions ELSE alt END AS actions,
  CASE WHEN allowed THEN note ELSE '' END AS note, CASE WHEN allowed THEN array_to_string(focus, ',') ELSE '' END AS focus,
  CASE WHEN allowed THEN {_INV_TEXT}
       ELSE 'This investigation request was blocked by LedgerLens guardrails. Reason: ' || reason || ' Safe alternative: ' || alt END AS summary
  FROM cexp)"""


def _search(texts: str, *hits: str) -> str:
    return f"qs AS (SELECT q, q AS text FROM ({texts})),\n{QT.CHUNK_CTE},\n{QT.topk_sql()},\n" + ",\n".join(hits)


_INS_CTE = ",\n".join([CASE_RECORD_CTE, _CASE_Q_CTE, _search(_CASE_TEXTS, QT.hits_sql("Relevance score"),
                                                               QT.hits_sql("Score", "ihits")), _CASE_OUT])

# ---------------------------------------------------------------- queries


@register("context", with_(QT.CHUNK_CTE, f""",
turns AS ({_TURNS}),
qs AS (SELECT request_id AS q, text FROM turns),
{QT.topk_sql()},
{QT.hits_sql('Relevance score')},
sec AS (SELECT q, rank, '[Source: ' || source || ' | Score: ' || printf('%.3f', score) || E']\\n' || text AS s FROM hits_t),
run AS (SELECT *, sum(length(s)) OVER (PARTITION BY q ORDER BY rank) AS len FROM sec),
cx AS (SELECT q, string_agg(s, E'\\n\\n---\\n\\n' ORDER BY rank) FILTER (WHERE len <= 2500) AS context FROM run GROUP BY q)
SELECT qs.q, coalesce(context, '') AS context, coalesce(sources, '') AS retrieved_sources
FROM qs LEFT JOIN cx ON qs.q = cx.q LEFT JOIN hits h ON qs.q = h.q"""))
def q_context(spark, sf):
    """Policy context and ordered sources for every user turn,
    retrieved from the chunked documents."""
    chunks = _chunks(spark, sf)
    turns = _user_turns(spark, sf)
    hits = A.hits_by_question(R.retrieve(turns, "q", "text", chunks, "chunk_id", k=QT.TOP_K), chunks)
    ctx = R.context_sections(hits.select("q", F.inline("hits")))
    src = hits.select("q", F.array_join(A.hit_sources(F.col("hits")), ",").alias("retrieved_sources"))
    return turns.select("q").join(ctx, "q", "left").join(src, "q", "left").na.fill(
        "", ["context", "retrieved_sources"])


_REQUESTS_SQL = f"""rq AS (SELECT concat(conv_id, ':', turn) AS request_id, text FROM conversations
  UNION ALL SELECT * FROM (VALUES {', '.join(f"('probe:{i}', '{t}')" for i, t in enumerate(QT.GUARD_PROBES))}) v(request_id, text))"""


@register("guardrail_refusals", f"""WITH {_REQUESTS_SQL},
{_guard_sql('g', 'rq')}
SELECT request_id, {_REFUSAL_SQL} AS refusal, reason, coalesce(alt, '') AS safe_alternative FROM g""")
def q_guardrail_refusals(spark, sf):
    """Refusal text, reason and safe alternative per conversation turn and probe."""
    g = GR.check_requests(QT._requests_union(spark, sf))
    return g.select("request_id",
                    GR.refusal_message(F.col("allowed"), F.col("reason"), F.col("safe_alternative")).alias("refusal"),
                    "reason", F.coalesce("safe_alternative", F.lit("")).alias("safe_alternative"))


_PROMPT_SQL = _lines(
    "'You are LedgerLens''s policy-grounded analyst assistant.'", "''", "'Operating rules:'",
    "'- You are advisory only.'", "'- You cannot approve, block, reverse, or override transaction decisions.'",
    "'- You cannot delete or alter audit evidence.'",
    "'- Use only retrieved policy context and provided case evidence.'",
    "'- If evidence is insufficient, say so clearly.'",
    "'- Distinguish recorded evidence from generated interpretation.'", "''", "'Retrieved policy context:'",
    "coalesce(context, 'No retrieved policy context was available.')", "''", "'Case context:'",
    "coalesce(case_context, 'No case-specific context was provided.')", "''", "'Analyst question:'",
    "regexp_replace(text, '^\\s+|\\s+$', '', 'g')", "''", "'Response requirements:'",
    "'- Give a concise, evidence-grounded answer.'", "'- Mention the relevant policy basis when available.'",
    "'- Do not invent missing facts.'",
    "'- End with a safe next-step recommendation when appropriate.'")


@register("guarded_prompts", with_(CASE_RECORD_CTE, f""",
{_REQUESTS_SQL},
pr AS (SELECT request_id, text, text AS query, CAST(NULL AS VARCHAR) AS case_context FROM rq
  UNION ALL SELECT case_id, text, {_INV_QUERY}, {_CASE_CONTEXT} FROM (SELECT *, {_INVESTIGATE_Q_SQL} AS text FROM inv)),
{_guard_sql('pg', 'pr')},
{_search('SELECT DISTINCT query AS q FROM pg WHERE allowed', QT.hits_sql('Relevance score'))},
sec AS (SELECT q, rank, '[Source: ' || source || ' | Score: ' || printf('%.3f', score) || E']\\n' || text AS s FROM hits_t),
run AS (SELECT *, sum(length(s)) OVER (PARTITION BY q ORDER BY rank) AS len FROM sec),
cx AS (SELECT q, string_agg(s, E'\\n\\n---\\n\\n' ORDER BY rank) FILTER (WHERE len <= 2500) AS context FROM run GROUP BY q),
pj AS (SELECT pg.*, cx.context FROM pg LEFT JOIN cx ON allowed AND pg.query = cx.q)
SELECT request_id, allowed, CASE WHEN allowed THEN {_PROMPT_SQL}
  ELSE 'The analyst request was blocked by LedgerLens guardrails.' || E'\\n\\nReason: ' || reason || E'\\nCategories: ' || replace(cats, ',', ', ') || E'\\nSafe alternative: ' || alt END AS prompt
FROM pj"""))
def q_guarded_prompts(spark, sf):
    """J12 for every conversation turn and probe (no case) and every case (with its context block)."""
    turns = QT._requests_union(spark, sf).select("request_id", "text", F.col("text").alias("query"),
                                                 F.lit(None).cast("string").alias("case_context"))
    inv = X.investigations(QC._cases(spark, sf)).withColumn("text", _investigate_question())
    cases = inv.select(F.col("case_id").alias("request_id"), "text", A.investigation_query(F.col("text")).alias("query"),
                       A.case_context_text().alias("case_context"))
    return A.guarded_prompts(turns.unionByName(cases), _chunks(spark, sf), QT.TOP_K)


@register("analyst_notes", with_(RECORD_CTE, f""",
{_evidence_sql('te', 'rec')}
SELECT transaction_id, {_NOTE_SQL} AS analyst_note FROM te"""))
def q_analyst_notes(spark, sf):
    """J17 per enriched request."""
    return A.analyst_notes(_enriched(spark, sf))


_TXS_CTE = ",\n".join([RECORD_CTE, _TX_CTE, _search(_TX_TEXTS, QT.hits_sql("Relevance score")), _TX_OUT])


@register("explanations", with_(_TXS_CTE, """
SELECT transaction_id, allowed, CASE WHEN allowed THEN 'transaction_explanation' ELSE 'guardrail_refusal' END AS response_type,
  explanation, sources AS retrieved_sources, cats AS guardrail_categories FROM txs"""))
def q_explanations(spark, sf):
    """Guarded explanation with policy context per enriched request."""
    e = A.transaction_explanations(_enriched(spark, sf), _explain_question(), _chunks(spark, sf), QT.TOP_K)
    return _joined(e.drop("evidence_points"), "retrieved_sources", "guardrail_categories")


def _investigated(spark, sf):
    return A.investigations(X.investigations(QC._cases(spark, sf)), _investigate_question(), _chunks(spark, sf),
                            QT.TOP_K)


@register("investigation_reports", with_(_INS_CTE, """
SELECT case_id, transaction_id, user_id, decision, priority, status, allowed,
  CASE WHEN allowed THEN 'investigation_summary' ELSE 'guardrail_refusal' END AS response_type, focus AS investigation_focus,
  summary, actions AS recommended_actions, note AS analyst_note, sources AS retrieved_sources, cats AS guardrail_categories FROM ins"""))
def q_investigation_reports(spark, sf):
    """Guarded investigations of every case, policy context retrieved once per
    distinct query text from the chunked documents."""
    r = _joined(_investigated(spark, sf).drop("explanation"), "investigation_focus", "retrieved_sources",
                "guardrail_categories")
    return r.withColumn("recommended_actions", F.array_join("recommended_actions", " | "))


_CASE_REPORT_SQL = _lines(
    "'# Fraud Investigation Case Report: ' || case_id", "''", "'## Case Summary'", "''",
    _code("Transaction ID", "transaction_id"), _code("User ID", "user_id"), _code("Final Decision", "decision"),
    _code("Priority", "priority"), _code("Status", "status"), _code("Risk Score", _f3("risk_score")),
    _code("Fraud Probability", _f3("fraud_probability")), _code("Model Confidence", _f3("model_confidence")),
    _code("Anomaly Flag", _tf("anomaly_flag")), _code("Created At", f"'{QC.AS_OF}'"),
    _code("Updated At", f"'{QC.AS_OF}'"), "''", "'## Evidence'", "''", "ev_report", "''",
    "'## Recommended Action'", "''", "recommended_action", "''", "'## Analyst Note'", "''",
    "'No analyst note recorded.'", "''")


@register("case_reports", with_(CASE_RECORD_CTE, f"\nSELECT case_id, {_CASE_REPORT_SQL} AS report_md FROM inv"))
def q_case_reports(spark, sf):
    """Markdown case reports as a table column."""
    return CS.case_reports(QC._cases(spark, sf))


@register("case_investigation_reports", with_(_INS_CTE, f"""
SELECT inv.case_id, allowed, sha256(report || E'\\n\\n---\\n\\n' || CASE WHEN allowed THEN summary ELSE
  '# LedgerLens Investigation Request Blocked: ' || inv.case_id || E'\\n\\n' || summary || E'\\n\\n## Guardrail Categories\\n\\n' || replace(cats, ',', ', ') END) AS report_sha256
FROM (SELECT case_id, {_CASE_REPORT_SQL} AS report FROM inv) inv JOIN ins ON inv.case_id = ins.case_id"""))
def q_case_investigation_reports(spark, sf):
    """Case report with its investigation, or with the blocked-request report (hashed)."""
    r = A.investigated_case_reports(QC._cases(spark, sf), _investigate_question(), _chunks(spark, sf), QT.TOP_K)
    return r.select("case_id", "allowed", F.sha2("report_md", 256).alias("report_sha256"))


_POLICY_ANSWER_SQL = _lines(
    "'## LedgerLens Policy-Grounded Answer'", "''", "'Question: ' || regexp_replace(text, '^\\s+|\\s+$', '', 'g')", "''",
    "'### Retrieved Context'", "''", "ctx", "''", "'### Answer'", "''",
    "'Based on the retrieved LedgerLens policy context, the answer should be interpreted within the platform''s advisory "
    "boundaries. The analyst assistant can explain risk policy, summarize evidence, and suggest review steps, but it "
    "cannot override ALLOW, REVIEW, or BLOCK decisions.'", "''", "'### Safe Next Step'", "''",
    "'Use the retrieved policy context to review the relevant transaction, preserve the audit trail, and document any "
    "analyst action taken.'")

# policy answers: ``pol`` over the user turns
_POL_CTE = f"""turns AS ({_TURNS}),
{_guard_sql('ug', 'turns')}"""
_POL_OUT = f"""pol AS (SELECT request_id, allowed, cats, coalesce(sources, '') AS sources,
  CASE WHEN allowed THEN 'POLICY_ANSWER' ELSE 'GUARDRAIL_REFUSAL' END AS response_type,
  CASE WHEN allowed THEN {_POLICY_ANSWER_SQL} ELSE {_REFUSAL_SQL} END AS answer,
  CASE WHEN allowed THEN 'Answer is grounded in retrieved LedgerLens policy context.' ELSE 'Blocked by guardrails before retrieval.' END AS confidence_note
  FROM ug LEFT JOIN hits h ON allowed AND ug.text = h.q)"""
_POLICY_CTE = ",\n".join([_POL_CTE, _search("SELECT DISTINCT text AS q FROM ug WHERE allowed",
                                            QT.hits_sql("Relevance score")), _POL_OUT])


def _policy(spark, sf):
    chunks = _chunks(spark, sf)
    guarded = GR.check_requests(_user_turns(spark, sf))
    ranked = R.retrieve(guarded.where("allowed"), "q", "text", chunks, "chunk_id", k=QT.TOP_K)
    return A.policy_answers(guarded, ranked, chunks)


@register("policy_answers", with_(_POLICY_CTE, """
SELECT request_id AS q, allowed, response_type, answer, sources AS retrieved_sources, cats AS guardrail_categories, confidence_note FROM pol"""))
def q_policy_answers(spark, sf):
    """Guardrail -> retrieval over chunked documents -> answer, per user turn."""
    return _joined(_policy(spark, sf), "retrieved_sources", "guardrail_categories")


@register("copilot_cards", with_(_POLICY_CTE, """
SELECT request_id AS q, 'LedgerLens Analyst Copilot' AS title, response_type, allowed, answer, confidence_note,
  CASE WHEN sources = '' THEN 'No retrieved sources.' ELSE '- ' || replace(sources, ',', E'\\n- ') END AS sources_text FROM pol"""))
def q_copilot_cards(spark, sf):
    """Dashboard cards for the policy answers."""
    return A.copilot_card(_policy(spark, sf)).drop("retrieved_sources", "guardrail_categories")


# all three kinds of request in one index search
_ALL_CTE = ",\n".join([
    CASE_RECORD_CTE, RECORD_CTE[len(QC.COST_CTE) + 1:].strip(), _TX_CTE, _CASE_Q_CTE, _POL_CTE,
    _search(f"{_TX_TEXTS} UNION {_CASE_TEXTS} UNION SELECT DISTINCT text FROM ug WHERE allowed",
            QT.hits_sql("Relevance score"), QT.hits_sql("Score", "ihits")), _TX_OUT, _CASE_OUT, _POL_OUT,
    """resp AS (SELECT request_id, allowed, response_type, answer, sources, cats, confidence_note FROM pol
  UNION ALL SELECT 'T:' || transaction_id, allowed, CASE WHEN allowed THEN 'TRANSACTION_EXPLANATION' ELSE 'GUARDRAIL_REFUSAL' END, explanation, sources, cats,
    CASE WHEN allowed THEN 'Explanation is grounded in transaction evidence and retrieved policy context.' ELSE 'Blocked by guardrails before transaction explanation.' END FROM txs
  UNION ALL SELECT 'C:' || case_id, allowed, CASE WHEN allowed THEN 'CASE_INVESTIGATION' ELSE 'GUARDRAIL_REFUSAL' END, summary, sources, cats,
    CASE WHEN allowed THEN 'Investigation is grounded in case evidence and retrieved policy context.' ELSE 'Blocked by guardrails before case investigation.' END FROM ins)"""])


def _copilot_requests(spark, sf):
    records, cases = _enriched(spark, sf), QC._cases(spark, sf)
    none = F.lit(None).cast("string")
    return (
        _user_turns(spark, sf).select(F.col("q").alias("request_id"), "text", none.alias("transaction_id"),
                                      none.alias("case_id"))
        .unionByName(records.select(F.concat(F.lit("T:"), "transaction_id").alias("request_id"),
                                    _explain_question().alias("text"), "transaction_id", none.alias("case_id")))
        .unionByName(cases.select(F.concat(F.lit("C:"), "case_id").alias("request_id"),
                                  _investigate_question().alias("text"), "transaction_id", "case_id")))


@register("copilot_responses", with_(_ALL_CTE, """
SELECT request_id, allowed, response_type, sha256(answer) AS answer_sha256, sources AS retrieved_sources,
  cats AS guardrail_categories, confidence_note FROM resp"""))
def q_copilot_responses(spark, sf):
    """User turns, transactions and cases through the one entry point (answers hashed)."""
    r = A.copilot_responses(_copilot_requests(spark, sf), _enriched(spark, sf), QC._cases(spark, sf),
                            _chunks(spark, sf), QT.TOP_K)
    r = _joined(r, "retrieved_sources", "guardrail_categories")
    return r.withColumn("answer_sha256", F.sha2("answer", 256)).drop("answer")


_GUARDED_COUNTS = f""",
{_TX_CTE.split('te AS (')[0].rstrip().rstrip(',')},
cq AS (SELECT *, {_INVESTIGATE_Q_SQL} AS text FROM cases),
{_guard_sql('cg', 'cq')},
{_POL_CTE}
SELECT response_type, count(*) AS n FROM (
  SELECT CASE WHEN allowed THEN 'POLICY_ANSWER' ELSE 'GUARDRAIL_REFUSAL' END AS response_type FROM ug
  UNION ALL SELECT CASE WHEN allowed THEN 'TRANSACTION_EXPLANATION' ELSE 'GUARDRAIL_REFUSAL' END FROM tg
  UNION ALL SELECT CASE WHEN allowed THEN 'CASE_INVESTIGATION' ELSE 'GUARDRAIL_REFUSAL' END FROM cg) GROUP BY response_type"""


@register("request_routing", with_(QC.CASE_CTE + RECORD_CTE[len(QC.COST_CTE):], _GUARDED_COUNTS))
def q_request_routing(spark, sf):
    """Responses by type; user turns, transactions and cases in one request table."""
    return A.route_requests(_copilot_requests(spark, sf)).groupBy("response_type").agg(F.count(F.lit(1)).alias("n"))


# every record makes a case here; one without any finding gets the default action
_ALL_INS_CTE = _INS_CTE.replace("WHERE decision IN ('REVIEW', 'BLOCK') OR anom OR adjusted_risk_score >= 0.35e0", "") \
    .replace("concat_ws(' | ',", "concat_ws(' | ', CASE WHEN len(focus) = 1 AND focus[1] IN ('standard_audit_review', 'elevated_model_risk', "
             "'review_level_adjusted_risk', 'rule_trigger_review', 'high_priority_case') AND decision = 'ALLOW' THEN "
             "'Preserve the audit trace and continue monitoring.' END,")


@register("create_and_investigate", with_(_ALL_INS_CTE, """
SELECT 'T:' || transaction_id AS request_id, allowed, CASE WHEN allowed THEN 'CASE_INVESTIGATION' ELSE 'GUARDRAIL_REFUSAL' END AS response_type,
  sha256(summary) AS answer_sha256, sources AS retrieved_sources, cats AS guardrail_categories,
  CASE WHEN allowed THEN 'Investigation is grounded in case evidence and retrieved policy context.' ELSE 'Blocked by guardrails before case investigation.' END AS confidence_note FROM ins"""))
def q_create_and_investigate(spark, sf):
    """A case for every transaction, flagged or not, investigated at once (answers hashed)."""
    req = _enriched(spark, sf).withColumns({"request_id": F.concat(F.lit("T:"), "transaction_id"),
                                            "text": _investigate_question()})
    r = A.create_and_investigate(req, _chunks(spark, sf), QT.TOP_K, as_of=QC.AS_OF)
    return _joined(r.withColumn("answer_sha256", F.sha2("answer", 256)).drop("answer"), "retrieved_sources",
                   "guardrail_categories")
