"""Texts of the analyst assistant over tables: transaction explanations and notes,
case investigations, policy answers, guarded prompts and request routing (SURVEY §2.J,
J12, J15-J18, J21, J23, J25-J27, J29).

Policy context is looked up once per *distinct* query text and joined back: the texts of
explanations and investigations depend on the question, the decision, the priority and
the focus tags only, so retrieval does not grow with the records or cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import fmt3, py_strip
from ledgerlens.operators import cases as CS
from ledgerlens.operators import explain as X
from ledgerlens.operators import guardrails as GR
from ledgerlens.operators import retrieval as R
from ledgerlens.session import shared_table

# Explanation texts by decision (decision sentence, next step).
DECISION_SENTENCES = {
    "BLOCK": "LedgerLens blocked this transaction because the combined evidence indicates high operational fraud risk.",
    "REVIEW": "LedgerLens routed this transaction to review because the evidence indicates elevated or uncertain risk.",
    "ALLOW": ("LedgerLens allowed this transaction because the available evidence does not cross review or block "
              "thresholds."),
}
OTHER_SENTENCE = "LedgerLens produced a decision that should be reviewed against the risk policy."
NEXT_STEPS = {
    "BLOCK": ("Recommended next step: keep the transaction blocked, preserve the audit trail, verify user identity, "
              "and route the case to fraud review."),
    "REVIEW": ("Recommended next step: request step-up authentication or analyst review before allowing the "
               "transaction."),
    "ALLOW": "Recommended next step: retain the normal audit trace and continue monitoring.",
}
OTHER_NEXT_STEP = "Recommended next step: inspect the audit evidence and verify policy alignment."
EXPLANATION_NOTE = "Note: This explanation is advisory. It does not override the final LedgerLens decision."
NO_RULES_TEXT = "No deterministic rule flags were triggered."
NO_POLICY_TEXT = "No retrieved policy context was available."
EXPLANATION_REFUSAL = ("I cannot process this request because it attempts to bypass LedgerLens decision, policy, or "
                       "safety boundaries. Safe alternative: ")

# Analyst-note actions by decision.
NOTE_ACTIONS = {
    "BLOCK": "Keep blocked and escalate for fraud review.",
    "REVIEW": "Route for step-up authentication or analyst review.",
}
NOTE_OTHER_ACTION = "Allow with standard audit monitoring."

# Investigation texts.
OPENINGS = {
    "BLOCK": "This case should be treated as a blocked high-risk transaction investigation.",
    "REVIEW": "This case should be treated as a review workflow requiring additional verification.",
}
OTHER_OPENING = "This case appears lower risk, but it has been retained for audit or monitoring review."
SAFETY_BOUNDARY = "This investigation summary is advisory. It does not override LedgerLens's final decision."
INVESTIGATION_REFUSAL = "This investigation request was blocked by LedgerLens guardrails. Reason: "

# Policy-answer template sentences.
ANSWER_TEXT = (
    "Based on the retrieved LedgerLens policy context, the answer should be interpreted "
    "within the platform's advisory boundaries. The analyst assistant can explain "
    "risk policy, summarize evidence, and suggest review steps, but it cannot override "
    "ALLOW, REVIEW, or BLOCK decisions.")
NEXT_STEP_TEXT = ("Use the retrieved policy context to review the relevant transaction, preserve the "
                  "audit trail, and document any analyst action taken.")
NO_CONTEXT_TEXT = (
    "I do not have enough retrieved LedgerLens policy context to answer that confidently. "
    "Ask a question related to risk policy, fraud investigation, audit requirements, "
    "model monitoring, calibration, or case handling.")

# Confidence notes by response type.
POLICY_NOTE = "Answer is grounded in retrieved LedgerLens policy context."
NO_CONTEXT_NOTE = "No relevant policy context retrieved."
POLICY_BLOCKED_NOTE = "Blocked by guardrails before retrieval."
EXPLANATION_CONFIDENCE = "Explanation is grounded in transaction evidence and retrieved policy context."
EXPLANATION_BLOCKED_NOTE = "Blocked by guardrails before transaction explanation."
INVESTIGATION_CONFIDENCE = "Investigation is grounded in case evidence and retrieved policy context."
INVESTIGATION_BLOCKED_NOTE = "Blocked by guardrails before case investigation."

SEPARATOR = "\n\n---\n\n"
# Up to so many looked-up texts are sent to every executor.
BROADCAST_TEXTS = 2000


def _empty() -> Column:
    return F.array().cast("array<string>")


def _by_decision(decision: Column, texts: dict[str, str], other: str) -> Column:
    out = None
    for k, v in texts.items():
        out = F.when(decision == k, F.lit(v)) if out is None else out.when(decision == k, F.lit(v))
    return out.otherwise(F.lit(other))


def _bullets(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def _code_line(label: str, value: Column) -> Column:
    return F.concat(F.lit(f"- {label}: `"), value, F.lit("`"))


def _true_false(flag: Column) -> Column:
    return F.when(flag, "True").otherwise("False")


# ---------------------------------------------------------------- policy context

def text_hits(texts: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """J7/J18 for a one-column frame of query texts (repeats and nulls allowed): one row
    per distinct text ``q`` with ``hits``, its top-k chunks in rank order as
    array<struct<rank, source, score, text>>. Blank texts have no row.

    The distinct texts are written to the shared checkpoint folder: it cuts the lineage of
    the records, which the retrieval reads several times."""
    asked = texts.toDF("q").where(F.col("q").isNotNull()).distinct()
    # a text is a long key: it stands once, in this table, and its number goes through the scoring
    queries = shared_table(asked.withColumn("n", F.monotonically_increasing_id()), "retrieval-queries")
    found = hits_by_question(R.retrieve(queries, "n", "q", chunks, "chunk_id", k=k), chunks).withColumnRenamed("q", "n")
    return shared_table(queries.join(found, "n").select("q", "hits"), "retrieval-hits")


def sent_if_few(hits: DataFrame) -> DataFrame:
    """Few distinct texts (a table counted here, k chunks a row) go to every executor: the
    records with their long texts stay where they are."""
    return F.broadcast(hits) if hits.count() <= BROADCAST_TEXTS else hits


def hits_by_text(texts: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """The look-up table of :func:`text_hits`, broadcast if it is small."""
    return sent_if_few(text_hits(texts, chunks, k))


def hits_by_question(ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Ranked (q, unit, rank, score) rows with their chunks, gathered by question (k rows each)."""
    c = chunks.select(F.col("chunk_id").alias("unit"), F.col("source").cast("string").alias("source"), "text")
    return ranked.join(c, "unit").groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("rank", "source", "score", "text"))).alias("hits"))


def hit_sections(hits: Column, score_label: str) -> Column:
    """'Source / <label> / text' sections in rank order ('' without hits)."""
    return F.coalesce(F.array_join(F.transform(hits, lambda h: F.concat(
        F.lit("Source: "), h["source"], F.lit(f"\n{score_label}: "), fmt3(h["score"]), F.lit("\n"),
        py_strip(h["text"]))), SEPARATOR), F.lit(""))


def hit_sources(hits: Column) -> Column:
    """Distinct sources in rank order."""
    return F.coalesce(F.array_distinct(hits.getField("source")), _empty())


def text_contexts(hits: DataFrame, on: str, prefix: str, score_label: str) -> DataFrame:
    """The look-up table of records: a text's context block and sources, made once per text
    rather than for every record that asks it."""
    return hits.select(F.col("q").alias(on), hit_sections(F.col("hits"), score_label).alias(f"{prefix}_context"),
                       hit_sources(F.col("hits")).alias(f"{prefix}_sources"))


def no_context(prefix: str) -> dict[str, Column]:
    return {f"{prefix}_context": F.lit(None).cast("string"), f"{prefix}_sources": F.lit(None).cast("array<string>")}


# ---------------------------------------------------------------- explanations

def explanation_query(question: Column, decision: Column) -> Column:
    """The retrieval query of a transaction explanation."""
    return F.concat(question, F.lit(" "), decision,
                    F.lit(" fraud probability anomaly model confidence rule policy audit"))


def explanation_text(question: Column, context: Column) -> Column:
    """J15 over the columns of ``evidence_summary``: decision summary, explanation,
    evidence, policy context, next step and the advisory note."""
    c = F.col
    rules = F.when(F.size("triggered_rules") > 0, F.array_join("triggered_rules", ", ")).otherwise(NO_RULES_TEXT)
    return F.concat_ws(
        "\n",
        F.lit("## LedgerLens Analyst Explanation"), F.lit(""),
        F.concat(F.lit("Analyst question: "), question), F.lit(""),
        F.lit("### Decision Summary"), F.lit(""),
        _code_line("Transaction ID", c("transaction_id")), _code_line("User ID", c("user_id")),
        _code_line("Final Decision", c("final_decision")),
        _code_line("Fraud Probability", fmt3(c("fraud_probability"))),
        _code_line("Adjusted Risk Score", fmt3(c("risk_score"))),
        _code_line("Model Confidence", fmt3(c("model_confidence"))),
        _code_line("Anomaly Flag", _true_false(c("anomaly_flag"))),
        F.concat(F.lit("- Triggered Rules: "), rules), F.lit(""),
        F.lit("### Explanation"), F.lit(""), _by_decision(c("final_decision"), DECISION_SENTENCES, OTHER_SENTENCE),
        F.lit(""), F.lit("### Evidence"), F.lit(""), _bullets(c("evidence_points")), F.lit(""),
        F.lit("### Retrieved Policy Context"), F.lit(""),
        F.when(context != "", context).otherwise(NO_POLICY_TEXT), F.lit(""),
        F.lit("### Safe Next Step"), F.lit(""), _by_decision(c("final_decision"), NEXT_STEPS, OTHER_NEXT_STEP),
        F.lit(""), F.lit(EXPLANATION_NOTE))


def analyst_note() -> Column:
    """J17 over the columns of ``evidence_summary``: ids, decision, the three scores, the
    first four evidence points and the action of the decision."""
    c = F.col
    return F.concat(
        F.lit("Transaction "), c("transaction_id"), F.lit(" for user "), c("user_id"),
        F.lit(" received a final decision of "), c("final_decision"),
        F.lit(". Fraud probability="), fmt3(c("fraud_probability")),
        F.lit(", adjusted risk="), fmt3(c("risk_score")),
        F.lit(", model confidence="), fmt3(c("model_confidence")),
        F.lit(". Evidence: "), F.array_join(F.slice("evidence_points", 1, 4), " "),
        F.lit(" Recommended action: "), _by_decision(c("final_decision"), NOTE_ACTIONS, NOTE_OTHER_ACTION))


def analyst_notes(records: DataFrame) -> DataFrame:
    """J17 for every record (any record shape ``evidence_summary`` reads)."""
    return X.evidence_summary(records).select("transaction_id", analyst_note().alias("analyst_note"))


def _asked_records(records: DataFrame, question: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Evidence, guardrail (``_g_``) and the text to look up (``_qtext``, null if blocked) per record."""
    c = F.col
    asked = records.withColumn("_question", F.coalesce(question.cast("string"), F.lit("None")))
    ev = GR.with_guardrails(X.evidence_summary(asked, keep=(*keep, "_question")), c("_question"), "_g_")
    return ev.withColumn("_qtext", F.when(c("_g_allowed"), explanation_query(c("_question"), c("final_decision"))))


def transaction_explanations(records: DataFrame, question: Column, chunks: DataFrame | None = None, k: int = 3,
                             keep: tuple[str, ...] = (), hits: DataFrame | None = None) -> DataFrame:
    """Guardrail, evidence, policy context and explanation per record.

    ``question`` is a literal or an expression over ``records`` (null asks "None", as its
    text); ``keep`` names record columns to carry; ``hits`` is a look-up table that already
    holds the texts. Without it and ``chunks`` nothing is looked up.
    A blocked question gives the refusal, no evidence and no sources."""
    c = F.col
    ev = _asked_records(records, question, keep)
    if hits is None and chunks is not None:
        hits = hits_by_text(ev.select("_qtext"), chunks, k)
    if hits is None:
        j = ev.withColumns(no_context(""))
    else:
        j = ev.join(text_contexts(hits, "_qtext", "", "Relevance score"), "_qtext", "left")
    ok = c("_g_allowed")
    return j.select(
        *keep, "transaction_id", ok.alias("allowed"),
        F.when(ok, "transaction_explanation").otherwise("guardrail_refusal").alias("response_type"),
        F.when(ok, explanation_text(c("_question"), F.coalesce(c("_context"), F.lit(""))))
        .otherwise(F.concat(F.lit(EXPLANATION_REFUSAL), c("_g_safe_alternative"))).alias("explanation"),
        F.when(ok, F.coalesce(c("_sources"), _empty())).otherwise(_empty()).alias("retrieved_sources"),
        F.when(ok, c("evidence_points")).alias("evidence_points"),
        c("_g_categories").alias("guardrail_categories"))


# ---------------------------------------------------------------- investigations

def case_context_text() -> Column:
    """The case context block (evidence lines, action, note)."""
    c = F.col
    ev = F.when(F.size("evidence") > 0, F.array_join(F.transform("evidence", lambda e: F.concat(
        F.lit("- ["), e["evidence_type"], F.lit("] "), e["description"], F.lit(" (severity="),
        e["severity"].cast("string"), F.lit("/100, source="), e["source"], F.lit(")"))), "\n")) \
        .otherwise(F.lit("- No additional evidence items recorded."))
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Case ID: "), c("case_id")), F.concat(F.lit("Transaction ID: "), c("transaction_id")),
        F.concat(F.lit("User ID: "), c("user_id")), F.concat(F.lit("Decision: "), c("decision")),
        F.concat(F.lit("Priority: "), c("priority")), F.concat(F.lit("Status: "), c("status")),
        F.concat(F.lit("Risk Score: "), fmt3(c("risk_score"))),
        F.concat(F.lit("Fraud Probability: "), fmt3(c("fraud_probability"))),
        F.concat(F.lit("Model Confidence: "), fmt3(c("model_confidence"))),
        F.concat(F.lit("Anomaly Flag: "), _true_false(c("anomaly_flag"))),
        F.lit("Evidence:"), ev,
        F.concat(F.lit("Recommended Action: "), c("recommended_action")),
        F.concat(F.lit("Analyst Note: "), F.coalesce(F.nullif(c("analyst_note"), F.lit("")),
                                                     F.lit("No analyst note recorded."))))


def investigation_query(question: Column) -> Column:
    """Retrieval query of a case, with its focus tags."""
    return F.concat(question, F.lit(" decision "), F.col("decision"), F.lit(" priority "), F.col("priority"),
                    F.lit(" fraud probability anomaly risk policy audit investigation "),
                    F.array_join(F.col("investigation_focus"), " "))


def flat_case_records(cases: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """J20 with the rule flags as columns. A source named like a score replaces the score
    by true, so a case with a ``model_confidence`` item has confidence 1."""
    sources = F.col("evidence.source")
    c = F.col
    return cases.select(
        *keep, "transaction_id", "user_id", c("decision").alias("final_decision"), "risk_score", "fraud_probability",
        F.when(F.array_contains(sources, "model_confidence"), F.lit(1.0)).otherwise(c("model_confidence"))
        .alias("model_confidence"), "anomaly_flag",
        *[F.array_contains(sources, n).alias(n) for n in X.RULE_DESCRIPTIONS])


def investigation_text(explanation: Column, context: Column) -> Column:
    """The investigation summary of one case."""
    c = F.col
    return F.concat_ws(
        "\n",
        F.concat(F.lit("# LedgerLens Investigation Summary: "), c("case_id")), F.lit(""),
        F.lit("## Overview"), F.lit(""), _by_decision(c("decision"), OPENINGS, OTHER_OPENING), F.lit(""),
        _code_line("Transaction ID", c("transaction_id")), _code_line("User ID", c("user_id")),
        _code_line("Decision", c("decision")), _code_line("Priority", c("priority")),
        _code_line("Status", c("status")), _code_line("Risk Score", fmt3(c("risk_score"))),
        _code_line("Fraud Probability", fmt3(c("fraud_probability"))),
        _code_line("Model Confidence", fmt3(c("model_confidence"))),
        _code_line("Anomaly Flag", _true_false(c("anomaly_flag"))),
        _code_line("Evidence Items", F.size("evidence").cast("string")),
        _code_line("Investigation Focus", F.array_join("investigation_focus", ", ")), F.lit(""),
        F.lit("## Evidence-Grounded Explanation"), F.lit(""), explanation, F.lit(""),
        F.lit("## Recommended Actions"), F.lit(""), _bullets(c("recommended_actions")), F.lit(""),
        F.lit("## Retrieved Policy Context Used"), F.lit(""),
        F.when(F.rlike(context, F.lit(r"(?U)\S")), context).otherwise(NO_POLICY_TEXT), F.lit(""),
        F.lit("## Safety Boundary"), F.lit(""), F.lit(SAFETY_BOUNDARY))


def _asked_cases(inv: DataFrame, question: Column) -> DataFrame:
    """Cases with their guardrail (``_g_``) and the two texts to look up (null if blocked)."""
    c = F.col
    asked = inv.withColumn("_question", F.coalesce(question.cast("string"), F.lit("None")))
    return GR.with_guardrails(asked, c("_question"), "_g_").withColumns({
        "_itext": F.when(c("_g_allowed"), investigation_query(c("_question"))),
        "_etext": F.when(c("_g_allowed"), explanation_query(c("_question"), c("decision")))})


def _case_texts(asked: DataFrame) -> DataFrame:
    return asked.select(F.explode_outer(F.array("_itext", "_etext")).alias("q"))


def investigations(inv: DataFrame, question: Column, chunks: DataFrame | None = None, k: int = 3,
                   keep: tuple[str, ...] = (), hits: DataFrame | None = None) -> DataFrame:
    """One investigation per row of ``explain.investigations``, with the
    explanation embedded. A blocked question keeps the case's ids and gives the refusal.
    ``hits`` is a look-up table that already holds the texts."""
    c = F.col
    asked = _asked_cases(inv, question)
    own = [f for f in asked.columns if f not in keep]
    row = asked.select(*keep, F.struct(*own).alias("_case"), *own)
    rec = X.evidence_summary(flat_case_records(row, keep=(*keep, "_case")), keep=(*keep, "_case"))
    if hits is None and chunks is not None:
        hits = hits_by_text(_case_texts(asked), chunks, k)  # one look-up for both kinds of text
    if hits is None:
        j = rec.withColumns(no_context("_i") | no_context("_e"))
    else:
        j = (rec.withColumns({"_itext": c("_case._itext"), "_etext": c("_case._etext")})
             .join(text_contexts(hits, "_itext", "_i", "Score"), "_itext", "left")
             .join(text_contexts(hits, "_etext", "_e", "Relevance score"), "_etext", "left"))
    # the evidence columns first, as the case's own confidence and risk carry the same names
    j = j.select(*keep, "_case", "_i_context", "_i_sources", analyst_note().alias("_note"),
                 explanation_text(c("_case._question"), F.coalesce(c("_e_context"), F.lit(""))).alias("_expl"))
    j = j.select(*keep, "_case.*", "_i_context", "_i_sources", "_note", "_expl")
    ok = c("_g_allowed")
    refusal = F.concat(F.lit(INVESTIGATION_REFUSAL), c("_g_reason"), F.lit(" Safe alternative: "),
                       c("_g_safe_alternative"))
    return j.select(
        *keep, "case_id", "transaction_id", "user_id", "decision", "priority", "status", ok.alias("allowed"),
        F.when(ok, "investigation_summary").otherwise("guardrail_refusal").alias("response_type"),
        F.when(ok, c("investigation_focus")).otherwise(_empty()).alias("investigation_focus"),
        F.when(ok, investigation_text(c("_expl"), F.coalesce(c("_i_context"), F.lit("")))).otherwise(refusal)
        .alias("summary"),
        F.when(ok, c("recommended_actions")).otherwise(F.array(c("_g_safe_alternative"))).alias("recommended_actions"),
        F.when(ok, c("_note")).otherwise("").alias("analyst_note"),
        F.when(ok, F.coalesce(c("_i_sources"), _empty())).otherwise(_empty()).alias("retrieved_sources"),
        c("_g_categories").alias("guardrail_categories"),
        F.when(ok, c("_expl")).alias("explanation"))


def investigation_report() -> Column:
    """The report of an investigation (the summary, or the blocked-request report)."""
    c = F.col
    blocked = F.concat_ws(
        "\n", F.concat(F.lit("# LedgerLens Investigation Request Blocked: "), c("case_id")), F.lit(""), c("summary"),
        F.lit(""), F.lit("## Guardrail Categories"), F.lit(""),
        F.when(F.size("guardrail_categories") > 0, F.array_join("guardrail_categories", ", ")).otherwise("None"))
    return F.when(c("allowed"), c("summary")).otherwise(blocked)


def case_reports_with_investigation(cases: DataFrame, investigated: DataFrame) -> DataFrame:
    """Case report, rule, investigation report, per case."""
    return _with_investigation(CS.case_reports(cases).join(investigated.drop("report_md"), "case_id"))


def _with_investigation(j: DataFrame) -> DataFrame:
    return j.select("case_id", "allowed", F.concat_ws("\n", "report_md", F.lit(""), F.lit("---"), F.lit(""), investigation_report())
                    .alias("report_md"))


def investigated_case_reports(cases: DataFrame, question: Column, chunks: DataFrame, k: int = 3) -> DataFrame:
    """J25 of cases that are investigated here: the case report is carried along its row, so
    the two texts of a case need no join."""
    inv = X.investigations(cases).withColumn("report_md", CS.case_report_column())
    return _with_investigation(investigations(inv, question, chunks, k, keep=("report_md",)))


# ---------------------------------------------------------------- policy answers and prompts

def policy_answers(guarded: DataFrame, ranked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per question (q, text, allowed, reason, safe_alternative, categories): the
    guardrail refusal, the policy answer over its top-k chunks, or the insufficient-context
    answer when nothing was retrieved (an empty corpus)."""
    return _policy_texts(guarded.join(hits_by_question(ranked, chunks), "q", "left"))


def _policy_texts(j: DataFrame) -> DataFrame:
    """J26 over guarded questions with their ``hits``."""
    has = F.coalesce(F.size("hits"), F.lit(0)) > 0
    ok = F.col("allowed")
    answer = F.concat_ws("\n", F.lit("## LedgerLens Policy-Grounded Answer"), F.lit(""),
                         F.concat(F.lit("Question: "), py_strip(F.col("text"))), F.lit(""),
                         F.lit("### Retrieved Context"), F.lit(""), hit_sections(F.col("hits"), "Relevance score"),
                         F.lit(""), F.lit("### Answer"), F.lit(""), F.lit(ANSWER_TEXT), F.lit(""),
                         F.lit("### Safe Next Step"), F.lit(""), F.lit(NEXT_STEP_TEXT))
    return j.select(
        "q", "allowed",
        F.when(~ok, "GUARDRAIL_REFUSAL").when(~has, "INSUFFICIENT_CONTEXT").otherwise("POLICY_ANSWER")
        .alias("response_type"),
        F.when(~ok, GR.refusal_message(ok, F.col("reason"), F.col("safe_alternative")))
        .when(~has, F.lit(NO_CONTEXT_TEXT)).otherwise(answer).alias("answer"),
        F.when(ok, hit_sources(F.col("hits"))).otherwise(_empty()).alias("retrieved_sources"),
        F.when(~ok, F.col("categories")).otherwise(_empty()).alias("guardrail_categories"),
        F.when(~ok, POLICY_BLOCKED_NOTE).when(~has, NO_CONTEXT_NOTE).otherwise(POLICY_NOTE).alias("confidence_note"))


def guarded_prompts(requests: DataFrame, chunks: DataFrame, k: int = 3) -> DataFrame:
    """J12 over (request_id, text, query, case_context): the prompt with the context block
    retrieved for ``query`` (J8) and the case context, or the blocked-request notice."""
    g = GR.check_requests(requests)
    hits = hits_by_text(g.where("allowed").select("query"), chunks, k)
    ranked = hits.select("q", F.inline_outer("hits")).where(F.col("rank").isNotNull())
    ctx = R.context_sections(ranked)
    j = g.join(ctx.withColumnRenamed("q", "query"), "query", "left")
    return j.select("request_id", "allowed", GR.guarded_prompt(
        F.col("text"), F.col("allowed"), F.col("reason"), F.col("categories"), F.col("safe_alternative"),
        F.col("context"), F.col("case_context")).alias("prompt"))


# ---------------------------------------------------------------- routing

RESPONSE_COLUMNS = ["request_id", "allowed", "response_type", "answer", "retrieved_sources", "guardrail_categories",
                    "confidence_note"]


def explanation_responses(explained: DataFrame) -> DataFrame:
    ok = F.col("allowed")
    return explained.select(
        "request_id", "allowed", F.when(ok, "TRANSACTION_EXPLANATION").otherwise("GUARDRAIL_REFUSAL")
        .alias("response_type"), F.col("explanation").alias("answer"), "retrieved_sources", "guardrail_categories",
        F.when(ok, EXPLANATION_CONFIDENCE).otherwise(EXPLANATION_BLOCKED_NOTE).alias("confidence_note"))


def investigation_responses(investigated: DataFrame) -> DataFrame:
    ok = F.col("allowed")
    return investigated.select(
        "request_id", "allowed", F.when(ok, "CASE_INVESTIGATION").otherwise("GUARDRAIL_REFUSAL")
        .alias("response_type"), F.col("summary").alias("answer"), "retrieved_sources", "guardrail_categories",
        F.when(ok, INVESTIGATION_CONFIDENCE).otherwise(INVESTIGATION_BLOCKED_NOTE).alias("confidence_note"))


def route_requests(requests: DataFrame) -> DataFrame:
    """J27, the decision alone, over (text, transaction_id, case_id): the guardrail columns,
    ``route`` (case before transaction before policy question) and the response type, which
    is the refusal where the guardrail blocks the text."""
    route = (F.when(F.col("case_id").isNotNull(), "CASE_INVESTIGATION")
             .when(F.col("transaction_id").isNotNull(), "TRANSACTION_EXPLANATION").otherwise("POLICY_ANSWER"))
    return GR.check_requests(requests).withColumn("route", route).withColumn(
        "response_type", F.when(F.col("allowed"), F.col("route")).otherwise("GUARDRAIL_REFUSAL"))


def copilot_responses(requests: DataFrame, records: DataFrame, cases: DataFrame, chunks: DataFrame,
                      k: int = 3) -> DataFrame:
    """One response per request (request_id, text, transaction_id, case_id): a request
    with a case is an investigation, else one with a transaction an explanation, else a
    policy question; the guardrail comes first in each. Unknown ids give no response."""
    c = F.col
    routed = route_requests(requests)
    by_case = routed.where(c("route") == "CASE_INVESTIGATION").select("request_id", "text", "case_id")
    by_txn = routed.where(c("route") == "TRANSACTION_EXPLANATION").select("request_id", "text", "transaction_id")
    policy = routed.where(c("route") == "POLICY_ANSWER").withColumnRenamed("request_id", "q")
    made, asked = X.investigations(cases).join(by_case, "case_id"), records.join(by_txn, "transaction_id")
    # one index and one search for the texts of all three
    of_records = _case_texts(_asked_cases(made, c("text"))).unionByName(_asked_records(asked, c("text")).select(c("_qtext").alias("q")))
    texts = shared_table(of_records.distinct().withColumn("_record", F.lit(True)).unionByName(
        policy.where("allowed").select(c("text").alias("q"), F.lit(False).alias("_record"))), "request-texts")
    hits = text_hits(texts.select("q"), chunks, k)
    few = sent_if_few(shared_table(hits.join(texts.where("_record"), "q", "left_semi"), "record-hits"))
    inv = investigations(made, c("text"), keep=("request_id",), hits=few)
    expl = transaction_explanations(asked, c("text"), keep=("request_id",), hits=few)
    ans = _policy_texts(policy.join(hits.withColumnRenamed("q", "text"), "text", "left")).withColumnRenamed("q", "request_id")
    return (investigation_responses(inv).unionByName(explanation_responses(expl))
            .unionByName(ans.select(*RESPONSE_COLUMNS)))


def create_and_investigate(requests: DataFrame, chunks: DataFrame, k: int = 3, as_of: str | None = None) -> DataFrame:
    """A case is made of every transaction record (request_id, text and the record's
    columns), flagged or not, and investigated."""
    made = X.investigations(CS.create_cases(requests, as_of, keep=("request_id", "text")))
    return investigation_responses(investigations(made, F.col("text"), chunks, k, keep=("request_id",)))


def copilot_card(responses: DataFrame, title: str = "LedgerLens Analyst Copilot") -> DataFrame:
    """Dashboard card fields and the sources display text."""
    src = F.when(F.size("retrieved_sources") == 0, F.lit("No retrieved sources.")).otherwise(
        _bullets(F.col("retrieved_sources")))
    return responses.select("q", F.lit(title).alias("title"), "response_type", "allowed", "answer",
                            "confidence_note", "retrieved_sources", "guardrail_categories",
                            src.alias("sources_text"))
