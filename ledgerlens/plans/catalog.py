"""All registered queries (importing the group modules fills the registry)."""

from __future__ import annotations

from ledgerlens.plans import q_answers, q_cost_cases, q_decisions, q_drift, q_features, q_metrics, q_models, q_reports, q_streaming, q_text  # noqa: F401
from ledgerlens.plans.registry import ORACLES, QUERIES


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLES)
