"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line. Each query is executed in full with the ``noop``
sink (no driver collection); the first query is run once untimed to warm
the JVM."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlens.plans import catalog  # noqa: E402
from ledgerlens.session import get_spark  # noqa: E402

HEADLINE = [
    "final_action_matrix",      # rules -> benchmark join -> final decision
    "audit_summary_counts",     # audit documents -> one-scan summary
    "kpis",                     # dashboard KPI row (audit lookup join)
    "high_risk_top100",         # top-k review list
    "cost_decision_counts",     # cost-sensitive decisions
    "cases",                    # case creation over enriched requests
    "numeric_drift",            # two-pass PSI
    "categorical_drift",        # TVD
    "model_leaderboard",        # exact ROC/AP + confusion metrics
    "tfidf_topk",               # chunk-free TF-IDF retrieval
    "chunks",                   # chunking fold
    "velocity_window",          # point-in-time window features
    "failed_logins_window",
    "isolation_forest",         # custom model: fit + score
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = get_spark()
    qs = catalog.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    qs[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(os.environ.get("BENCH_CPUS", "8"))}))
    spark.stop()


if __name__ == "__main__":
    main()
