"""Registered streaming queries (L2-L4, L6-L9): each drains a file stream of a
driver table with an ``availableNow`` trigger into a table under the shared
checkpoint folder and returns that table, which equals the batch query's."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from ledgerlens.operators import cases as CS
from ledgerlens.operators import cost as CO
from ledgerlens.plans import q_cost_cases  # noqa: F401  (its twins are used here)
from ledgerlens.plans.q_drift import LI_NUMERIC, WIN_CUT, windowed_drift_sql
from ledgerlens.plans.registry import ORACLES, register
from ledgerlens.plans.sql_twins import RULES_CTE, with_
from ledgerlens.sources.fixtures import REQUEST_COLUMNS, TXN_COLUMNS, case_events_orders
from ledgerlens.sources.tables import read_table, table_path
from ledgerlens.streaming import keyed as K
from ledgerlens.streaming import scoring as S


def _stream(spark, sf, name):
    """A file stream of a table, be it one file or a folder of part files (a file must be
    named by a pattern: the source takes a plain path for a folder)."""
    path = table_path(sf, name)
    return spark.readStream.schema(read_table(spark, sf, name).schema).parquet(f"{path[:-1]}[{path[-1]}]")


def _drain(spark, stream, name, mode="append"):
    base = S.shared_dir(spark, name)
    sink, ckpt = os.path.join(base, "out"), os.path.join(base, "ckpt")
    S.run_available_now(stream, sink, ckpt, mode)
    return spark.read.schema(stream.schema).parquet(sink), ckpt


@register("stream_scoring", with_(RULES_CTE, f""", scored AS ({ORACLES['scored_requests']})
SELECT transaction_id, rule_risk_score, rule_action, reason_codes, decision, adjusted_risk_score FROM rules JOIN scored USING (transaction_id)"""))
def q_stream_scoring(spark, sf):
    """Rule engine + cost engine on one stream of orders-derived rows."""
    orders = _stream(spark, sf, "orders")
    decided = ["decision", "adjusted_risk_score"]
    costs = CO.cost_decisions(orders.select("*", *[F.expr(e).alias(n) for n, e in REQUEST_COLUMNS])).select(*orders.columns, *decided)
    scored = S.scoring_stream(costs.select(*decided, *[F.expr(e).alias(n) for n, e in TXN_COLUMNS]))
    return _drain(spark, scored.select("transaction_id", "rule_risk_score", "rule_action", "reason_codes", *decided), "stream_scoring")[0]


@register("stream_velocity", """SELECT w AS window_start, w + INTERVAL 2 MINUTE AS window_end, user_id, count(*) AS n
FROM (SELECT user_id, unnest([date_trunc('minute', ts), date_trunc('minute', ts) - INTERVAL 1 MINUTE]) AS w FROM events) GROUP BY ALL""")
def q_stream_velocity(spark, sf):
    """Watermarked sliding-window counts per user over the events stream: the windows
    that the watermark closed, and those still open when the stream was drained."""
    closed, ckpt = _drain(spark, S.velocity_stream(_stream(spark, sf, "events")), "stream_velocity")
    every = closed.unionByName(S.open_windows(spark, ckpt, "user_id"))
    return every.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


PURCH = "SELECT event_id, user_id AS account_id, ts AS timestamp, value AS amount FROM events WHERE event_type = 'purchase'"


def _events(spark, sf, kind, *columns):
    e = _stream(spark, sf, "events").where(F.col("event_type") == kind)
    named = {"event_id": F.col("event_id"), "account_id": F.col("user_id"), "timestamp": F.col("ts"), "amount": F.col("value")}
    return e.select(*[named[c].alias(c) for c in columns])


def _drain_to_end(spark, name, build, *streams, ts="timestamp"):
    """``build`` over the streams, each ended by a marker, drained whole."""
    base = S.shared_dir(spark, name)
    markers = [K.EndMarker(spark, os.path.join(base, f"end-{i}"), ts) for i in range(len(streams))]
    out = build(*[m.attach(s) for m, s in zip(markers, streams, strict=True)])
    sink = os.path.join(base, "out")
    K.drain_to_end(out, markers, sink, os.path.join(base, "ckpt"))
    return spark.read.schema(out.schema).parquet(sink)


@register("stream_failed_logins", """WITH u AS (
  SELECT event_id, user_id, ts, event_type FROM events WHERE event_type IN ('purchase', 'error')),
c AS (SELECT *, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts
  RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS f FROM u)
SELECT event_id, CAST(f AS INTEGER) AS failed_login_count_1h FROM c WHERE event_type = 'purchase'""")
def q_stream_failed_logins(spark, sf):
    """L2 + L6: purchases and failed logins as two streams, joined on account and time."""
    out = _drain_to_end(spark, "stream_logins", K.failed_login_stream,
                        _events(spark, sf, "purchase", "event_id", "account_id", "timestamp"),
                        _events(spark, sf, "error", "account_id", "timestamp"))
    return out.select("event_id", "failed_login_count_1h")


@register("stream_account_history", f"""WITH p AS ({PURCH})
SELECT event_id,
  round_even(coalesce(sum(amount) OVER (PARTITION BY account_id, CAST(timestamp AS DATE)
    ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0), 9) AS daily_total_before_txn,
  round_even(avg(amount) OVER (PARTITION BY account_id ORDER BY timestamp
    RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), 9) AS avg_amount_30d FROM p""")
def q_stream_account_history(spark, sf):
    """L3 + L4: point-in-time values from rings of hour totals in keyed state."""
    with K.rocksdb_state(spark):
        out = _drain_to_end(spark, "stream_history", K.account_history_stream,
                            _events(spark, sf, "purchase", "event_id", "account_id", "timestamp", "amount"))
    return out.select("event_id", *[F.bround(c, 9).alias(c) for c in ("daily_total_before_txn", "avg_amount_30d")])


@register("stream_windowed_drift", windowed_drift_sql(
    "CAST(epoch(time_bucket(INTERVAL 91 DAYS, l_shipdate, TIMESTAMP '1970-01-01')) AS BIGINT)", "BIGINT"))
def q_stream_windowed_drift(spark, sf):
    """PSI of each closed 13-week window of shipments against those before 1996."""
    cut = F.lit(WIN_CUT).cast("timestamp_ntz")
    ref = read_table(spark, sf, "lineitem").where(F.col("l_shipdate") < cut)
    cur = _stream(spark, sf, "lineitem").where(F.col("l_shipdate") >= cut).select("l_shipdate", *LI_NUMERIC)
    out = _drain_to_end(spark, "stream_drift", lambda s: K.drift_window_stream(ref, s, LI_NUMERIC, "l_shipdate", "91 days"), cur, ts="l_shipdate")
    return out.select(F.unix_seconds("window_start").alias("window"), "feature_name", "current_count",
                      F.bround("population_stability_index", 9).alias("population_stability_index"))


@register("stream_case_status", """WITH evs AS (
  SELECT concat('TXN_', CAST(o_orderkey AS STRING)) AS transaction_id, 'UNDER_REVIEW' AS status, o_orderdate + INTERVAL 1 DAY AS ts FROM orders
  UNION ALL
  SELECT concat('TXN_', CAST(o_orderkey AS STRING)),
         CASE o_orderstatus WHEN 'F' THEN 'RESOLVED_FRAUD' WHEN 'O' THEN 'ESCALATED' ELSE 'RESOLVED_GENUINE' END,
         o_orderdate + to_days(CAST(2 + o_orderkey % 3 AS INTEGER)) FROM orders)
SELECT 'CASE-' || upper(substr(sha256(transaction_id), 1, 10)) AS case_id, arg_max(status, (ts, status)) AS status,
  strftime(max(ts), '%Y-%m-%dT%H:%M:%S+00:00') AS updated_at FROM evs GROUP BY 1""")
def q_stream_case_status(spark, sf):
    """Latest status per case from a stream of status events; state keyed by case, from
    which closed cases expire."""
    events = case_events_orders(_stream(spark, sf, "orders")).select(
        CS.case_id_column(F.col("transaction_id")).alias("case_id"), "status", F.col("ts").alias("updated_at"))
    base = S.shared_dir(spark, "stream_case_status")
    out = K.run_changes_table(K.case_status_stream(events), os.path.join(base, "out"), os.path.join(base, "ckpt"), "case_id", ("updated_at", "status"))
    return out.withColumn("updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss'+00:00'"))
