"""Registered point-in-time feature and event-window queries (L) over the
``events`` table: purchases are transactions, errors are failed logins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import features as L
from ledgerlens.plans.registry import register
from ledgerlens.sources.tables import read_table

R9 = 9


def _events(spark, sf):
    return read_table(spark, sf, "events").select("event_id", F.col("user_id").alias("account_id"),
                                                  F.col("ts").alias("timestamp"), "event_type",
                                                  F.col("value").alias("amount"))


def _purchases(spark, sf):
    return _events(spark, sf).where(F.col("event_type") == "purchase")


PURCH = "SELECT event_id, user_id AS account_id, ts AS timestamp, value AS amount FROM events WHERE event_type = 'purchase'"


@register("velocity_window", f"""WITH p AS ({PURCH})
SELECT event_id, account_id, CAST(count(*) OVER (PARTITION BY account_id ORDER BY timestamp
  RANGE BETWEEN INTERVAL 2 MINUTES PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_2min FROM p""")
def q_velocity_window(spark, sf):
    return L.velocity_count(_purchases(spark, sf)).select("event_id", "account_id", "tx_count_2min")


@register("velocity_window_1d", f"""WITH p AS ({PURCH})
SELECT event_id, CAST(count(*) OVER (PARTITION BY account_id ORDER BY timestamp
  RANGE BETWEEN INTERVAL 1 DAY PRECEDING AND CURRENT ROW) AS INTEGER) AS tx_count_1d FROM p""")
def q_velocity_window_1d(spark, sf):
    return L.velocity_count(_purchases(spark, sf), minutes=1440, bucket_minutes=2880,
                            out="tx_count_1d").select("event_id", "tx_count_1d")


@register("failed_logins_window", """WITH u AS (
  SELECT event_id, user_id AS account_id, ts AS timestamp, event_type FROM events WHERE event_type IN ('purchase', 'error')),
c AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY account_id ORDER BY timestamp
  RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW) AS f FROM u)
SELECT event_id, CAST(f AS INTEGER) AS failed_login_count_1h FROM c WHERE event_type = 'purchase'""")
def q_failed_logins_window(spark, sf):
    ev = _events(spark, sf)
    tx = ev.where(F.col("event_type") == "purchase")
    fails = ev.where(F.col("event_type") == "error")
    return L.failed_login_count(tx, fails).select("event_id", "failed_login_count_1h")


@register("running_daily_total", f"""WITH p AS ({PURCH})
SELECT event_id, round_even(coalesce(sum(amount) OVER (PARTITION BY account_id, CAST(timestamp AS DATE)
  ORDER BY timestamp, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0), {R9}) AS daily_total_before_txn FROM p""")
def q_running_daily_total(spark, sf):
    d = L.daily_total_before(_purchases(spark, sf))
    return d.select("event_id", F.bround("daily_total_before_txn", R9).alias("daily_total_before_txn"))


@register("trailing_avg", f"""WITH p AS ({PURCH})
SELECT event_id, round_even(avg(amount) OVER (PARTITION BY account_id ORDER BY timestamp
  RANGE BETWEEN INTERVAL 30 DAYS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), {R9}) AS avg_amount_30d FROM p""")
def q_trailing_avg(spark, sf):
    t = L.trailing_average(_purchases(spark, sf))
    return t.select("event_id", F.bround("avg_amount_30d", R9).alias("avg_amount_30d"))


@register("account_age", f"""WITH p AS ({PURCH}),
f AS (SELECT user_id AS account_id, min(ts) AS first_ts FROM events GROUP BY user_id)
SELECT event_id, CAST(datediff('day', CAST(first_ts AS DATE), CAST(timestamp AS DATE)) AS INTEGER) AS account_age_days
FROM p JOIN f ON p.account_id = f.account_id""")
def q_account_age(spark, sf):
    return L.account_age(_purchases(spark, sf), _events(spark, sf)).select("event_id", "account_age_days")


@register("event_windows_tumbling", """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
  time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def q_event_windows_tumbling(spark, sf):
    return L.event_windows(read_table(spark, sf, "events"), kind="tumbling", duration="1 hour")


@register("event_windows_sliding", """WITH b AS (SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS s, event_type FROM events),
w AS (SELECT s AS window_start, event_type FROM b UNION ALL SELECT s - INTERVAL 5 MINUTES, event_type FROM b)
SELECT window_start, window_start + INTERVAL 10 MINUTES AS window_end, event_type, count(*) AS n FROM w GROUP BY ALL""")
def q_event_windows_sliding(spark, sf):
    return L.event_windows(read_table(spark, sf, "events"), kind="sliding", duration="10 minutes",
                           slide="5 minutes")


@register("event_windows_session", """WITH e AS (SELECT user_id, ts,
  CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTES THEN 0 ELSE 1 END AS brk FROM events),
s AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM e)
SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTES AS window_end, user_id, count(*) AS n
FROM s GROUP BY user_id, sid""")
def q_event_windows_session(spark, sf):
    return L.event_windows(read_table(spark, sf, "events"), kind="session", gap="30 minutes", keys=("user_id",))
