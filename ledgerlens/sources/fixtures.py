"""Adapters from the driver tables to the engine's input shapes.

The fixture expressions are plain SQL text so that exactly the same text is
evaluated by Spark (``F.expr``) and by the DuckDB oracle. Integer arithmetic
only, exponent literals (``25e0``) are doubles in both engines, no integer
division (DuckDB and Spark differ on rounding casts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ---- F1: transactions derived from `orders` (k = o_orderkey, c = o_custkey) ----

_DAILY_LIMIT = ("CASE WHEN o_custkey % 20 < 7 THEN 50000e0 WHEN o_custkey % 20 < 14 THEN 100000e0 "
                "WHEN o_custkey % 20 < 18 THEN 200000e0 ELSE 500000e0 END")
_ML_SCORE = "CAST(o_orderkey * 53 % 101 AS INT)"

TXN_COLUMNS: list[tuple[str, str]] = [
    ("transaction_id", "concat('TXN_', CAST(o_orderkey AS STRING))"),
    ("account_id", "concat('ACC_', CAST(o_custkey AS STRING))"),
    ("timestamp", "o_orderdate"),
    ("amount", "o_totalprice / 25e0"),
    ("daily_total_before_txn", f"({_DAILY_LIMIT}) * ((o_orderkey * 31 % 91 + 5) / 100e0)"),
    ("daily_limit", _DAILY_LIMIT),
    ("tx_count_2min", "CAST(CASE WHEN o_orderkey % 11 = 0 THEN 1 + o_orderkey % 12 "
                      "ELSE 1 + o_orderkey % 3 END AS INT)"),
    ("beneficiary_age_days", "CAST(o_orderkey * 17 % 400 AS INT)"),
    ("is_new_device", "CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 19 = 0 THEN 1 ELSE 0 END"),
    ("is_new_location", "CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 1 ELSE 0 END"),
    ("failed_login_count_1h", "CAST(CASE WHEN o_orderkey % 13 = 0 THEN o_orderkey % 7 "
                              "WHEN o_orderkey % 29 < 3 THEN 3 ELSE o_orderkey % 3 END AS INT)"),
    ("hour_of_day", "CAST(o_orderkey * 7919 % 24 AS INT)"),
    ("merchant_risk_score", "CAST(5 + o_orderkey * 29 % 95 AS INT)"),
    ("account_age_days", "CAST(o_custkey * 43 % 3650 AS INT)"),
    ("avg_amount_30d", "1000e0 + (o_custkey * 37 % 9000)"),
    ("risk_type", "o_orderpriority"),
    ("ml_fraud_score", _ML_SCORE),
    ("ml_fraud_probability", f"{_ML_SCORE} / 100e0"),
    ("model_confidence", f"greatest({_ML_SCORE}, 100 - {_ML_SCORE})"),
    ("predicted_fraud", f"CASE WHEN {_ML_SCORE} >= 50 THEN 1 ELSE 0 END"),
    ("is_fraud", f"CASE WHEN o_orderkey * 41 % 97 < {_ML_SCORE} THEN 1 ELSE 0 END"),
]

# T4 benchmark scores, one row per transaction.
BENCH_COLUMNS: list[tuple[str, str]] = [
    ("transaction_id", "concat('TXN_', CAST(o_orderkey AS STRING))"),
    ("gradient_boosting_score", "CAST(o_orderkey * 73 % 101 AS INT)"),
    ("random_forest_score", "CAST(o_orderkey * 71 % 101 AS INT)"),
    ("logistic_regression_score", "CAST(o_orderkey * 59 % 101 AS INT)"),
    ("mlp_neural_network_score", "CAST(o_orderkey * 79 % 101 AS INT)"),
    ("isolation_forest_anomaly_score", "CAST(o_orderkey * 61 % 101 AS INT)"),
    ("autoencoder_anomaly_score", "CAST(o_orderkey * 67 % 101 AS INT)"),
    ("autoencoder_reconstruction_error", "(o_orderkey * 83 % 1000) / 100e0"),
]

# scoring requests (decision system 2) from `orders`.
_ISO = "CAST(o_orderkey * 61 % 101 AS INT)"
_AE = "CAST(o_orderkey * 67 % 101 AS INT)"
REQUEST_COLUMNS: list[tuple[str, str]] = [
    ("transaction_id", "concat('TXN_', CAST(o_orderkey AS STRING))"),
    ("user_id", "concat('ACC_', CAST(o_custkey AS STRING))"),
    ("fraud_probability", f"{_ML_SCORE} / 100e0"),
    ("model_confidence", f"greatest({_ML_SCORE}, 100 - {_ML_SCORE}) / 100e0"),
    ("anomaly_flag", f"greatest({_ISO}, {_AE}) >= 85"),
    ("amount_limit_violation", "o_orderkey % 7 = 0"),
    ("daily_limit_violation", "o_orderkey % 11 = 0"),
    ("velocity_violation", "o_orderkey % 13 = 0"),
    ("foreign_ip", "o_orderkey % 17 = 0"),
    ("new_device", "o_orderkey % 19 = 0"),
    ("multiple_failed_logins", "o_orderkey % 23 = 0"),
    ("account_takeover_pattern", "o_orderkey % 29 = 0"),
    ("blacklisted_merchant", "o_orderkey % 31 = 0"),
    ("high_risk_country", "o_orderkey % 37 = 0"),
    ("unusual_time", "o_orderkey % 5 = 0"),
]

# the drift split point on o_orderdate.
DRIFT_CUT = "1998-01-01"


def _project(df: DataFrame, columns: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns])


def sql_select_list(columns: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in columns)


def txn_orders(orders: DataFrame) -> DataFrame:
    """T1 + T3 columns (no derived columns; the rule engine adds them)."""
    return _project(orders, TXN_COLUMNS)


def bench_orders(orders: DataFrame) -> DataFrame:
    """F1: T4 benchmark-score table."""
    return _project(orders, BENCH_COLUMNS)


def requests_orders(orders: DataFrame) -> DataFrame:
    """T9 scoring requests."""
    return _project(orders, REQUEST_COLUMNS)


def txn_sql() -> str:
    return f"SELECT\n  {sql_select_list(TXN_COLUMNS)}\nFROM orders"


def bench_sql() -> str:
    return f"SELECT\n  {sql_select_list(BENCH_COLUMNS)}\nFROM orders"


def requests_sql() -> str:
    return f"SELECT\n  {sql_select_list(REQUEST_COLUMNS)}\nFROM orders"


# F11 status events: two analyst updates per order-derived case.
CASE_EVENT_COLUMNS: list[tuple[str, str]] = [
    ("transaction_id", "concat('TXN_', CAST(o_orderkey AS STRING))"),
    ("day_offset", "CAST(1 + o_orderkey % 3 AS INT)"),
    ("status", "CASE o_orderstatus WHEN 'F' THEN 'RESOLVED_FRAUD' WHEN 'O' THEN 'ESCALATED' "
               "ELSE 'RESOLVED_GENUINE' END"),
]


def case_events_orders(orders: DataFrame) -> DataFrame:
    """Status-update events derived from `orders`: an UNDER_REVIEW event one
    day after the order and a resolution 1-3 days later."""
    base = orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    first = base.select(F.expr("concat('TXN_', CAST(o_orderkey AS STRING))").alias("transaction_id"),
                        F.lit("UNDER_REVIEW").alias("status"),
                        F.expr("o_orderdate + INTERVAL 1 DAY").alias("ts"))
    second = base.select(*[F.expr(e).alias(n) for n, e in CASE_EVENT_COLUMNS], "o_orderdate") \
        .select("transaction_id", "status",
                F.expr("o_orderdate + make_interval(0, 0, 0, 1 + day_offset)").alias("ts"))
    return first.unionByName(second)
