"""Decision system 1 composed end to end: transactions -> rules -> benchmark
join -> final decision -> audit. Each step is a DataFrame function; this
module only wires them to the driver tables (no scheduler of our own)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.operators.audit import audit_records, audit_view
from ledgerlens.operators.final_decision import apply_final_decisions, merge_benchmark_scores
from ledgerlens.operators.rules import apply_rules
from ledgerlens.sources.fixtures import bench_orders, txn_orders
from ledgerlens.sources.tables import read_table


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_orders(read_table(spark, sf_dir, "orders"))


def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(transactions(spark, sf_dir))


def benchmark_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bench_orders(read_table(spark, sf_dir, "orders"))


def final_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_benchmark_scores(rule_scored(spark, sf_dir), benchmark_scores(spark, sf_dir))
    return apply_final_decisions(merged)


def audit_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_records(final_decisions(spark, sf_dir))


def audit_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_view(audit_docs(spark, sf_dir))
