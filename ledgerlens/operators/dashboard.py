"""The dashboard's relational queries as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import first_present
from ledgerlens.operators.audit import AE_FLAG, ISO_FLAG

ACTIONS = ["ALLOW", "WARN", "BLOCK", "LOCK"]
ALL = "All"


def audit_lookup_join(final: DataFrame, audit_view: DataFrame) -> DataFrame:
    """K1: one audit row per transaction (deterministic pick: smallest
    audit_id), then a left join. The aggregate output is already hash
    partitioned on transaction_id, so only the other side is exchanged."""
    lookup = (audit_view.groupBy("transaction_id")
              .agg(F.min_by(F.struct("severity", "decision_source"), F.col("audit_id")).alias("_a"))
              .select("transaction_id", "_a.severity", "_a.decision_source"))
    return final.join(lookup, "transaction_id", "left")


def slicer_filter(df: DataFrame, risk_type: str = ALL, action: str = ALL, severity: str = ALL,
                  decision_source: str = ALL, min_final_score: int = 0) -> DataFrame:
    """K2: conjunction of the slicers built at plan time ("All" = no filter),
    so equality predicates reach the Parquet scan as pushed filters."""
    return df.filter(slicer_condition(risk_type, action, severity, decision_source, min_final_score))


def slicer_condition(risk_type: str = ALL, action: str = ALL, severity: str = ALL,
                     decision_source: str = ALL, min_final_score: int = 0) -> Column:
    cond = F.col("final_risk_score") >= F.lit(min_final_score)
    for column, value in (("risk_type", risk_type), ("final_action", action),
                          ("severity", severity), ("decision_source", decision_source)):
        if value != ALL:
            cond = cond & (F.col(column) == F.lit(value))
    return cond


def rows_of_matching_keys(df: DataFrame, condition: Column, key: str = "transaction_id") -> DataFrame:
    """K10/K11 over one flow: every row whose key has a row that meets the condition. The flow
    is computed once, where a semi-join of two views of it computes it on both sides."""
    hit = F.max(F.coalesce(condition, F.lit(False))).over(Window.partitionBy(key))
    return df.withColumn("_hit", hit).where(F.col("_hit") & F.col(key).isNotNull()).drop("_hit")


def slicer_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K3: sorted distinct non-null values per slicer, long format."""
    pairs = F.array(*[F.struct(F.lit(c).alias("slicer"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).where(F.col("value").isNotNull())
            .distinct().orderBy("slicer", "value"))


def kpis(df: DataFrame) -> DataFrame:
    """K4: the KPI row in one global aggregate (means 0 when empty, round 2)."""
    a = F.col("final_action")
    n = F.count(F.lit(1))

    def mean2(c):
        return F.coalesce(F.bround(F.avg(c), 2), F.lit(0.0))

    out = df.agg(
        n.alias("total_transactions"),
        *[F.count_if(a == x).alias(f"{x.lower()}_count") for x in ACTIONS],
        mean2("ml_fraud_score").alias("avg_ml_fraud_score"),
        mean2("rule_risk_score").alias("avg_rule_risk_score"),
        mean2("final_risk_score").alias("avg_final_risk_score"),
        mean2("autoencoder_anomaly_score").alias("avg_autoencoder_anomaly_score"),
        mean2("isolation_forest_anomaly_score").alias("avg_isolation_anomaly_score"),
        F.count_if(a.isin("BLOCK", "LOCK")).alias("enforcement_count"),
        F.count_if(F.col("autoencoder_anomaly_score") >= AE_FLAG).alias("autoencoder_flags"),
        F.count_if(F.col("isolation_forest_anomaly_score") >= ISO_FLAG).alias("isolation_flags"),
    )
    return out.withColumn(
        "enforcement_rate",
        F.when(F.col("total_transactions") > 0,
               F.col("enforcement_count") / F.col("total_transactions")).otherwise(F.lit(0.0)))


def action_distribution(df: DataFrame) -> DataFrame:
    """K5: counts in the fixed order ALLOW, WARN, BLOCK, LOCK, zero-filled.
    The 4-row dimension is a literal (bounded), joined to the aggregate."""
    spark = df.sparkSession
    dim = spark.createDataFrame([(i, a) for i, a in enumerate(ACTIONS)], "ord int, final_action string")
    counts = df.groupBy("final_action").agg(F.count(F.lit(1)).alias("n"))
    return (F.broadcast(dim).join(counts, "final_action", "left")
            .select("ord", "final_action", F.coalesce("n", F.lit(0)).alias("n"))
            .orderBy("ord"))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """K6: value_counts."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K6 for several columns in one scan: long (dimension, value, n)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value"))
                      for c in columns])
    return df.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n"))


def high_risk_review(df: DataFrame, k: int = 100) -> DataFrame:
    """K9: BLOCK/LOCK sorted by final score, ML score desc (id tie-break), top k
    (TakeOrderedAndProject: a per-partition top-k, no full sort)."""
    return (df.where(F.col("final_action").isin("BLOCK", "LOCK"))
            .orderBy(F.desc("final_risk_score"), F.desc("ml_fraud_score"), F.asc("transaction_id"))
            .limit(k))


def semi_join_view(view: DataFrame, filtered: DataFrame, k: int | None = None,
                   key: str = "transaction_id") -> DataFrame:
    """Rows of ``view`` whose key is in the filtered set (left semi
    join: no fan-out, no columns from the right), optionally first k by key."""
    out = view.join(filtered.select(key), key, "left_semi")
    if k is not None:
        out = out.orderBy(key).limit(k)
    return out


def top_features(importances: DataFrame, k: int = 10) -> DataFrame:
    """Top-k feature importances."""
    return importances.orderBy(F.desc("importance"), F.asc("feature")).limit(k)


ID_COLUMNS = ["transaction_id", "txn_id", "id"]


def record_lookup(df: DataFrame, record_id: str) -> DataFrame:
    """The first id column (in alias order) that has a string-equal
    match wins; one row is returned (smallest id value as tie-break)."""
    present = [c for c in ID_COLUMNS if c in df.columns]
    if not present:
        return df.limit(0)
    cond = None
    prio = None
    for i, name in enumerate(present):
        hit = F.col(name).cast("string") == F.lit(str(record_id))
        cond = hit if cond is None else cond | hit
        prio = F.when(hit, F.lit(i)) if prio is None else prio.when(hit, F.lit(i))
    return (df.where(cond).withColumn("_prio", prio)
            .orderBy("_prio", *present).limit(1).drop("_prio"))
