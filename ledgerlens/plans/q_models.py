"""Registered model queries (I): feature preparation with SQL twins, and
Spark ML / custom model fits with rows-only checks (model bits differ from
any other library, so only quality and invariants are asserted in tests)."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.operators import dashboard as K
from ledgerlens.operators import models as M
from ledgerlens.plans import decisions as D
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import REQUESTS_CTE, RULES_CTE, with_
from ledgerlens.session import ensure_checkpoint_dir, shared_table
from ledgerlens.sources.fixtures import requests_orders
from ledgerlens.sources.tables import read_table, spread

R6 = 6


def _clean_sql(f: str) -> str:
    return f"CASE WHEN {f} IS NULL OR isnan(CAST({f} AS DOUBLE)) OR isinf(CAST({f} AS DOUBLE)) THEN 0e0 ELSE CAST({f} AS DOUBLE) END"


@register("feature_matrix", with_(RULES_CTE, "SELECT transaction_id, " + ", ".join(
    f"{_clean_sql(f)} AS {f}" for f in M.FEATURE_COLUMNS) + " FROM rules"))
def q_feature_matrix(spark, sf):
    r = D.rule_scored(spark, sf)
    return r.select("transaction_id", *[M.clean_feature(F.col(f)).alias(f) for f in M.FEATURE_COLUMNS])


@register("class_weights", with_(RULES_CTE, """SELECT is_fraud, count(*) AS n_class,
  (SELECT count(*) FROM rules) / (2e0 * count(*)) AS weight FROM rules GROUP BY is_fraud"""))
def q_class_weights(spark, sf):
    return M.class_weights(D.rule_scored(spark, sf))


@register("hash_split")
def q_hash_split(spark, sf):
    """Split sizes per label (xxhash64 split; rows-only)."""
    r = D.rule_scored(spark, sf)
    return r.groupBy(M.hash_split(r, "transaction_id").alias("is_test"), "is_fraud").agg(
        F.count(F.lit(1)).alias("n"))


@register("stratified_split", with_(RULES_CTE, """SELECT transaction_id, is_fraud,
  row_number() OVER (PARTITION BY is_fraud ORDER BY md5('42|' || transaction_id), transaction_id)
    <= floor(0.25e0 * count(*) OVER (PARTITION BY is_fraud) + 0.5e0) AS is_test FROM rules"""))
def q_stratified_split(spark, sf):
    """Exactly a quarter of every class, by the smallest hashes."""
    r = D.rule_scored(spark, sf).select("transaction_id", "is_fraud")
    return M.stratified_split(r, "transaction_id")


_STD_SQL = "\n  UNION ALL ".join(
    f"SELECT '{f}' AS feature, round_even(avg({_clean_sql(f)}), {R6}) AS mean, "
    f"round_even(stddev_pop({_clean_sql(f)}), {R6}) AS std FROM rules WHERE is_fraud = 0" for f in M.FEATURE_COLUMNS)


@register("standardized", with_(RULES_CTE, _STD_SQL))
def q_standardized(spark, sf):
    """Mean / population std per feature on normal rows (long form)."""
    r = D.rule_scored(spark, sf)
    clean = r.select("is_fraud", *[M.clean_feature(F.col(f)).alias(f) for f in M.FEATURE_COLUMNS])
    st = M.fit_standardizer(clean.where("is_fraud = 0"), M.FEATURE_COLUMNS)
    arr = F.array(*[F.struct(F.lit(f).alias("feature"), F.bround(F.col(f"{f}__mean"), R6).alias("mean"),
                             F.bround(F.col(f"{f}__std"), R6).alias("std")) for f in M.FEATURE_COLUMNS])
    return st.select(F.inline(arr))


@register("minmax_scores", with_(RULES_CTE, """, mm AS (SELECT min(amount_to_avg_ratio) AS lo, max(amount_to_avg_ratio) AS hi FROM rules WHERE is_fraud = 0)
SELECT transaction_id, least(1e0, greatest(0e0, (amount_to_avg_ratio - lo) / CASE WHEN hi - lo = 0 THEN 1e0 ELSE hi - lo END)) AS ratio_score
FROM rules, mm"""))
def q_minmax_scores(spark, sf):
    """Amount ratio min-max scaled with the normal rows' range, clipped."""
    r = D.rule_scored(spark, sf)
    normal = r.where("is_fraud = 0")
    lo = normal.select(F.min("amount_to_avg_ratio")).scalar()
    hi = normal.select(F.max("amount_to_avg_ratio")).scalar()
    return r.select("transaction_id", M.minmax_normalize(F.col("amount_to_avg_ratio"), lo, hi).alias("ratio_score"))


@register("quantile_threshold", with_(RULES_CTE, """, th AS (SELECT quantile_cont(amount_to_avg_ratio, 0.95) AS t FROM rules WHERE is_fraud = 0)
SELECT round_even(t, 9) AS threshold, count_if(amount_to_avg_ratio >= t) AS n_flagged FROM rules, th GROUP BY t"""))
def q_quantile_threshold(spark, sf):
    """95th percentile (linear) of the normal rows' score; rows >= flagged."""
    r = D.rule_scored(spark, sf)
    normal = r.where("is_fraud = 0")
    t = exact_quantiles(normal, "amount_to_avg_ratio", [0.95]).select(F.col("qs")[0]).scalar()
    return (r.agg(F.count_if(F.col("amount_to_avg_ratio") >= t).alias("n_flagged"))
            .select(F.bround(t, 9).alias("threshold"), "n_flagged"))


def _embeddings(spark, sf):
    e = read_table(spark, sf, "embeddings")
    from pyspark.ml.functions import array_to_vector
    return e.select("vec_id", "label", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))


@register("pca_anomaly")
def q_pca_anomaly(spark, sf):
    """I8 + I10 + I11: linear autoencoder on the embeddings (label 0 = normal)."""
    e = _embeddings(spark, sf)
    normal = e.where("label = 0")
    scored = M.pca_autoencoder(normal, e, "features", k=6)
    tr = scored.where("label = 0")
    lo = tr.select(F.min("reconstruction_error")).scalar()
    hi = tr.select(F.max("reconstruction_error")).scalar()
    th = exact_quantiles(tr, "reconstruction_error", [0.95]).select(F.col("qs")[0]).scalar()
    return scored.select("vec_id", "label", "reconstruction_error",
                         F.bround(M.minmax_normalize(F.col("reconstruction_error"), lo, hi) * 100, 0)
                         .cast("int").alias("autoencoder_anomaly_score"),
                         (F.col("reconstruction_error") >= th).alias("predicted_anomaly"))


@register("isolation_forest")
def q_isolation_forest(spark, sf):
    """Distributed isolation forest on the embeddings (label 0 = normal)."""
    e = _embeddings(spark, sf)
    forest, psi = M.isolation_forest_fit(e.where("label = 0"), "vec_id", "features")
    return M.isolation_forest_score(e, forest, psi, "features").select("vec_id", "label", "anomaly_score")


@register("transaction_anomaly")
def q_transaction_anomaly(spark, sf):
    """I7 + I9 + I10 + I11: forest on the standardised normal training transactions; every
    transaction's scaled score, and its flag from the 95th percentile of the training scores."""
    r = spread(D.rule_scored(spark, sf).select("transaction_id", "is_fraud", *M.FEATURE_COLUMNS))
    clean = r.select("transaction_id", "is_fraud", *[M.clean_feature(F.col(f)).alias(f) for f in M.FEATURE_COLUMNS])
    # a table: the standardizer, the draw and the scoring each read the split rows
    split = shared_table(M.stratified_split(clean, "transaction_id"), "split-rows")
    stats = M.fit_standardizer(split.where("NOT is_test AND is_fraud = 0"), M.FEATURE_COLUMNS)
    scaled = VectorAssembler(inputCols=M.FEATURE_COLUMNS, outputCol="features").transform(M.standardize(split, stats, M.FEATURE_COLUMNS))
    rows = scaled.select("transaction_id", "is_fraud", "is_test", "features")
    normal = "NOT is_test AND is_fraud = 0"
    return M.flag_anomalies(rows, normal, "transaction_id", "features").drop("features")


def _train_frames(spark, sf):
    """Three quarters of each class to fit on. The split rows are a table, dealt to all
    cores, as a fit reads them many times."""
    r = spread(D.rule_scored(spark, sf).select("transaction_id", "is_fraud", *M.FEATURE_COLUMNS))
    fm = M.with_class_weight(M.feature_matrix(r))
    split = shared_table(M.stratified_split(fm, "transaction_id"), "train-frame")
    return split.where("NOT is_test").drop("is_test"), split.drop("is_test")


def _model_scores(spark, sf, name):
    ensure_checkpoint_dir(spark)  # GBT checkpoints its lineage every 10 iterations
    train, full = _train_frames(spark, sf)
    _, scored = M.fit_and_score(train, full, name)
    s = M.slug(name)
    return scored.select("transaction_id", "is_fraud", f"{s}_probability", f"{s}_score")


@register("lr_scores")
def q_lr_scores(spark, sf):
    return _model_scores(spark, sf, "Logistic Regression")


@register("rf_scores")
def q_rf_scores(spark, sf):
    return _model_scores(spark, sf, "Random Forest")


@register("gbt_scores")
def q_gbt_scores(spark, sf):
    return _model_scores(spark, sf, "Gradient Boosting")


@register("mlp_scores")
def q_mlp_scores(spark, sf):
    return _model_scores(spark, sf, "MLP Neural Network")


@register("feature_importance")
def q_feature_importance(spark, sf):
    """Random-forest importances (15 rows)."""
    train, _ = _train_frames(spark, sf)
    model = M.supervised_estimators()["Random Forest"].fit(train)
    return M.feature_importance(model, spark=spark)


@register("top_features")
def q_top_features(spark, sf):
    """The ten most important features of the random forest."""
    return K.top_features(q_feature_importance(spark, sf), 10)


@register("ml_score_columns", with_(REQUESTS_CTE, """SELECT transaction_id, fraud_probability AS ml_fraud_probability,
  CAST(round_even(fraud_probability * 100, 0) AS INTEGER) AS ml_fraud_score,
  CAST(round_even(greatest(fraud_probability, 1e0 - fraud_probability) * 100, 0) AS INTEGER) AS model_confidence,
  CASE WHEN fraud_probability >= 0.5e0 THEN 1 ELSE 0 END AS predicted_fraud FROM req"""))
def q_ml_score_columns(spark, sf):
    """The score columns of a given probability."""
    req = requests_orders(read_table(spark, sf, "orders"))
    return req.select("transaction_id", *[c.alias(n) for n, c in M.probability_columns(F.col("fraud_probability")).items()])


@register("model_score_table")
def q_model_score_table(spark, sf):
    """I12 + I13: the columns of all four supervised models, the isolation forest and the
    autoencoder in one table (rows-only: model fits)."""
    ensure_checkpoint_dir(spark)
    train, full = _train_frames(spark, sf)
    scored = M.score_table(train, full, list(M.supervised_estimators()), "Random Forest", "transaction_id")
    return scored.drop("features", "weight", *M.FEATURE_COLUMNS)
