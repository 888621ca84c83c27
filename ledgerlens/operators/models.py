"""Model training and scoring with Spark ML.

* supervised models are Spark ML estimators fitted on an exactly stratified
  split (or a hash split, which needs no selection);
* the autoencoder is re-aimed as a linear (PCA) autoencoder: scaler + PCA
  fitted on normal rows, error = mean squared residual = (|x|^2 - |P^T x|^2)/d
  because the principal axes are orthonormal;
* the isolation forest is the one custom model: every tree draws its own rows
  from the whole table by hashes (no global sort), trees are grown in parallel
  with ``groupBy(tree).applyInPandas`` and the forest (<= trees * (2*psi - 1)
  nodes, independent of the table size) is broadcast to a vectorised
  ``pandas_udf`` scorer.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.session import shared_table

# The 15 model features in reference order.
FEATURE_COLUMNS = [
    "amount", "daily_total_before_txn", "daily_limit", "tx_count_2min", "beneficiary_age_days",
    "is_new_device", "is_new_location", "failed_login_count_1h", "hour_of_day", "merchant_risk_score",
    "account_age_days", "avg_amount_30d", "total_after_txn", "daily_limit_utilization", "amount_to_avg_ratio",
]
TARGET_COLUMN = "is_fraud"


def clean_feature(c: Column) -> Column:
    """+-inf / NaN / null -> 0."""
    x = c.cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


def feature_matrix(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, out: str = "features") -> DataFrame:
    """Cleaned features assembled into one vector column."""
    from pyspark.ml.feature import VectorAssembler
    clean = df.withColumns({f: clean_feature(F.col(f)) for f in features})
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(clean)


def hash_split(df: DataFrame, key: str, test_pct: int = 25, seed: int = 42) -> Column:
    """Deterministic test-split flag from a hash of the key (no shuffle,
    independent of partitioning; stratification holds in expectation)."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < test_pct


def _split_key(key: str, seed: int) -> Column:
    """Uniform hex key of a row; the key itself breaks the (unlikely) tie."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.concat(F.md5(F.concat(F.lit(f"{seed}|"), k).cast("binary")), F.lit("|"), k)


def stratified_cuts(df: DataFrame, key: str, label: str, test_share: float = 0.25, seed: int = 42, digits: int = 3) -> DataFrame:
    """I2, the selection: per class, the split key of the last test row, floor(share * n + 1/2)
    rows being test rows (label, cut; null cut where the class has none).

    Two rounds narrow the range that holds that rank by counts of ``digits`` hex digits each
    (16^digits numbers per class), so only about n / 16^(2 digits) keys of a class are ever
    ranked, in one window."""
    keyed = df.select(F.col(label).alias("_c"), _split_key(key, seed).alias("_k"))
    of_class = Window.partitionBy("_c")
    counts = (keyed.groupBy("_c", F.substring("_k", 1, digits).alias("_p")).agg(F.count(F.lit(1)).alias("_m"))
              .withColumn("_rank", F.floor(F.sum("_m").over(of_class) * test_share + 0.5)))
    for length in (digits, 2 * digits):
        held = counts.withColumn("_upto", F.sum("_m").over(of_class.orderBy("_p"))).where("_upto >= _rank AND _upto - _m < _rank")
        at = F.broadcast(held.select(F.col("_c").alias("_class"), (F.col("_rank") - F.col("_upto") + F.col("_m")).alias("_rank"), F.col("_p").alias("_prefix")))  # one row a class
        inside = keyed.join(at, F.col("_c").eqNullSafe(F.col("_class"))).where(F.startswith("_k", "_prefix"))
        counts = inside.groupBy("_c", "_rank", F.substring("_k", 1, 2 * length).alias("_p")).agg(F.count(F.lit(1)).alias("_m"))
    return (inside.withColumn("_nth", F.row_number().over(of_class.orderBy("_k"))).where("_nth = _rank")
            .select(F.col("_c").alias(label), F.col("_k").alias("cut")))


def stratified_split(df: DataFrame, key: str, label: str = TARGET_COLUMN, test_share: float = 0.25, seed: int = 42,
                     out: str = "is_test") -> DataFrame:
    """``out`` is true for exactly floor(share * n + 1/2) rows of every class, the ones
    with the smallest split keys. The rows are not moved: each is compared with its class's
    cut, a table of one row per class. Rows that repeat a key stay on one side."""
    cuts = stratified_cuts(df, key, label, test_share, seed).withColumnRenamed(label, "_c")
    joined = df.join(F.broadcast(cuts), F.col(label).eqNullSafe(F.col("_c")), "left")
    return joined.withColumn(out, F.coalesce(_split_key(key, seed) <= F.col("cut"), F.lit(False))).drop("_c", "cut")


def class_weights(df: DataFrame, label: str = TARGET_COLUMN) -> DataFrame:
    """I15: 'balanced' weights n / (2 * n_class); a two-row table."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.select(label, "n_class", (total / (F.lit(2.0) * F.col("n_class"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str = TARGET_COLUMN, out: str = "weight") -> DataFrame:
    w = class_weights(df, label)
    return df.join(F.broadcast(w.select(label, F.col("weight").alias(out))), label)  # 2 rows


def probability_columns(p: Column, prefix: str = "ml") -> dict[str, Column]:
    """Probability, rounded score, confidence, predicted class."""
    return {
        f"{prefix}_fraud_probability": p,
        f"{prefix}_fraud_score": F.bround(p * 100, 0).cast("int"),
        "model_confidence": F.bround(F.greatest(p, F.lit(1.0) - p) * 100, 0).cast("int"),
        "predicted_fraud": (p >= 0.5).cast("int"),
    }


def slug(name: str) -> str:
    """Lower-case, space / '-' / '/' -> '_'."""
    return name.lower().replace(" ", "_").replace("-", "_").replace("/", "_")


def supervised_estimators(seed: int = 42, weight_sum: float | None = None) -> dict:
    """I3-I6 with the reference hyper-parameters mapped to Spark ML. ``weight_sum`` (the
    training weights' sum) turns the default L2 strength C = 1 into Spark's regParam,
    which applies to the mean loss."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler

    from ledgerlens.operators.forest import HistogramForest
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    return {
        "Logistic Regression": Pipeline(stages=[scaler, LogisticRegression(
            featuresCol="scaled", labelCol=TARGET_COLUMN, weightCol="weight", maxIter=2000, regParam=1.0 / weight_sum if weight_sum else 0.0)]),
        "Random Forest": HistogramForest(
            featuresCol="features", labelCol=TARGET_COLUMN, weightCol="weight", numTrees=250, maxDepth=12,
            minInstancesPerNode=4, seed=seed),
        "Gradient Boosting": GBTClassifier(
            featuresCol="features", labelCol=TARGET_COLUMN, weightCol="weight", maxIter=250, stepSize=0.06,
            maxDepth=5, maxBins=256, seed=seed, checkpointInterval=10, maxMemoryInMB=1024),
        "MLP Neural Network": Pipeline(stages=[scaler, MultilayerPerceptronClassifier(
            featuresCol="scaled", labelCol=TARGET_COLUMN, layers=[len(FEATURE_COLUMNS), 64, 32, 16, 2],
            maxIter=500, seed=seed)]),
    }


def fit_and_score(train: DataFrame, score_on: DataFrame, name: str, seed: int = 42):
    """Fit one supervised model on ``train`` (needs features + weight) and
    return (model, scored frame with ``<slug>_probability`` / ``<slug>_score``)."""
    from pyspark.ml.functions import vector_to_array
    weight_sum = None
    if name == "Logistic Regression":
        weight_sum = train.agg(F.sum("weight")).first()[0]
    est = supervised_estimators(seed, weight_sum)[name]
    model = est.fit(train)
    s = slug(name)
    scored = model.transform(score_on)
    p = vector_to_array("probability")[1]
    scored = scored.withColumns({f"{s}_probability": p, f"{s}_score": F.bround(p * 100, 0).cast("int")})
    return model, scored.drop("rawPrediction", "probability", "prediction", "scaled")


def score_table(train: DataFrame, score_on: DataFrame, names: Sequence[str], main: str, key: str,
                normal: str = "is_fraud = 0", seed: int = 42) -> DataFrame:
    """I12 + I13: one table with every model's columns: ``<slug>_probability`` and
    ``<slug>_score`` of the supervised models, the isolation forest and autoencoder scores
    and error, and the ``ml_*`` columns of the model ``main``. The models score the same
    rows one after the other, so nothing is joined. Both frames need ``features``."""
    out = score_on
    for name in names:
        _, out = fit_and_score(train, out, name, seed)
    base = train.where(normal)
    forest, psi = isolation_forest_fit(base, key, "features")
    autoencoder = pca_autoencoder_fit(base, "features", k=6)
    # the training rows' range, one row
    seen = autoencoder(isolation_forest_score(base, forest, psi, "features")).agg(*[
        f(c).alias(n + c) for c in ("anomaly_score", "reconstruction_error") for n, f in (("lo_", F.min), ("hi_", F.max))]).first()
    scaled = lambda c: F.bround(minmax_normalize(F.col(c), F.lit(seen["lo_" + c]), F.lit(seen["hi_" + c])) * 100, 0).cast("int")
    out = autoencoder(isolation_forest_score(out, forest, psi, "features")).withColumns({
        "isolation_forest_anomaly_score": scaled("anomaly_score"),
        "autoencoder_anomaly_score": scaled("reconstruction_error"),
        **probability_columns(F.col(f"{slug(main)}_probability"))})
    return out.drop("anomaly_score").withColumnRenamed("reconstruction_error", "autoencoder_reconstruction_error")


def feature_importance(rf_model, features: Sequence[str] = FEATURE_COLUMNS, spark=None) -> DataFrame:
    """Importances as a (feature, importance) table sorted desc (15 rows)."""
    imp = rf_model.featureImportances.toArray().tolist()
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    return spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature")


# ---------------- I9-I11: standardisation, min-max, quantile threshold ----------------

def fit_standardizer(normal: DataFrame, features: Sequence[str]) -> DataFrame:
    """One-row table of mean / population std per feature (normal rows)."""
    aggs = []
    for f in features:
        aggs += [F.avg(f).alias(f"{f}__mean"), F.stddev_pop(f).alias(f"{f}__std")]
    return normal.agg(*aggs)


def standardize(df: DataFrame, stats: DataFrame, features: Sequence[str]) -> DataFrame:
    """Apply I9 with the one-row stats table (read once, as literals; std 0 -> 1)."""
    row = stats.first()
    return df.withColumns({f: (F.col(f) - F.lit(row[f"{f}__mean"])) / F.lit(row[f"{f}__std"] or 1.0) for f in features})


def minmax_normalize(score: Column, lo: Column, hi: Column) -> Column:
    """(x - min) / (max - min) clipped to [0, 1]; constant -> scale 1."""
    rng = F.when(hi - lo == 0, F.lit(1.0)).otherwise(hi - lo)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), (score - lo) / rng))


# ---------------- I8: linear (PCA) autoencoder ----------------

def pca_autoencoder_fit(train_normal: DataFrame, vec_col: str = "features", k: int = 6):
    """Fit scaler + PCA(k) on normal rows. The result is a function that adds
    ``reconstruction_error``, the mean squared residual of the standardised vector."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import vector_to_array
    sc = StandardScaler(inputCol=vec_col, outputCol="_z", withMean=True, withStd=True).fit(train_normal)
    pca = PCA(k=k, inputCol="_z", outputCol="_proj").fit(sc.transform(train_normal))

    def score(df: DataFrame) -> DataFrame:
        sq = lambda a: F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v * v)
        za, pa = vector_to_array("_z"), vector_to_array("_proj")
        err = F.greatest(F.lit(0.0), sq(za) - sq(pa)) / F.size(za)
        return pca.transform(sc.transform(df)).withColumn("reconstruction_error", err).drop("_z", "_proj")

    return score


def pca_autoencoder(train_normal: DataFrame, score_on: DataFrame, vec_col: str = "features", k: int = 6) -> DataFrame:
    """Fit on normal rows, score every row of ``score_on``."""
    return pca_autoencoder_fit(train_normal, vec_col, k)(score_on)


# ---------------- I7: isolation forest ----------------

def _c(n: float) -> float:
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _grow_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    """Arrays (feature, threshold, left, right, size) of one isolation tree."""
    feat, thr, left, right, size = [], [], [], [], []

    def node(idx: np.ndarray, depth: int) -> int:
        nid = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return nid
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.flatnonzero(hi > lo)
        if cand.size == 0:
            return nid
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        mask = sub[:, f] < t
        feat[nid], thr[nid] = f, t
        left[nid] = node(idx[mask], depth + 1)
        right[nid] = node(idx[~mask], depth + 1)
        return nid

    node(np.arange(len(x)), 0)
    return feat, thr, left, right, size


def _ranks(keys: np.ndarray, trees: np.ndarray) -> np.ndarray:
    """Uniform 64-bit ranks of rows (hash keys) in trees: splitmix64 of both."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)[:, None] + (trees.astype(np.uint64)[None, :] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def tree_samples(rows: DataFrame, id_col: str, vec_col: str, n_trees: int, sample_size: int, seed: int = 42) -> tuple[DataFrame, int]:
    """I7, the draw: (tree, rank, key, x), for every tree the ``psi = min(sample_size, n)``
    rows of smallest rank, and psi. Ranks are hashes of row and tree, so each tree draws its
    own rows from the whole table, without replacement.

    One pass over the rows keeps a (row, tree) pair only if its rank is below the level that
    psi + 6 sqrt(psi) + 20 rows of a tree are expected to reach; the smallest psi of each
    tree are then picked in one small group per tree. A level that left a tree short
    (a chance of about e^-18 a tree) is doubled and the pass repeated. Rows of one id and
    vector are one row of the table each, with neighbouring ranks."""
    from pyspark.ml.functions import vector_to_array
    n = rows.count()
    if n == 0:
        raise ValueError("isolation forest needs at least one normal row")
    psi = min(sample_size, n)
    keyed = rows.select(F.xxhash64(F.col(id_col), F.lit(seed)).alias("key"), vector_to_array(vec_col).alias("x"))
    trees = np.arange(n_trees)
    schema = "tree int, rank string, key long, x array<double>"
    wanted = psi + 6 * math.sqrt(psi) + 20

    while True:
        level = min(int(wanted / n * 2.0 ** 64), 2 ** 64 - 1)

        def draw(batches, level=level):
            for pdf in batches:
                for at in range(0, len(pdf), 4096):
                    part = pdf.iloc[at:at + 4096]
                    ranks = _ranks(part["key"].to_numpy(np.int64), trees)
                    row, tree = np.nonzero(ranks <= np.uint64(level))
                    yield pd.DataFrame({"tree": tree.astype(np.int32), "rank": [f"{r:016x}" for r in ranks[row, tree].tolist()],
                                        "key": part["key"].to_numpy()[row], "x": part["x"].to_numpy()[row]})

        drawn = keyed.mapInPandas(draw, schema).repartition("tree")
        ordered = Window.partitionBy("tree").orderBy("rank", "key", "x")
        sample = drawn.withColumn("nth", F.row_number().over(ordered)).where(F.col("nth") <= psi)
        sizes = sample.groupBy("tree").count().where(F.col("count") == psi).count()
        if sizes == n_trees or level == 2 ** 64 - 1:
            return sample.select("tree", "rank", "key", "x"), psi
        wanted *= 2


def isolation_forest_fit(normal: DataFrame, id_col: str, vec_col: str, n_trees: int = 250,
                         sample_size: int = 256, seed: int = 42) -> tuple[dict, int]:
    """Grow ``n_trees`` trees on exactly ``psi = min(sample_size, n)`` distinct rows each,
    drawn for every tree from all rows (:func:`tree_samples`). A tree grows in its own task
    from its psi rows; only the nodes come to the driver."""
    samples, psi = tree_samples(normal, id_col, vec_col, n_trees, sample_size, seed)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    schema = "tree int, node int, feature int, threshold double, left int, right int, size int"

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["rank", "key"])
        f, t, l_, r_, s = _grow_tree(np.vstack(pdf["x"].to_numpy()).astype(float), np.random.default_rng([seed, tree]), depth)
        return pd.DataFrame({"tree": tree, "node": np.arange(len(f)), "feature": f, "threshold": t, "left": l_, "right": r_, "size": s})

    nodes = samples.groupBy("tree").applyInPandas(grow, schema).toPandas()  # <= n_trees * (2*psi-1) rows
    forest = {t: g.sort_values("node") for t, g in nodes.groupby("tree")}
    return forest, psi


def _pack_forest(forest: dict, max_depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trees as complete binary trees of ``max_depth`` levels, node k's children being 2k + 1
    and 2k + 2: (features, thresholds, path lengths of the last level's places), one row a
    tree. A leaf above the last level hands its path length down to all places below it."""
    inner = 2 ** max_depth - 1
    feat, thr = np.zeros((len(forest), inner), np.int64), np.zeros((len(forest), inner))
    length = np.zeros((len(forest), inner + 1))
    for n, tree in enumerate(forest.values()):
        f, t, left, right, size = (tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size"))
        level = [(0, 0)]  # (node, depth of the leaf it is or lies below)
        for depth in range(max_depth):
            first, below = 2 ** depth - 1, []
            for place, (node, at) in enumerate(level):
                if f[node] >= 0:
                    feat[n, first + place], thr[n, first + place] = f[node], t[node]
                    below += [(left[node], at + 1), (right[node], at + 1)]
                else:
                    below += [(node, at), (node, at)]
            level = below
        length[n] = [at + _c(size[node]) for node, at in level]
    return feat, thr, length


def _path_lengths(packed: tuple[np.ndarray, np.ndarray, np.ndarray], data: np.ndarray) -> np.ndarray:
    """Mean path length of every row over the trees: all trees of a run of rows go down one
    level at a time."""
    feat, thr, length = packed
    trees, inner = feat.shape
    feat, thr, length = feat.ravel(), thr.ravel(), length.ravel()
    root, first = np.arange(trees) * inner, np.arange(trees) * (inner + 1)
    out = np.empty(len(data))
    for at in range(0, len(data), 256):
        part = np.ascontiguousarray(data[at:at + 256])
        row = (np.arange(len(part)) * part.shape[1])[:, None]
        flat, node = part.ravel(), np.zeros((len(part), trees), np.int64)
        for _ in range(int(math.log2(inner + 1))):
            k = node + root
            left = flat.take(feat.take(k) + row) < thr.take(k)
            node = 2 * node + 2 - left
        out[at:at + 256] = length.take(node - inner + first).mean(axis=1)
    return out


def isolation_forest_score(df: DataFrame, forest: dict, psi: int, vec_col: str, out: str = "anomaly_score") -> DataFrame:
    """Anomaly score 2^(-E[h]/c(psi)) by a vectorised pandas UDF (the forest
    is a bounded broadcast value)."""
    from pyspark.ml.functions import vector_to_array
    packed = _pack_forest(forest, int(math.ceil(math.log2(max(psi, 2)))))
    cpsi = _c(psi)

    @F.pandas_udf(T.DoubleType())
    def score(col: pd.Series) -> pd.Series:
        data = np.vstack(col.to_numpy()).astype(float) if len(col) else np.zeros((0, 1))
        if len(data) == 0:
            return pd.Series([], dtype=float)
        return pd.Series(np.power(2.0, -_path_lengths(packed, data) / cpsi))

    return df.withColumn(out, score(vector_to_array(vec_col)))


def flag_anomalies(rows: DataFrame, normal: str, id_col: str, vec_col: str, level: float = 0.95, n_trees: int = 250,
                   sample_size: int = 256, seed: int = 42) -> DataFrame:
    """I7 as used on transactions: fit on the rows where ``normal`` holds, score all rows,
    and add ``anomaly_score``, ``isolation_forest_anomaly_score`` (scaled to 0..100 by the
    normal rows' range) and ``predicted_anomaly`` (at or above the normal rows' ``level``
    quantile). Scores are computed once, into a table under the checkpoint folder."""
    forest, psi = isolation_forest_fit(rows.where(normal), id_col, vec_col, n_trees, sample_size, seed)
    scored = shared_table(isolation_forest_score(rows, forest, psi, vec_col), "forest-scores")
    fitted = exact_quantiles(scored.where(normal), "anomaly_score", [level]).select("mn", "mx", F.col("qs")[0].alias("cut")).first()
    share = minmax_normalize(F.col("anomaly_score"), F.lit(fitted["mn"]), F.lit(fitted["mx"]))
    return scored.withColumns({"isolation_forest_anomaly_score": F.bround(share * 100, 0).cast("int"),
                               "predicted_anomaly": F.col("anomaly_score") >= F.lit(fitted["cut"])})


def save_model(model, path: str) -> str:
    """Persist a fitted Spark ML model / pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    """The model saved at ``path``; its class is read from the saved metadata."""
    from pyspark.ml.util import DefaultParamsReader
    spark = SparkSession.getActiveSession()
    return DefaultParamsReader.loadParamsInstance(path, spark)
