"""Registered drift queries (G): F1 decisions split at a date, plus the
larger lineitem twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import drift as G
from ledgerlens.plans import decisions as D
from ledgerlens.plans.registry import register
from ledgerlens.plans.sql_twins import FINAL_CTE, with_
from ledgerlens.sources.fixtures import DRIFT_CUT
from ledgerlens.sources.tables import read_table

N_BINS = 10
NUMERIC = ["amount", "tx_count_2min", "merchant_risk_score"]
CATEGORICAL = ["risk_type"]
DECISION = "final_action"
LI_NUMERIC = ["l_quantity", "l_discount", "l_extendedprice"]
LI_CATEGORICAL = ["l_returnflag", "l_linestatus"]


def _li_tagged(spark, sf, features):
    """Both sides from one scan; rows without a date are on neither."""
    li = read_table(spark, sf, "lineitem").where(F.col("l_shipdate").isNotNull())
    return G.tag_by_condition(li, F.col("l_shipdate") < F.lit(DRIFT_CUT).cast("timestamp_ntz"), features)


def _lit(x: float) -> str:
    return f"'{x!r}'::DOUBLE"


def _drift_sql(src_cte: str, ts: str, numeric, categorical, source: str) -> str:
    """DuckDB twin: tagged long tables, quantile edges, bin counts, PSI/TVD."""
    levels = ", ".join(_lit(q) for q in G.quantile_levels(N_BINS))
    num_union = "\n  UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM src" for f in numeric)
    cat_union = "\n  UNION ALL ".join(
        f"SELECT side, '{f}' AS feature, CAST({f} AS VARCHAR) AS category FROM src" for f in categorical)
    return src_cte + f""",
src AS (SELECT CASE WHEN {ts} < TIMESTAMP '{DRIFT_CUT}' THEN 'reference' ELSE 'current' END AS side, * FROM {source}),
nl AS (SELECT * FROM ({num_union}) WHERE value IS NOT NULL AND NOT isnan(value)),
cl AS (SELECT * FROM ({cat_union}) WHERE category IS NOT NULL),
q AS (SELECT feature, quantile_cont(value, [{levels}]) AS qs, min(value) AS mn, max(value) AS mx
      FROM nl WHERE side = 'reference' GROUP BY feature),
q2 AS (SELECT *, list_sort(list_distinct(qs)) AS uq,
         CASE WHEN mn = mx THEN mn - 0.5e0 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5e0 ELSE mx END AS hi FROM q),
e AS (SELECT feature, CASE WHEN len(uq) >= 3 THEN uq[2:len(uq) - 1]
         ELSE list_transform(range(1, {N_BINS}), lambda i: i * ((hi - lo) / {N_BINS}e0) + lo) END AS inner_edges FROM q2),
cnt AS (SELECT nl.feature, side, len(list_filter(e.inner_edges, lambda x: x <= nl.value)) AS bin, count(*) AS c
        FROM nl JOIN e ON nl.feature = e.feature GROUP BY ALL),
st AS (SELECT feature, side, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS std,
        quantile_cont(value, 0.5) AS median FROM nl GROUP BY ALL),
grid AS (SELECT feature, unnest(range(0, len(inner_edges) + 1)) AS bin FROM e),
pr AS (SELECT g.feature,
         greatest(coalesce(r.c, 0) / CAST(rn.n AS DOUBLE), 1e-6) AS rp,
         greatest(coalesce(c.c, 0) / CAST(cn.n AS DOUBLE), 1e-6) AS cp
       FROM grid g
       LEFT JOIN cnt r ON r.feature = g.feature AND r.bin = g.bin AND r.side = 'reference'
       LEFT JOIN cnt c ON c.feature = g.feature AND c.bin = g.bin AND c.side = 'current'
       LEFT JOIN st rn ON rn.feature = g.feature AND rn.side = 'reference'
       LEFT JOIN st cn ON cn.feature = g.feature AND cn.side = 'current'),
psi AS (SELECT feature, greatest(0e0, sum((cp - rp) * ln(cp / rp))) AS psi FROM pr GROUP BY feature),
num AS (SELECT r.feature AS feature_name, r.n AS reference_count, c.n AS current_count,
          r.mean AS reference_mean, c.mean AS current_mean, r.std AS reference_std, c.std AS current_std,
          r.median AS reference_median, c.median AS current_median, p.psi AS population_stability_index,
          CASE WHEN p.psi >= 0.25 THEN 'ALERT' WHEN p.psi >= 0.10 THEN 'WARN' ELSE 'OK' END AS alert_level
        FROM st r JOIN st c ON r.feature = c.feature AND r.side = 'reference' AND c.side = 'current'
        JOIN psi p ON p.feature = r.feature),
cc AS (SELECT feature, category, count_if(side = 'reference') AS rc, count_if(side = 'current') AS cc FROM cl GROUP BY ALL),
ct AS (SELECT feature, sum(rc) AS rn, sum(cc) AS cn FROM cc GROUP BY feature),
cp AS (SELECT cc.feature, category, rc / CAST(rn AS DOUBLE) AS rp, cc / CAST(cn AS DOUBLE) AS cp, rn, cn
       FROM cc JOIN ct ON cc.feature = ct.feature),
cat AS (SELECT feature AS feature_name, CAST(max(rn) AS BIGINT) AS reference_count, CAST(max(cn) AS BIGINT) AS current_count,
          0.5e0 * sum(abs(rp - cp)) AS total_variation_distance,
          CAST(count_if(abs(rp - cp) > 0.05e0) AS INTEGER) AS changed_categories
        FROM cp GROUP BY feature),
catd AS (SELECT *, CASE WHEN total_variation_distance >= 0.25 THEN 'ALERT' WHEN total_variation_distance >= 0.10
                        THEN 'WARN' ELSE 'OK' END AS alert_level FROM cat)"""


R9 = 9


def _round_num(df):
    cols = ["reference_mean", "current_mean", "reference_std", "current_std", "reference_median",
            "current_median", "population_stability_index"]
    return df.withColumns({c: F.bround(c, R9) for c in cols})


_NUM_SELECT = f"""SELECT feature_name, reference_count, current_count,
  round_even(reference_mean, {R9}) AS reference_mean, round_even(current_mean, {R9}) AS current_mean,
  round_even(reference_std, {R9}) AS reference_std, round_even(current_std, {R9}) AS current_std,
  round_even(reference_median, {R9}) AS reference_median, round_even(current_median, {R9}) AS current_median,
  round_even(population_stability_index, {R9}) AS population_stability_index, alert_level FROM num"""

DRIFT_CTE = _drift_sql(FINAL_CTE, "timestamp", NUMERIC, CATEGORICAL + [DECISION], "final")
LI_CTE = _drift_sql("li0 AS (SELECT * FROM lineitem)", "l_shipdate", LI_NUMERIC, LI_CATEGORICAL, "li0")


def _tagged(spark, sf, features):
    """Both sides from one pass (date split as a tag): over the transactions, or over
    the decision flow when a feature is made by it."""
    plain = D.transactions(spark, sf)
    final = plain if set(features) <= set(plain.columns) else D.final_decisions(spark, sf)
    cut = F.lit(DRIFT_CUT).cast("timestamp_ntz")
    return G.tag_by_condition(final, F.col("timestamp") < cut, features)


@register("numeric_drift", with_(DRIFT_CTE, _NUM_SELECT))
def q_numeric_drift(spark, sf):
    long = G.numeric_long(_tagged(spark, sf, NUMERIC), NUMERIC)
    return _round_num(G.numeric_drift_long(long, N_BINS))


@register("psi_by_feature", with_(DRIFT_CTE, f"""SELECT feature AS feature_name,
  round_even(psi, {R9}) AS population_stability_index FROM psi"""))
def q_psi_by_feature(spark, sf):
    long = G.numeric_long(_tagged(spark, sf, NUMERIC), NUMERIC)
    return G.numeric_drift_long(long, N_BINS).select(
        "feature_name", F.bround("population_stability_index", R9).alias("population_stability_index"))


@register("categorical_drift", with_(DRIFT_CTE, f"""SELECT feature_name, reference_count, current_count,
  round_even(total_variation_distance, {R9}) AS total_variation_distance, changed_categories, alert_level
FROM catd WHERE feature_name IN ({', '.join(repr(c) for c in CATEGORICAL)})"""))
def q_categorical_drift(spark, sf):
    d = G.categorical_drift_long(G.categorical_long(_tagged(spark, sf, CATEGORICAL), CATEGORICAL))
    return d.withColumn("total_variation_distance", F.bround("total_variation_distance", R9))


@register("decision_drift", with_(DRIFT_CTE, f"""SELECT feature_name AS decision_column, reference_count, current_count,
  round_even(total_variation_distance, {R9}) AS total_variation_distance, alert_level
FROM catd WHERE feature_name = '{DECISION}'"""))
def q_decision_drift(spark, sf):
    d = G.categorical_drift_long(G.categorical_long(_tagged(spark, sf, [DECISION]), [DECISION])).select(
        F.col("feature_name").alias("decision_column"), "reference_count", "current_count", "total_variation_distance", "alert_level")
    return d.withColumn("total_variation_distance", F.bround("total_variation_distance", R9))


@register("distribution", with_(DRIFT_CTE, f"""SELECT feature, side, category,
  round_even(count(*) / CAST(sum(count(*)) OVER (PARTITION BY feature, side) AS DOUBLE), {R9}) AS proportion
FROM cl GROUP BY feature, side, category ORDER BY feature, side, category"""))
def q_distribution(spark, sf):
    feats = CATEGORICAL + [DECISION]
    long = G.categorical_long(_tagged(spark, sf, feats), feats)
    return G.distribution(long).withColumn("proportion", F.bround("proportion", R9))


@register("drift_report", with_(DRIFT_CTE, """, lv AS (
  SELECT 'numeric' AS kind, alert_level FROM num UNION ALL SELECT 'categorical', alert_level FROM catd)
SELECT CASE max(CASE alert_level WHEN 'ALERT' THEN 2 WHEN 'WARN' THEN 1 ELSE 0 END) WHEN 2 THEN 'ALERT' WHEN 1 THEN 'WARN'
  ELSE 'OK' END AS overall_alert_level,
  count_if(alert_level = 'ALERT') AS alert_count, count_if(alert_level = 'WARN') AS warning_count,
  count_if(kind = 'numeric') AS numeric_checked, count_if(kind = 'categorical') - 1 AS categorical_checked
FROM lv""".lstrip()))
def q_drift_report(spark, sf):
    return report_frames(spark, sf)["summary"].drop("summary")


def report_frames(spark, sf):
    tagged = _tagged(spark, sf, [*NUMERIC, *CATEGORICAL, DECISION])
    return G.monitoring_frames_tagged(tagged, NUMERIC, CATEGORICAL, DECISION, N_BINS)


@register("lineitem_numeric_drift", with_(LI_CTE, _NUM_SELECT))
def q_lineitem_numeric_drift(spark, sf):
    return _round_num(G.numeric_drift_long(G.numeric_long(_li_tagged(spark, sf, LI_NUMERIC), LI_NUMERIC), N_BINS))


@register("lineitem_categorical_drift", with_(LI_CTE, f"""SELECT feature_name, reference_count, current_count,
  round_even(total_variation_distance, {R9}) AS total_variation_distance, changed_categories, alert_level FROM catd"""))
def q_lineitem_categorical_drift(spark, sf):
    d = G.categorical_drift_long(G.categorical_long(_li_tagged(spark, sf, LI_CATEGORICAL), LI_CATEGORICAL))
    return d.withColumn("total_variation_distance", F.bround("total_variation_distance", R9))


WIN_CUT = "1996-01-01"


def windowed_drift_sql(window: str, kind: str) -> str:
    """Twin of a windowed drift: PSI of every window of shipments against those before ``WIN_CUT``."""
    return f"""WITH src AS (SELECT * FROM lineitem),
nl AS (SELECT * FROM ({' UNION ALL '.join(f"SELECT CASE WHEN l_shipdate < TIMESTAMP '{WIN_CUT}' THEN NULL ELSE {window} END AS w, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM src" for f in LI_NUMERIC)})
      WHERE value IS NOT NULL AND NOT isnan(value)),
q AS (SELECT feature, quantile_cont(value, [{', '.join(_lit(q) for q in G.quantile_levels(N_BINS))}]) AS qs, min(value) AS mn, max(value) AS mx
      FROM nl WHERE w IS NULL GROUP BY feature),
q2 AS (SELECT *, list_sort(list_distinct(qs)) AS uq,
         CASE WHEN mn = mx THEN mn - 0.5e0 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5e0 ELSE mx END AS hi FROM q),
e AS (SELECT feature, CASE WHEN len(uq) >= 3 THEN uq[2:len(uq) - 1]
         ELSE list_transform(range(1, {N_BINS}), lambda i: i * ((hi - lo) / {N_BINS}e0) + lo) END AS inner_edges FROM q2),
b AS (SELECT w, nl.feature, len(list_filter(e.inner_edges, lambda x: x <= nl.value)) AS bin FROM nl JOIN e ON nl.feature = e.feature),
rc AS (SELECT feature, bin, count(*) AS c FROM b WHERE w IS NULL GROUP BY ALL),
rn AS (SELECT feature, count(*) AS n FROM b WHERE w IS NULL GROUP BY ALL),
cc AS (SELECT w, feature, bin, count(*) AS c FROM b WHERE w IS NOT NULL GROUP BY ALL),
cn AS (SELECT w, feature, count(*) AS n FROM b WHERE w IS NOT NULL GROUP BY ALL),
grid AS (SELECT cn.w, cn.feature, cn.n, unnest(range(0, len(e.inner_edges) + 1)) AS bin FROM cn JOIN e ON cn.feature = e.feature),
pr AS (SELECT g.w, g.feature, g.n,
         greatest(coalesce(r.c, 0) / CAST(rn.n AS DOUBLE), 1e-6) AS rp, greatest(coalesce(c.c, 0) / CAST(g.n AS DOUBLE), 1e-6) AS cp
       FROM grid g LEFT JOIN cc c ON c.w = g.w AND c.feature = g.feature AND c.bin = g.bin
       LEFT JOIN rc r ON r.feature = g.feature AND r.bin = g.bin JOIN rn ON rn.feature = g.feature)
SELECT CAST(w AS {kind}) AS window, feature AS feature_name, max(n) AS current_count,
  round_even(greatest(0e0, sum((cp - rp) * ln(cp / rp))), {R9}) AS population_stability_index
FROM pr GROUP BY w, feature"""


@register("windowed_drift", windowed_drift_sql("year(l_shipdate)", "INTEGER"))
def q_windowed_drift(spark, sf):
    """Lineitem PSI per shipping year against the rows shipped before 1996."""
    li = read_table(spark, sf, "lineitem")
    cut = F.lit(WIN_CUT).cast("timestamp_ntz")
    ref = li.where(F.col("l_shipdate") < cut)
    cur = li.where(F.col("l_shipdate") >= cut).withColumn("ship_year", F.year("l_shipdate"))
    d = G.windowed_numeric_drift(ref, cur, LI_NUMERIC, "ship_year", N_BINS)
    return d.select("window", "feature_name", "current_count",
                    F.bround("population_stability_index", R9).alias("population_stability_index"))
