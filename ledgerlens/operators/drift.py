"""Distribution-drift monitoring in a few passes over the data.

Both frames are tagged with a ``side`` and unpivoted to a long
``(side, feature, value)`` table, so the work is one job for all numeric
features and one for all categorical features, whatever their number:

* pass 1 — quantile bin edges for every numeric feature from the reference
  side (one grouped aggregate; the result has ``n_features`` rows and is
  broadcast, its size is bounded by ``n_features * (n_bins + 1)`` numbers);
* pass 2 — grouped counts per (feature, side, bin) with partial aggregation
  before the shuffle, zero-filled from a bin grid, then PSI / TVD arithmetic
  on tiny tables.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.quantiles import exact_quantiles
from ledgerlens.session import shared_table

REFERENCE, CURRENT = "reference", "current"
ALERT_CODE = {"OK": 0, "WARN": 1, "ALERT": 2}


def alert_level(score: Column, warn: float = 0.10, alert: float = 0.25) -> Column:
    """>= alert -> ALERT, >= warn -> WARN, else OK (null -> INSUFFICIENT_DATA)."""
    return (F.when(score.isNull(), "INSUFFICIENT_DATA").when(score >= alert, "ALERT")
            .when(score >= warn, "WARN").otherwise("OK"))


def quantile_levels(n_bins: int) -> list[float]:
    """The exact ``np.linspace(0, 1, n_bins + 1)`` values (passed as literals)."""
    if n_bins < 2:
        raise ValueError("n_bins must be at least 2.")
    return [float(x) for x in np.linspace(0.0, 1.0, n_bins + 1)]


def tag_by_condition(df: DataFrame, is_reference, columns: Sequence[str]) -> DataFrame:
    """One-pass side tag when both sides come from the same table (e.g. a
    date split): no second scan and no union."""
    return df.select(F.when(is_reference, F.lit(REFERENCE)).otherwise(F.lit(CURRENT)).alias("side"), *columns)


def tag_sides(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Union the two frames with a side tag (only the needed columns)."""
    cols = list(columns)
    return (reference.select(F.lit(REFERENCE).alias("side"), *cols)
            .unionByName(current.select(F.lit(CURRENT).alias("side"), *cols)))


def numeric_long(tagged: DataFrame, features: Sequence[str]) -> DataFrame:
    """G1: (side, feature, value) with non-numeric, null and NaN values dropped."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).try_cast("double").alias("value"))
                      for f in features])
    return (tagged.select("side", F.inline(pairs))
            .where(F.col("value").isNotNull() & ~F.isnan("value")))


def categorical_long(tagged: DataFrame, features: Sequence[str]) -> DataFrame:
    """(side, feature, category) as strings, nulls dropped."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("category"))
                      for f in features])
    return tagged.select("side", F.inline(pairs)).where(F.col("category").isNotNull())


def bin_edges(long: DataFrame, n_bins: int = 10) -> DataFrame:
    """Per feature, linear-interpolated quantile edges of the reference
    side, de-duplicated; fewer than 3 distinct edges -> equal-width bins over
    [min, max] (±0.5 when constant); outer edges ±inf."""
    return _edges(exact_quantiles(long.where(F.col("side") == REFERENCE), "value", quantile_levels(n_bins), ["feature"]), n_bins)


def _edges(q: DataFrame, n_bins: int) -> DataFrame:
    """Quantile rows (feature, qs, mn, mx) -> feature, inner_edges."""
    uniq = F.array_distinct(F.col("qs"))
    lo = F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn"))
    hi = F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx"))
    step = (hi - lo) / F.lit(float(n_bins))
    linspace_inner = F.transform(F.sequence(F.lit(1), F.lit(n_bins - 1)), lambda i: i * step + lo)
    inner = F.when(F.size(uniq) >= 3, F.slice(uniq, 2, F.size(uniq) - 2)).otherwise(linspace_inner)
    return q.select("feature", inner.alias("inner_edges"))


def bin_index(value: Column, inner_edges: Column, n_bins: int) -> Column:
    """Left-closed bins: number of inner edges <= value (last bin closed,
    +inf edge). A fixed sum over the at most n_bins - 1 edge slots keeps the
    expression inside whole-stage codegen."""
    terms = [F.when(F.try_element_at(inner_edges, F.lit(i)) <= value, F.lit(1)).otherwise(F.lit(0))
             for i in range(1, n_bins)]
    return sum(terms[1:], terms[0]) if terms else F.lit(0)


def numeric_drift(reference: DataFrame, current: DataFrame, features: Sequence[str], n_bins: int = 10,
                  warn: float = 0.10, alert: float = 0.25, epsilon: float = 1e-6) -> DataFrame:
    """One row per feature present in both frames."""
    feats = [f for f in features if f in reference.columns and f in current.columns]
    long = numeric_long(tag_sides(reference, current, feats), feats)
    return numeric_drift_long(long, n_bins, warn, alert, epsilon)


def numeric_drift_long(long: DataFrame, n_bins: int = 10, warn: float = 0.10, alert: float = 0.25,
                       epsilon: float = 1e-6) -> DataFrame:
    """Three scans of the long table: sketches and moments of both sides, exact quantiles of
    both sides, and the bin counts, one row per feature with a count for each side and bin."""
    q = shared_table(exact_quantiles(long, "value", [*quantile_levels(n_bins), 0.5], ["feature", "side"],
                                     extra=[F.avg("v").alias("mean"), F.stddev_pop("v").alias("std")]), "drift-quantiles")
    edges = _edges(q.where(F.col("side") == REFERENCE).withColumn("qs", F.slice("qs", 1, n_bins + 1)), n_bins)
    binned = (long.join(F.broadcast(edges), "feature")      # features x bins numbers
              .select("feature", "side", F.size("inner_edges").alias("last"), bin_index(F.col("value"), F.col("inner_edges"), n_bins).alias("bin")))
    of = {"r": REFERENCE, "c": CURRENT}
    bins = binned.groupBy("feature").agg(F.max("last").alias("last"), *[
        F.count_if((F.col("side") == side) & (F.col("bin") == b)).alias(f"{p}{b}") for p, side in of.items() for b in range(n_bins)])
    value = {"count": F.col("n"), "mean": F.col("mean"), "std": F.col("std"), "median": F.col("qs")[n_bins + 1]}
    sides = q.groupBy("feature").agg(*[F.max(F.when(F.col("side") == side, c)).alias(f"{side}_{name}") for side in of.values() for name, c in value.items()])
    eps, zero = F.lit(epsilon), F.lit(0.0)

    def term(b: int) -> Column:
        r = F.greatest(F.col(f"r{b}") / F.col("reference_count"), eps)
        c = F.greatest(F.col(f"c{b}") / F.col("current_count"), eps)
        return F.when(F.col("last") >= b, (c - r) * F.ln(c / r)).otherwise(zero)

    # A feature without a number on one side fails the query
    psi = F.when(F.col("reference_count").isNotNull() & F.col("current_count").isNotNull(), F.greatest(zero, sum((term(b) for b in range(1, n_bins)), term(0)))) \
        .otherwise(F.raise_error("Both reference and current values must contain numeric data.").cast("double"))
    at = sides.join(F.broadcast(bins), "feature", "left").withColumn("population_stability_index", psi)  # a row per feature
    return at.select(
        F.col("feature").alias("feature_name"),
        *[F.coalesce(f"{side}_count", F.lit(0)).alias(f"{side}_count") for side in of.values()],
        *[f"{side}_{name}" for name in ("mean", "std", "median") for side in of.values()],
        "population_stability_index", alert_level(F.col("population_stability_index"), warn, alert).alias("alert_level"))


def category_proportions(long: DataFrame) -> DataFrame:
    """(feature, category, rp, cp): per-side proportions over the union of
    categories (a category missing on one side has proportion 0)."""
    counts = long.groupBy("feature", "category").agg(
        F.count_if(F.col("side") == REFERENCE).alias("rc"),
        F.count_if(F.col("side") == CURRENT).alias("cc"))
    totals = counts.groupBy("feature").agg(F.sum("rc").alias("rn"), F.sum("cc").alias("cn"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "category", "rc", "cc", "rn", "cn",
        (F.col("rc") / F.col("rn")).alias("rp"), (F.col("cc") / F.col("cn")).alias("cp"))


def categorical_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
                      warn: float = 0.10, alert: float = 0.25, changed_threshold: float = 0.05) -> DataFrame:
    """Total variation distance and number of moved categories."""
    feats = [f for f in features if f in reference.columns and f in current.columns]
    long = categorical_long(tag_sides(reference, current, feats), feats)
    return categorical_drift_long(long, warn, alert, changed_threshold)


def categorical_drift_long(long: DataFrame, warn: float = 0.10, alert: float = 0.25,
                           changed_threshold: float = 0.05) -> DataFrame:
    p = category_proportions(long)
    diff = F.abs(F.col("rp") - F.col("cp"))
    agg = p.groupBy("feature").agg(
        F.max("rn").alias("reference_count"), F.max("cn").alias("current_count"),
        (F.lit(0.5) * F.sum(diff)).alias("tvd"),
        F.count_if(diff > changed_threshold).alias("changed_categories"))
    tvd = F.when((F.col("reference_count") > 0) & (F.col("current_count") > 0), F.col("tvd"))
    return agg.select(F.col("feature").alias("feature_name"), "reference_count", "current_count",
                      tvd.alias("total_variation_distance"),
                      F.col("changed_categories").cast("int").alias("changed_categories"),
                      alert_level(tvd, warn, alert).alias("alert_level"))


def distribution(long: DataFrame) -> DataFrame:
    """Normalised value counts per (feature, side), long format sorted by key."""
    counts = long.groupBy("feature", "side", "category").agg(F.count(F.lit(1)).alias("c"))
    tot = counts.groupBy("feature", "side").agg(F.sum("c").alias("n"))
    return (counts.join(F.broadcast(tot), ["feature", "side"])
            .select("feature", "side", "category", (F.col("c") / F.col("n")).alias("proportion"))
            .orderBy("feature", "side", "category"))


def decision_drift(reference: DataFrame, current: DataFrame, decision_column: str = "final_decision",
                   warn: float = 0.10, alert: float = 0.25) -> DataFrame:
    """TVD of the decision column (distributions via :func:`distribution`)."""
    long = categorical_long(tag_sides(reference, current, [decision_column]), [decision_column])
    d = categorical_drift_long(long, warn, alert)
    return d.select(F.col("feature_name").alias("decision_column"), "reference_count", "current_count",
                    "total_variation_distance", "alert_level")


def monitoring_report(numeric: DataFrame, categorical: DataFrame, decision: DataFrame | None) -> DataFrame:
    """Overall alert (max of OK < WARN < ALERT), alert and
    warning counts and the summary sentence, as one row computed from the
    per-feature result tables (tiny)."""
    rows = (numeric.select(F.lit("numeric").alias("kind"), "feature_name", "alert_level")
            .unionByName(categorical.select(F.lit("categorical").alias("kind"), "feature_name", "alert_level")))
    if decision is not None:
        rows = rows.unionByName(decision.select(F.lit("decision").alias("kind"),
                                                F.col("decision_column").alias("feature_name"), "alert_level"))
    code = (F.when(F.col("alert_level") == "ALERT", 2).when(F.col("alert_level") == "WARN", 1).otherwise(0))
    agg = rows.agg(
        F.coalesce(F.max(code), F.lit(0)).alias("_code"),
        F.count_if(F.col("alert_level") == "ALERT").alias("alert_count"),
        F.count_if(F.col("alert_level") == "WARN").alias("warning_count"),
        F.count_if(F.col("kind") == "numeric").alias("numeric_checked"),
        F.count_if(F.col("kind") == "categorical").alias("categorical_checked"))
    overall = F.when(F.col("_code") == 2, "ALERT").when(F.col("_code") == 1, "WARN").otherwise("OK")
    summary = F.format_string(
        "Monitoring report completed with overall status %s. Alerts: %d. Warnings: %d. "
        "Numeric features checked: %d. Categorical features checked: %d.",
        overall, F.col("alert_count"), F.col("warning_count"), F.col("numeric_checked"),
        F.col("categorical_checked"))
    return agg.select(overall.alias("overall_alert_level"), "alert_count", "warning_count",
                      "numeric_checked", "categorical_checked", summary.alias("summary"))


def monitoring_frames(reference: DataFrame, current: DataFrame, numeric_features: Sequence[str],
                      categorical_features: Sequence[str], decision_column: str | None = "final_decision",
                      n_bins: int = 10) -> dict[str, DataFrame]:
    """The four report tables (write them with ``commit_report_set``)."""
    both = lambda features: [f for f in features if f in reference.columns and f in current.columns]
    numeric, categorical = both(numeric_features), both(categorical_features)
    decision = (both([decision_column]) if decision_column else [None])[:1] or [None]
    used = list(dict.fromkeys([*numeric, *categorical, *[d for d in decision if d]]))
    return monitoring_frames_tagged(tag_sides(reference, current, used), numeric, categorical, decision[0], n_bins)


def monitoring_frames_tagged(tagged: DataFrame, numeric_features: Sequence[str], categorical_features: Sequence[str],
                             decision_column: str | None = None, n_bins: int = 10) -> dict[str, DataFrame]:
    """The report tables of one frame whose rows name their ``side``. The per-feature tables
    are computed once and kept (a few rows); categories and decisions share one scan."""
    num = shared_table(numeric_drift_long(numeric_long(tagged, numeric_features), n_bins), "numeric-drift")
    named = [*categorical_features, *([decision_column] if decision_column else [])]
    moved = shared_table(categorical_drift_long(categorical_long(tagged, list(dict.fromkeys(named)))), "categorical-drift")
    cat, dec = moved.where(F.col("feature_name").isin(list(categorical_features))), None
    if decision_column:
        dec = moved.where(F.col("feature_name") == decision_column).select(
            F.col("feature_name").alias("decision_column"), "reference_count", "current_count", "total_variation_distance", "alert_level")
    frames = {"numeric_drift": num, "categorical_drift": cat, "summary": monitoring_report(num, cat, dec)}
    return frames | ({} if dec is None else {"decision_drift": dec})


def windowed_numeric_drift(reference: DataFrame, current: DataFrame, features: Sequence[str],
                           window_col: str, n_bins: int = 10, warn: float = 0.10, alert: float = 0.25,
                           epsilon: float = 1e-6) -> DataFrame:
    """PSI of every current window (e.g. a day or an event-time window
    column) against one static reference. Edges come from the reference once
    (broadcast, bounded by features x bins); current counts are grouped by
    (window, feature, bin) in one pass, zero-filled from the bin grid."""
    feats = [f for f in features if f in reference.columns and f in current.columns]
    ref_long = numeric_long(reference.select(F.lit(REFERENCE).alias("side"), *feats), feats)
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).try_cast("double").alias("value"))
                      for f in feats])
    cur_long = (current.select(F.col(window_col).alias("window"), F.inline(pairs))
                .where(F.col("value").isNotNull() & ~F.isnan("value")))
    edges = F.broadcast(bin_edges(ref_long, n_bins))  # features x bins numbers
    ref_counts = (ref_long.join(edges, "feature")
                  .select("feature", bin_index(F.col("value"), F.col("inner_edges"), n_bins).alias("bin"))
                  .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("rc")))
    ref_n = ref_long.groupBy("feature").agg(F.count(F.lit(1)).alias("rn"))
    cur_counts = (cur_long.join(edges, "feature")
                  .select("window", "feature", bin_index(F.col("value"), F.col("inner_edges"), n_bins).alias("bin"))
                  .groupBy("window", "feature", "bin").agg(F.count(F.lit(1)).alias("cc")))
    cur_n = cur_long.groupBy("window", "feature").agg(F.count(F.lit(1)).alias("cn"))
    grid = (cur_n.join(edges, "feature")
            .select("window", "feature", "cn", F.explode(F.sequence(F.lit(0), F.size("inner_edges"))).alias("bin")))
    eps = F.lit(epsilon)
    props = (grid.join(cur_counts, ["window", "feature", "bin"], "left")
             .join(F.broadcast(ref_counts), ["feature", "bin"], "left")
             .join(F.broadcast(ref_n), "feature")
             .select("window", "feature", "cn",
                     F.greatest(F.coalesce("rc", F.lit(0)) / F.col("rn"), eps).alias("rp"),
                     F.greatest(F.coalesce("cc", F.lit(0)) / F.col("cn"), eps).alias("cp")))
    psi = props.groupBy("window", "feature").agg(
        F.max("cn").alias("current_count"),
        F.greatest(F.lit(0.0), F.sum((F.col("cp") - F.col("rp")) * F.ln(F.col("cp") / F.col("rp")))).alias("psi"))
    return psi.select("window", F.col("feature").alias("feature_name"), "current_count",
                      F.col("psi").alias("population_stability_index"),
                      alert_level(F.col("psi"), warn, alert).alias("alert_level"))


def monitoring_summary_text(frames: dict) -> DataFrame:
    """The multi-line summary, from the (tiny, per-feature) report tables."""
    num, cat, summ = frames["numeric_drift"], frames["categorical_drift"], frames["summary"]
    rows = num.select(F.lit(0).alias("kind"), "feature_name", "alert_level").unionByName(cat.select(F.lit(1).alias("kind"), "feature_name", "alert_level"))

    def named(level: str) -> Column:
        """Numeric features first, by name (a few features)."""
        hit = F.sort_array(F.collect_list(F.when(F.col("alert_level") == level, F.struct("kind", "feature_name"))))
        return F.array_join(F.transform(hit, lambda x: x["feature_name"]), ", ")

    names = rows.agg(named("ALERT").alias("al"), named("WARN").alias("wa"))
    dec = frames.get("decision_drift")
    # single values from the tiny tables as scalar subqueries (no join needed)
    base = summ.withColumns({
        "al": names.select("al").scalar(), "wa": names.select("wa").scalar(),
        "_tvd": dec.select("total_variation_distance").scalar() if dec is not None else F.lit(None).cast("double"),
        "_dal": dec.select("alert_level").scalar() if dec is not None else F.lit(None).cast("string"),
    })
    lines = F.concat_ws(
        "\n",
        F.lit("Model monitoring summary:"),
        F.concat(F.lit("- Overall status: "), F.col("overall_alert_level")),
        F.concat(F.lit("- Numeric features checked: "), F.col("numeric_checked").cast("string")),
        F.concat(F.lit("- Categorical features checked: "), F.col("categorical_checked").cast("string")),
        F.when(F.col("_tvd").isNotNull(), F.concat(F.lit("- Decision distribution drift: "),
                                                   F.format_string("%.4f", F.col("_tvd")),
                                                   F.lit(" ("), F.col("_dal"), F.lit(")"))),
        F.when(F.col("al") != "", F.concat(F.lit("- Alert features: "), F.col("al"))),
        F.when(F.col("wa") != "", F.concat(F.lit("- Warning features: "), F.col("wa"))),
        F.when((F.col("al") == "") & (F.col("wa") == "") & (F.col("_dal").isNull() | (F.col("_dal") == "OK")),
               F.lit("- No major drift detected.")))
    return base.select(F.col("overall_alert_level"), lines.alias("summary_text"))
