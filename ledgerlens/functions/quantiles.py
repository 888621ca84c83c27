"""Exact quantiles and running sums without a whole group in one task.

Running sums: a group's distinct values are cut into ranges by approximate
quantiles, range totals give offsets, and the sums are windows within one range.

Quantiles: a mergeable sketch brackets each level between two values, and one
more scan counts the rows between brackets and the distinct values inside them,
so only a few thousandths of the values are shuffled. The sketch decides which
rows are counted together, never a result: a rank that fell outside its bracket
would fail the query. The same path runs at every size.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import shared_table

#: A table of one row per group is broadcast up to so many rows (they are counted).
FEW_GROUPS = 100_000


def ranked_prefix_sums(d: DataFrame, keys: Sequence[str], order: str, sums: Sequence[str],
                       descending: bool = True, buckets: int = 256, few_groups: bool = True) -> DataFrame:
    """Inclusive running sums of ``sums`` over ``order`` within ``keys``,
    without a window over a whole key group (see module docstring).
    ``d`` must have one row per (keys, order) value. With ``few_groups`` the ranges' bounds
    and offsets (``buckets`` numbers a group) are broadcast."""
    keys = list(keys)
    hint = F.broadcast if few_groups else (lambda x: x)
    o = F.col(order) * (-1.0 if descending else 1.0)
    d = d.withColumn("_o", o)
    levels = [float(x) for x in np.linspace(0.0, 1.0, buckets + 1)[1:-1]]
    bounds = d.groupBy(*keys).agg(F.percentile_approx("_o", levels, 10000).alias("_b"))
    d = (d.join(hint(bounds), keys)
         .withColumn("_bucket", F.size(F.filter(F.col("_b"), lambda b: b < F.col("_o")))).drop("_b"))
    totals = d.groupBy(*keys, "_bucket").agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    w_tot = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_bucket", *[F.coalesce(F.sum(f"_t_{s}").over(w_tot), F.lit(0))
                                                .alias(f"_off_{s}") for s in sums])
    w_in = Window.partitionBy(*keys, "_bucket").orderBy("_o").rowsBetween(Window.unboundedPreceding, 0)
    d = d.join(hint(offsets), keys + ["_bucket"])
    return d.select(*[c for c in d.columns if not c.startswith("_")],
                    *[(F.sum(s).over(w_in) + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums])


def exact_quantiles(df: DataFrame, value: str, levels: Sequence[float], groups: Sequence[str] = (),
                    buckets: int = 64, accuracy: int = 10_000, extra: Sequence[Column] = ()) -> DataFrame:
    """groups..., qs (array, linear interpolation between the two ranks around
    each level), n, mn, mx, and the aggregates ``extra`` (over the column ``v``, from the
    sketch's scan). Null values are left out; groups without values have no row. Two scans,
    whose small results (a row per group; bracket counts) are written and read again."""
    keys = list(groups) or ["_all"]
    d = df.where(F.col(value).isNotNull())
    if not groups:
        d = d.withColumn("_all", F.lit(1))
    gs = [f"g{i}" for i in range(len(keys))]
    d = d.select(*[F.col(k).alias(g) for g, k in zip(gs, keys)], F.col(value).alias("v"))
    points = sorted(set(levels))
    slack = 3.0 / accuracy                           # thrice the sketch's error
    cuts = [max(0.0, p - slack) for p in points] + [min(1.0, p + slack) for p in points]
    stats = shared_table(d.groupBy(*gs).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"), F.percentile_approx("v", cuts, accuracy).alias("cuts"), *extra), "quantile-sketch")
    n_groups = stats.limit(FEW_GROUPS + 1).count()
    hint = F.broadcast if n_groups <= FEW_GROUPS else (lambda x: x)

    m = len(points)

    def at(i: int) -> Column:
        """End of a bracket; a group of few rows, whose ranks the slack does not span, is all inside."""
        end = F.col("mn") if i < m else F.col("mx")
        return end if cuts[i] in (0.0, 1.0) else F.when(F.col("n") <= accuracy, end).otherwise(F.col("cuts")[i])

    v = F.col("v")
    inside = reduce(lambda x, y: x | y, [(v >= at(i)) & (v <= at(m + i)) for i in range(m)])
    past = sum((F.when(v > at(m + i), 1).otherwise(0) for i in range(1, m)), F.when(v > at(m), 1).otherwise(0))
    counts = shared_table(
        d.join(hint(stats.select(*gs, "n", "mn", "mx", "cuts")), gs).select(*gs, past.alias("past"), F.when(inside, v).alias("v"), v.alias("o"))
        .groupBy(*gs, "past", "v").agg(F.count(F.lit(1)).alias("c"), F.min("o").alias("o")), "quantile-brackets")
    cum = ranked_prefix_sums(counts, gs, "o", ["c"], descending=False, buckets=buckets, few_groups=n_groups * buckets <= FEW_GROUPS)
    others = [c for c in stats.columns if c not in (*gs, "cuts")]
    cum = cum.join(hint(stats.drop("cuts")), gs)     # one row per group

    def found(rank: Column) -> Column:
        return F.max(F.when((F.col("cum_c") - F.col("c") <= rank) & (rank < F.col("cum_c")), F.col("v")))

    n = F.col("n") - F.lit(1)
    aggs = []
    for k, q in enumerate(levels):
        pos = n * F.lit(float(q))
        aggs += [found(F.floor(pos)).alias(f"lo{k}"), found(F.ceil(pos)).alias(f"hi{k}")]
    per = cum.groupBy(*gs, *others).agg(*aggs)

    def level(k: int, q: float) -> Column:
        pos = n * F.lit(float(q))
        lo, hi = F.col(f"lo{k}"), F.col(f"hi{k}")
        between = (F.ceil(pos) - pos) * lo + (pos - F.floor(pos)) * hi
        exact = F.when((F.floor(pos) == F.ceil(pos)) | (lo == hi), lo).otherwise(between)
        return F.coalesce(exact, F.raise_error("a quantile fell outside its bracket").cast("double"))

    out = per.select(*[F.col(f"g{i}").alias(k) for i, k in enumerate(keys)], *others,
                     F.array(*[level(k, q) for k, q in enumerate(levels)]).alias("qs"))
    return out if groups else out.drop("_all")
