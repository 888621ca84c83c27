"""Mixing sources to target weights.

Each source gets a target of words from its weight (water filling under a cap
on repeats). Within a source, documents take hash-random keys; the source is
read in key order, whole passes first (epochs), and the last pass is cut at the
exact budget. Keys are uniform, so their first hex digits are range partitions:
prefix sums run over partition totals first, and only the one partition per
source that holds the cut is sorted. A source with a third of all rows is
spread over all partitions like any other.

Defined cases: null text = size 0, never taken words; null source = a source of
its own, last in order; null doc_id hashes as the empty string; rows of one key
(repeated ids) share the words left at the cut in proportion to their sizes; a
source without words has target 0; an empty table gives an empty result;
further columns are ignored."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import small, words_in, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2
PREFIX = 3  # hex digits: 4096 ranges of keys per source


def order_key(doc_id: Column, seed: int = 0) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))


def source_targets(totals: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> + target. Sources by code point, null last, weigh
    ``weights`` in turn; capped targets give their excess to the rest by weight.
    One row per source: the windows below run over that small table only."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(float(x)) for x in weights])[(F.row_number().over(by_name) - 1) % len(weights)]
    s = totals.select("source", "source_size", w.alias("w"), (F.col("source_size") * max_epochs).cast("double").alias("cap"))
    every = Window.partitionBy()
    s = s.select("*", (F.lit(share) * F.sum("source_size").over(every)).alias("budget"), F.sum("w").over(every).alias("wsum"))
    before = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    cap0, w0 = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    # Sorted by cap per weight, the capped sources are a prefix of the order.
    s = s.select("*", (F.col("cap") * (F.col("wsum") - w0) <= F.col("w") * (F.col("budget") - cap0)).alias("full"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0.0))
    wleft = F.col("wsum") - F.coalesce(F.sum(F.when(F.col("full"), F.col("w"))).over(every), F.lit(0.0))
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * left / wleft).alias("target"))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
             max_epochs: int = MAX_EPOCHS, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """-> (sized documents: doc_id, source, size, key; cuts: one row per source
    with source_size, target, epochs, cut_key, cut_left, cut_size). Documents with
    a key below ``cut_key`` are taken once more than ``epochs`` times, those with
    that key share ``cut_left`` of their ``cut_size`` words."""
    sized = written(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), order_key(F.col("doc_id"), seed).alias("key")), "mix-sized")
    part = F.substring("key", 1, PREFIX)
    ranges = written(sized.groupBy("source", part.alias("part")).agg(F.sum("size").alias("part_size")), "mix-ranges")
    totals = ranges.groupBy("source").agg(F.sum("part_size").alias("source_size"))
    t = source_targets(totals, weights, share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    t = t.withColumn("epochs", epochs.cast("long"))
    t = t.withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    t = written(t, "mix-targets")
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    # The range of keys that holds the cut.
    run = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = ranges.withColumn("upto", F.sum("part_size").over(run))
    at = (ranges.join(t, same(ranges, t)).select(ranges["source"], "part", (F.col("upto") - F.col("part_size")).alias("lo"), "upto", "rest")
          .filter((F.col("lo") <= F.col("rest")) & (F.col("rest") < F.col("upto"))))
    at = written(at, "mix-cut-ranges")
    few = small(at)
    within = (sized.join(few, same(sized, few) & (part == few["part"]))
              .groupBy(sized["source"], "key", "lo", "rest").agg(F.sum("size").alias("cut_size")))
    keyed = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = within.withColumn("lo", F.col("lo") + F.sum("cut_size").over(keyed) - F.col("cut_size"))
    cut = (within.filter((F.col("lo") <= F.col("rest")) & (F.col("rest") < F.col("lo") + F.col("cut_size")))
           .select("source", F.col("key").alias("cut_key"), (F.col("rest") - F.col("lo")).alias("cut_left"), "cut_size"))
    cuts = t.join(cut, same(t, cut), "left").select(t["source"], "source_size", "target", "epochs", "cut_key", "cut_left", "cut_size")
    return sized, written(cuts, "mix-cuts")


def take(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows with source, size and key -> + source_size, target, taken (words), copies
    (whole documents: a cut document counts when at least half of it is taken)."""
    c = small(cuts)
    out = rows.join(c, rows["source"].eqNullSafe(c["source"])).drop(c["source"])
    below, at = F.coalesce(F.col("key") < F.col("cut_key"), F.lit(False)), F.coalesce(F.col("key") == F.col("cut_key"), F.lit(False))
    more = F.when(below, F.col("size")).when(at, F.expr("(size * cut_left) div cut_size")).otherwise(F.lit(0))
    again = F.when(below | (at & (F.col("cut_left") * 2 >= F.col("cut_size"))), 1).otherwise(0)
    return (out.withColumn("taken", (F.col("epochs") * F.col("size") + more).cast("long"))
            .withColumn("copies", (F.col("epochs") + again).cast("int"))
            .drop("epochs", "cut_key", "cut_left", "cut_size"))


def mix(docs: DataFrame, **params) -> DataFrame:
    """doc_id, source, size, key, source_size, target, taken, copies per document."""
    sized, cuts = mix_plan(docs, **params)
    return take(sized, cuts)


def mix_documents(docs: DataFrame, seed: int = 0, **params) -> DataFrame:
    """The mixed corpus itself: every document as often as the mix takes it (whole
    documents), with the input's columns."""
    _, cuts = mix_plan(docs, seed=seed, **params)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)  # own names, so that no column of the input can clash
    at = {c: F.col(n) for c, n in zip(docs.columns, names, strict=True)}
    rows = plain.select("*", at["source"].alias("source"), words_in(at["text"]).alias("size"), order_key(at["doc_id"], seed).alias("key"))
    out = take(rows, cuts).filter("copies > 0")
    out = out.select(*names, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
