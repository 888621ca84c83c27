"""Connected components of an edge table by alternating large-star and
small-star rounds (Kiveris et al., 2014), as joins and grouped minima.

Nodes are longs. A star's centre may hold a third of all edges: minima are
partially aggregated before the shuffle and the joins are plain equi-joins,
which adaptive execution splits when a key is hot. Every round is written to
the shared checkpoint folder, so lineage stays short."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import written


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b") % 1_000_003)).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lows = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(lows, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    lows = edges.groupBy("a").agg(F.min("b").alias("m"))
    rest = edges.join(lows, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.unionByName(lows.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node that has an edge to another node; ``root`` is
    the smallest node reachable. Self-edges, nulls, repeated and reversed edges
    are allowed; an empty table gives an empty result."""
    e = (edges.select(F.greatest(left, right).cast("long").alias("a"), F.least(left, right).cast("long").alias("b"))
         .filter(F.col(left).isNotNull() & F.col(right).isNotNull()).filter("a > b").distinct())
    e = written(e, "edges")
    state = _state(e)
    while state[0]:
        e = written(_small_star(_large_star(e)), "edges")
        state, before = _state(e), state
        if state == before:
            break
    roots = e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Within a task: merge the classes of linked places ``a[i]``, ``b[i]``. ``labels``
    holds for each place the smallest place known of its class."""
    while len(a):
        la, lb = labels[a], labels[b]
        differ = la != lb
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        if not len(a):
            break
        to = np.arange(len(labels))
        np.minimum.at(to, la, lb)
        np.minimum.at(to, lb, la)
        while not np.array_equal(to, to[to]):
            to = to[to]
        labels = to[labels]
    return labels
