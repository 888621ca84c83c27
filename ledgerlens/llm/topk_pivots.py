"""Exact top-k search by inner product with pivot-table elimination.

Vectors are turned into integers, floor(scale * x). Distances from every vector
to ``n_pivots`` pivots are computed once in its block (the pivot table). For a
query q and a candidate c the largest |d(q, p) - d(c, p)| over the pivots is a
lower bound of their distance, so (|q|^2 + |c|^2 - bound^2) / 2 is an upper bound
of their inner product. Candidates are evaluated in the order of that bound until
the k-th best score so far is above every bound left; that is exact.

The stated query set meets all rows in blocks: queries and candidates are dealt
into blocks of bounded size by a hash, and each pair of blocks is one group of a
cogrouped map that returns k rows per query at most. Pivots are a bounded sample
(smallest hashes of the ids); any choice gives the same result.

Defined cases: vectors that are null or hold null or non-finite components take
no part; vectors of different lengths are never compared; empty vectors score 0
with one another; ties go to the smaller id; repeated ids are rows of their own
as candidates except for a query of that id; null ids take no part; an empty
table = an empty result."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import written

SCALE = 1024
TOP = 10
EVERY = 100
PIVOTS = 24
BLOCK = 8192
QUERY_BLOCK = 1024
STEP = 64  # candidates evaluated at a time


def quantized(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id long, v array<long>) of the vectors that take part."""
    whole = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("x"))
    return (rows.filter(F.col("x").isNotNull() & F.col("id").isNotNull() & whole)
            .select("id", F.transform("x", lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v")))


def best_in_block(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, pivots: np.ndarray, k: int) -> tuple[list, int]:
    """The k best candidates of a block for each query -> ([(query, id, score)], scores evaluated)."""
    norm = lambda m: np.einsum("ij,ij->i", m, m)
    qn, cn, pn = norm(q), norm(c), norm(pivots)
    far = lambda m, n: np.sqrt(np.maximum(n[:, None] + pn[None, :] - 2 * (m @ pivots.T), 0).astype(np.float64))
    qp, cp = far(q, qn), far(c, cn)
    out, work = [], 0
    for i in range(len(q)):
        low = np.zeros(len(c))
        for p in range(len(pivots)):
            np.maximum(low, np.abs(cp[:, p] - qp[i, p]), out=low)
        low = np.maximum(low * (1 - 1e-9) - 1e-6, 0)  # safe against rounding of the roots
        bound = (qn[i] + cn - low * low) / 2
        bound[c_ids == q_ids[i]] = -np.inf
        order = np.argsort(-bound, kind="stable")
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for s in range(0, len(order), STEP):
            at = order[s:s + STEP]
            if len(scores) == k and bound[at[0]] < scores[-1]:
                break
            at = at[bound[at] > -np.inf]
            work += len(at)
            ids, scores = np.concatenate([ids, c_ids[at]]), np.concatenate([scores, c[at] @ q[i]])
            keep = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[keep], scores[keep]
        out += zip([int(q_ids[i])] * len(ids), ids.tolist(), scores.tolist(), strict=True)
    return out, work


def search(vectors: DataFrame, is_query, k: int = TOP, n_pivots: int = PIVOTS, block: int = BLOCK,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """``vectors`` (id, v array<long>); ``is_query``: Column over ``id``. Returns
    query_id, rank, vec_id, score: the k largest inner products of each query with
    all rows but those of its own id."""
    vectors = written(vectors.withColumn("dim", F.size("v")), "quantized")
    n, nq = (int(x or 0) for x in vectors.agg(F.count(F.lit(1)), F.sum(is_query.cast("long"))).first())
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-nq // query_block))
    firsts = vectors.select("dim", "v", F.xxhash64("id").alias("h")).orderBy("h").limit(n_pivots * 8).collect()
    by_dim: dict[int, list] = {}
    for r in firsts:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    pivots = {d: np.array(vs[:n_pivots], dtype=np.int64).reshape(len(vs[:n_pivots]), d) for d, vs in by_dim.items()}
    # The row's place joins the hash: many rows of one id spread over the blocks.
    cands = vectors.select("dim", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), F.lit(blocks)).alias("cb"), "id", "v",
                           F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    queries = vectors.filter(is_query).dropDuplicates(["id", "v"]).select("dim", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks)).cast("int").alias("qb"), "id", "v",
                                              F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("cb"))

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            dim = int(key[0])
            q, c = (np.stack(x["v"].to_numpy()).astype(np.int64).reshape(len(x), dim) for x in (left, right))
            p = pivots.get(dim, np.empty((0, dim), np.int64))
            found, _ = best_in_block(left["id"].to_numpy(), q, right["id"].to_numpy(), c, p, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    keys = ["dim", "qb", "cb"]
    found = queries.groupBy(*keys).cogroup(cands.groupBy(*keys)).applyInPandas(run, "query_id long, vec_id long, score long")
    top = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
