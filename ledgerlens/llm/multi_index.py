"""Embedding near-duplicates by an inverted multi-index.

Unit vectors are cut into two halves, each with a codebook of its own (k-means
on a bounded sample); the product of the codebooks is a grid of cells, and
every vector lies in one cell. A vector visits cells in the order of a
multi-sequence traversal: by rising sum of the two halves' squared distances to
the cells' borders, up to the radius at which the target recall is reached. That
radius is calibrated for the hardest links, those right at the threshold: sampled
vectors are moved to exactly that cosine, once in random directions and once
towards other sampled vectors of their label (along which the data vary and the
cells' borders lie), and the radius is the larger quantile of the sums of the cells
they land in. A link is found when either
end visits the other's cell, and each found pair is verified by its cosine in
double precision. Labels keep their own lists: only equal, non-null labels meet.

Exact copies (same label, same components) are one node with a count. Cells are
dealt by (label, length, first-half cell); lists longer than ``block`` are split
on both sides into blocks, so a cell with a third of all rows is many bounded
tasks. Within a task links become counts and a spanning forest, never pairs.

Defined cases: vectors that are null, zero, hold null or non-finite components or
have a null label link with nothing; lengths must be equal to link; vectors
shorter than two components form one cell per half; null ids: kept as rows,
linked by nothing; an empty table = an empty result; further columns ignored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import small, written
from ledgerlens.llm.components import connected_components, merge_labels

THRESHOLD = 0.93
TARGET_RECALL = 0.995
SAMPLE = 16_384   # vectors for codebooks and calibration, by hash of the id
PER_CELL = 8      # wished vectors per cell of one label
MAX_CODES = 256
BLOCK = 4096


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    k = min(k, len(x))
    codes = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        at = nearest(x, codes)
        sums, n = np.zeros_like(codes), np.bincount(at, minlength=k)
        np.add.at(sums, at, x)
        codes[n > 0] = sums[n > 0] / n[n > 0, None]
    return np.unique(codes, axis=0)


def nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return np.argmin((codes * codes).sum(1)[None, :] - 2 * x @ codes.T, axis=1)


class MultiIndex:
    """Two codebooks and the traversal radius for one vector length."""

    def __init__(self, x: np.ndarray, codes: int, threshold: float, target_recall: float, seed: int = 11, labels: np.ndarray | None = None):
        self.cut = x.shape[1] // 2
        self.books = [kmeans(h, codes, seed=seed + i) if h.shape[1] else np.zeros((1, 0)) for i, h in enumerate(self.halves(x))]
        self.gaps = [np.maximum(np.sqrt(np.maximum(((b[:, None] - b[None]) ** 2).sum(2), 0)), 1e-12) for b in self.books]
        rng = np.random.default_rng(seed)
        b1, b2 = self.borders(x)
        radii = [0.0]
        for way in (rng.standard_normal(x.shape), x[self.partners(len(x), labels, rng)] - x):
            way = way - (way * x).sum(1, keepdims=True) * x
            size = np.linalg.norm(way, axis=1)
            at = np.flatnonzero(size > 1e-9)  # a vector may have no other to move to
            if len(at):
                i, j = self.cells(threshold * x[at] + np.sqrt(max(0.0, 1 - threshold ** 2)) * way[at] / size[at, None])
                radii.append(float(np.quantile(b1[at, i] + b2[at, j], target_recall)))
        self.radius = max(radii) + 1e-9

    @staticmethod
    def partners(n: int, labels: np.ndarray | None, rng: np.random.Generator) -> np.ndarray:
        """For each vector another one of its label (itself when it is alone)."""
        order = rng.permutation(n)
        kinds = np.zeros(n, int) if labels is None else np.unique(labels, return_inverse=True)[1]
        order = order[np.argsort(kinds[order], kind="stable")]
        out = np.empty(n, int)
        for own in np.split(order, np.flatnonzero(np.diff(kinds[order])) + 1):
            out[own] = np.roll(own, 1)
        return out

    def halves(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, :self.cut], x[:, self.cut:]]

    def cells(self, x: np.ndarray) -> list[np.ndarray]:
        return [nearest(h, b) for h, b in zip(self.halves(x), self.books, strict=True)]

    def borders(self, x: np.ndarray) -> list[np.ndarray]:
        """Per half: squared distance of each vector to each cell (0 for its own),
        bounded from below by the border with its own cell."""
        out = []
        for h, b, gap in zip(self.halves(x), self.books, self.gaps, strict=True):
            d = np.maximum((h * h).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * h @ b.T, 0)
            own = np.argmin(d, axis=1)
            over = np.maximum(d - d[np.arange(len(h)), own][:, None], 0) / (2 * gap[own])
            out.append(over * over)
        return out


def _unit(vs) -> np.ndarray:
    x = np.stack([np.asarray(v, dtype=np.float64) for v in vs])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _visits(book: MultiIndex, x: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Own cells and, per half, border distances."""
    return book.cells(x), book.borders(x)


def link_block(book: MultiIndex, threshold: float, first: int, r: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
    """Residents of first-half cell ``first`` against the vectors that visit it:
    rows (node, other, n): n copies of other vectors that ``node`` links to, with
    ``other`` in the same component (null when only the count matters)."""
    rx, px = _unit(r["v"]), _unit(p["v"])
    rid, pid, rn, pn = (d[c].to_numpy(np.int64) for d, c in ((r, "id"), (p, "id"), (r, "n"), (p, "n")))
    (_, rj), (rb1, rb2) = _visits(book, rx)
    (pi, pj), (pb1, pb2) = _visits(book, px)
    width = len(book.books[1])
    pcell = pi * width + pj
    rcount, pcount = np.zeros(len(r), np.int64), np.zeros(len(p), np.int64)
    ids = np.unique(np.concatenate([rid, pid]))
    rat, pat = np.searchsorted(ids, rid), np.searchsorted(ids, pid)
    labels = np.arange(len(ids))
    order = np.argsort(rj, kind="stable")
    starts = np.searchsorted(rj[order], np.arange(width + 1))
    for j in range(width):
        at = order[starts[j]:starts[j + 1]]
        if not len(at):
            continue
        who = np.flatnonzero(pb1[:, first] + pb2[:, j] <= book.radius)
        for s in range(0, len(who), 1024):
            w = who[s:s + 1024]
            a, b = np.nonzero(px[w] @ rx[at].T >= threshold)
            a, b = w[a], at[b]
            here = first * width + j
            # A pair counts once: within a cell from its smaller id; between cells from
            # the lower cell, or from the higher one when the lower does not visit it.
            back = rb1[b, pi[a]] + rb2[b, pj[a]] <= book.radius
            once = np.where(pcell[a] == here, pid[a] < rid[b], (pcell[a] < here) | ~back)
            a, b = a[once], b[once]
            np.add.at(pcount, a, rn[b])
            np.add.at(rcount, b, pn[a])
            labels = merge_labels(labels, pat[a], rat[b])
    hit_r, hit_p = np.flatnonzero(rcount), np.flatnonzero(pcount)
    counts = pd.DataFrame({"node": np.concatenate([rid[hit_r], pid[hit_p]]), "n": np.concatenate([rcount[hit_r], pcount[hit_p]])})
    moved = np.flatnonzero(labels != np.arange(len(ids)))
    forest = pd.DataFrame({"node": ids[moved], "other": ids[labels[moved]]})
    out = pd.concat([counts.assign(other=None), forest.assign(n=0)], ignore_index=True)
    return out[["node", "other", "n"]].astype({"node": "int64", "other": "Int64", "n": "int64"})


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL, sample: int = SAMPLE,
                    per_cell: int = PER_CELL, block: int = BLOCK) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    x = F.col("v")
    good = F.coalesce(F.col("label").isNotNull() & F.col("id").isNotNull() & x.isNotNull()
                      & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
                      & F.exists(x, lambda c: c != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"), F.col(label_col).cast("string").alias("label"))
    rows = rows.withColumn("good", good)
    nodes = rows.filter("good").groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    nodes = written(nodes.withColumn("dim", F.size("v")), "vector-nodes")
    groups = nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("labels")).collect()  # a row per length
    books: dict[int, MultiIndex] = {}
    for g in groups:
        picked = nodes.filter(F.col("dim") == g["dim"]).select("v", "label", F.xxhash64("id").alias("h")).orderBy("h").limit(sample).toPandas()
        codes = int(np.clip(np.sqrt(g["n"] / g["labels"] / per_cell), 1, MAX_CODES))
        books[g["dim"]] = MultiIndex(_unit(picked["v"]), codes, threshold, target_recall, labels=picked["label"].to_numpy(str))

    def deal(batches):
        """Each node once as a resident of its cell and once per first-half cell it visits."""
        for batch in batches:
            parts = []
            for dim, own in batch.groupby("dim"):
                (i, _), (b1, b2) = _visits(books[dim], _unit(own["v"]))
                where, cell = np.nonzero(b1 + b2.min(1, keepdims=True) <= books[dim].radius)
                parts.append(own.assign(cell=i, probe=False))
                parts.append(own.iloc[where].assign(cell=cell, probe=True))
            if parts:
                yield pd.concat(parts)[["label", "v", "id", "n", "dim", "cell", "probe"]]

    kind = dict(nodes.dtypes)["v"]
    dealt = written(nodes.select("label", "v", "id", "n", "dim").mapInPandas(
        deal, f"label string, v {kind}, id long, n long, dim int, cell int, probe boolean"), "vector-cells")
    keys = ["label", "dim", "cell"]
    lists = dealt.groupBy(*keys).agg(F.count_if(~F.col("probe")).alias("rs"), F.count_if("probe").alias("ps")).filter("rs > 0 and ps > 0")
    lists = small(lists.select(*keys, F.ceil(F.col("rs") / block).cast("int").alias("rbs"), F.ceil(F.col("ps") / block).cast("int").alias("pbs")))
    dealt = dealt.join(lists, keys)
    spread = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    residents = dealt.filter(~F.col("probe")).select(*keys, spread("rbs", 1).alias("rb"), all_of("pbs").alias("pb"), "id", "v", "n")
    renamed = [F.col(c).alias(c) for c in [*keys, "id", "v", "n"]]  # both sides come from one table
    probes = dealt.filter("probe").select(*renamed, spread("pbs", 2).alias("pb"), all_of("rbs").alias("rb"))

    def run(key, r: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        if not len(r) or not len(p):
            return pd.DataFrame({"node": pd.Series(dtype="int64"), "other": pd.Series(dtype="Int64"), "n": pd.Series(dtype="int64")})
        return link_block(books[int(key[1])], threshold, int(key[2]), r, p)

    by = [*keys, "rb", "pb"]
    found = written(residents.groupBy(*by).cogroup(probes.groupBy(*by)).applyInPandas(run, "node long, other long, n long"), "vector-links")
    comps = connected_components(found.filter("other is not null"), "node", "other")
    links = found.groupBy("node").agg(F.sum("n").alias("linked"))
    classes = (nodes.select("label", "v", "id", "n").join(links, F.col("id") == links["node"], "left").drop("node")
               .join(comps, F.col("id") == comps["node"], "left")
               .select("label", "v", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id")))
    # Rows find their class by a hash of label and components, then by the components themselves.
    joined = rows.filter("good").join(classes, ["label", "v"]).select("id", "n_links", "component_id")
    rest = rows.filter("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return joined.unionByName(rest).select(F.col("id").alias("vec_id"), F.col("n_links").cast("long"), "component_id",
                                           F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
