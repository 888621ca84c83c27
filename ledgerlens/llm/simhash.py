"""SimHash near-duplicates with a generalised pigeonhole index.

Fingerprints: XXH64 (seed 42) of every word shingle of a whole text, repeats
included; a bit is 1 when it is set in over half of the hashes. Documents link
when their fingerprints differ in at most ``max_bits`` bits.

Search: the bits are grouped into partitions so that correlated bits share one
(greedily, from the bit correlations of a bounded sample). If the partitions'
thresholds t_i (-1 skips a partition) sum to max_bits - parts + 1, two linked
fingerprints differ by at most t_i bits in some partition i, so probing every
partition within its own threshold finds every link. The thresholds are
allocated by dynamic programming on the candidate counts that the sample
predicts for each partition and threshold, and the number of partitions is the one
with the least predicted work. Every choice gives the same, exact result.

Only distinct fingerprints are searched (a group of exact copies is one of
them). Buckets are runs of sorted rows; buckets over ``block`` rows are split into
pairs of blocks before they are dealt out. Tasks turn links into spanning
forests, so no task emits the pairs of a group.

Defined cases: null text = empty; a text without words has fingerprint 0 and
links like any other; fewer words than a shingle: the whole sequence; null doc_id
is kept and takes part (component_id is the smallest non-null id reachable, null if
there is none); repeated rows are copies; an empty table = an empty result;
further columns are ignored."""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import small, written
from ledgerlens.llm.components import connected_components, merge_labels

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
SAMPLE = 8_192
BLOCK = 4096
MAX_MASKS = 600  # probes of one fingerprint in one partition; plans beyond are not considered
_WORD = re.compile(rb"[^\x20\x09-\x0d]+")
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = np.concatenate([[0], ends[:-shingle]]).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)], dtype=np.uint64)
    ones = np.zeros(BITS, np.int64)
    for s in range(0, len(hashes), 65536):
        ones += np.unpackbits(hashes[s:s + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text) -> doc_id, text_hash (XXH64 of the text, to find the row again), fp (signed 64-bit)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "text_hash", "fp"])

    text = F.coalesce("text", F.lit(""))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
            .mapInArrow(run, "doc_id long, text_hash long, fp long"))


# -- the index --------------------------------------------------------------

def bit_groups(sample: np.ndarray, parts: int) -> list[np.ndarray]:
    """Bits in ``parts`` groups of nearly equal size; correlated bits share a group."""
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    bits -= bits.mean(0) if len(bits) else 0
    dev = np.sqrt((bits * bits).mean(0)) if len(bits) else np.zeros(BITS)
    corr = np.abs(bits.T @ bits / max(1, len(bits)) / np.maximum(np.outer(dev, dev), 1e-12))
    free, groups = list(range(BITS)), []
    for size in [BITS // parts + (i < BITS % parts) for i in range(parts)]:
        own = [max(free, key=lambda b: corr[b, free].sum())]
        free.remove(own[0])
        while len(own) < size:
            b = max(free, key=lambda c: corr[c, own].sum())
            own.append(b)
            free.remove(b)
        groups.append(np.array(sorted(own)))
    return groups


def project(fps: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The partition's bits of each fingerprint as one number."""
    out = np.zeros(len(fps), np.uint64)
    for i, b in enumerate(bits):
        out |= ((fps >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


def ring(width: int, t: int) -> np.ndarray:
    """All masks with exactly ``t`` of ``width`` bits set."""
    return np.array([sum(1 << b for b in own) for own in itertools.combinations(range(width), t)], dtype=np.uint64)


def ball(width: int, t: int) -> np.ndarray:
    """All masks with at most ``t`` of ``width`` bits set; the empty one first."""
    return np.concatenate([ring(width, k) for k in range(t + 1)])


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """``costs[i][t + 1]``: cost of threshold t (from -1) in partition i. Least total
    cost with thresholds that sum to ``total``, by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for own in costs:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for s, (cost, ts) in best.items():
            for t in range(-1, len(own) - 1):
                if s + t not in nxt or cost + own[t + 1] < nxt[s + t][0]:
                    nxt[s + t] = (cost + own[t + 1], [*ts, t])
        best = nxt
    return best[total]


def plan_index(sample: np.ndarray, n: int, max_bits: int = MAX_BITS, probe_cost: float = 100.0) -> list[tuple[np.ndarray, int]]:
    """[(bits, threshold)] of the partitions to probe, with the least predicted work:
    ``probe_cost`` per probe (of a candidate's unit) plus the candidates."""
    options = []
    scale = (n / max(1, len(sample))) ** 2
    for parts in range(1, max_bits + 2):
        groups = bit_groups(sample, parts)
        costs = []
        for bits in groups:
            own = [0.0]
            values, counts = np.unique(project(sample, bits), return_counts=True)
            counts = counts.astype(np.float64)
            pairs, masks = 0.0, 0
            for t in range(max_bits + 1):
                masks += math.comb(len(bits), t)
                if masks > MAX_MASKS:
                    own.append(float("inf"))
                    continue
                for m in ring(len(bits), t):
                    at = np.searchsorted(values, values ^ m)
                    hit = at < len(values)
                    hit[hit] = values[at[hit]] == (values[hit] ^ m)
                    pairs += (counts[hit] * counts[at[hit]]).sum()
                # Chance meetings that the sample is too small to show.
                floor = float(n) ** 2 * masks / 2.0 ** len(bits)
                own.append(probe_cost * n * masks + max(scale * max(0.0, pairs - len(sample)), floor) / 2)
            costs.append(own)
        cost, ts = allocate(costs, max_bits - parts + 1)
        options.append((cost, [(bits, t) for bits, t in zip(groups, ts, strict=True) if t >= 0]))
    return min(options, key=lambda o: o[0])[1]


# -- links within sorted buckets --------------------------------------------

def bucket_forest(fps: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """One bucket's fingerprints (residents and visitors): the spanning forest
    (node, root) of its links of which one end at least is a resident."""
    nodes, at = np.unique(fps, return_inverse=True)
    labels = np.arange(len(nodes))
    home = at[~probe]
    for s in range(0, len(home), 256):
        own = home[s:s + 256]
        a, b = np.nonzero(np.bitwise_count(nodes[own][:, None] ^ nodes[None, :]) <= max_bits)
        labels = merge_labels(labels, own[a], b)
    moved = np.flatnonzero(labels != np.arange(len(nodes)))
    return nodes[moved], nodes[labels[moved]]


def sorted_links(key: np.ndarray, fps: np.ndarray, probe: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by bucket -> forests (node, root) of all buckets. Small buckets are
    compared together, at growing distances in the sorted order."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(first, len(key)))
    which = np.repeat(np.arange(len(first)), size)
    left, right = [], []
    small_rows = size[which] <= 48
    rows = np.flatnonzero(small_rows & (size[which] > 1))
    end = (first + size)[which]
    step = 1
    while len(rows):
        rows = rows[rows + step < end[rows]]
        near = (np.bitwise_count(fps[rows] ^ fps[rows + step]) <= max_bits) & ~(probe[rows] & probe[rows + step])
        left.append(rows[near])
        right.append(rows[near] + step)
        step += 1
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (left, right))
    labels = merge_labels(np.arange(len(key)), a, b)
    moved = np.flatnonzero(labels != np.arange(len(key)))
    nodes, roots = [fps[moved]], [fps[labels[moved]]]
    for g in np.flatnonzero(size > 48):
        own = slice(first[g], first[g] + size[g])
        x, y = bucket_forest(fps[own], probe[own], max_bits)
        nodes.append(x)
        roots.append(y)
    node, root = np.concatenate(nodes), np.concatenate(roots)
    return node[node != root], root[node != root]


def link_forest(fps: DataFrame, max_bits: int = MAX_BITS, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (node, root) that connect all that link."""
    n = fps.count()
    picked = fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    index = [(bits, t, ball(len(bits), t)) for bits, t in plan_index(picked, n, max_bits)]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.asarray(batch.column(0)).view(np.uint64)
            for i, (bits, _, masks) in enumerate(index):
                value = project(fp, bits)
                for s in range(0, len(masks), 64):
                    own = masks[s:s + 64]
                    v = (value[:, None] ^ own[None, :]).ravel().view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(v), i, np.int32)), pa.array(v), pa.array(np.repeat(fp, len(own)).view(np.int64)),
                         pa.array(np.tile(own != 0, len(fp)))], ["part", "value", "fp", "probe"])

    dealt = written(fps.select("fp").mapInArrow(deal, "part int, value long, fp long, probe boolean"), "simhash-probes")
    buckets = dealt.groupBy("part", "value").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("probe")).alias("home"))
    hot = small(buckets.filter((F.col("rows") > block) & (F.col("home") > 0))
                .select("part", "value", F.ceil(F.col("rows") / block).cast("int").alias("blocks")))
    dealt = dealt.join(hot, ["part", "value"], "left")  # only buckets to split are in ``hot``
    own = F.pmod(F.xxhash64("fp"), F.coalesce("blocks", F.lit(1))).cast("int")
    # A row of block x meets every block y, under the pair's smaller block first.
    dealt = dealt.select("part", "value", "fp", "probe", own.alias("x"), F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("y"))
    dealt = dealt.select("part", "value", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"), "fp", "probe")
    keys = ["part", "value", "x", "y"]
    runs = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None

        def emit(rows: list[np.ndarray]) -> pa.RecordBatch:
            key = np.cumsum(np.concatenate([[0], np.any([c[1:] != c[:-1] for c in rows[:4]], axis=0)]))
            node, root = sorted_links(key, rows[4].view(np.uint64), rows[5], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(node.view(np.int64)), pa.array(root.view(np.int64))], ["node", "root"])

        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            rows = rows if held is None else [np.concatenate([h, r]) for h, r in zip(held, rows, strict=True)]
            if not len(rows[0]):
                continue
            last = np.ones(len(rows[0]), bool)
            for c in rows[:4]:
                last &= c == c[-1]
            done = len(last) - int(last.sum())  # rows of the last bucket wait for the next batch
            held = [c[done:] for c in rows]
            if done:
                yield emit([c[:done] for c in rows])
        if held is not None and len(held[0]):
            yield emit(held)

    return runs.mapInArrow(link, "node long, root long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, **params) -> DataFrame:
    """doc_id, text_hash, fp, root (smallest fingerprint of the group), component_id per document."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-classes")
    edges = link_forest(classes.select("fp"), max_bits, **params)
    roots = connected_components(edges, "node", "root")
    member = classes.join(roots, F.col("fp") == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    member = written(member, "fingerprint-members")
    lows = member.groupBy("root").agg(F.min("low").alias("component_id"))
    by_print = member.join(lows, "root").select("fp", "root", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def keep_first(docs: DataFrame, **params) -> DataFrame:
    """One document of each group of near-duplicates: that with its smallest doc_id (of
    rows that repeat an id, the smallest text hash; of a group without ids, too)."""
    found = written(near_duplicates(docs, **params), "simhash-groups")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("text_hash").alias("hash")))
    chosen = written(found.groupBy("root").agg(least.alias("k")).select("k.no_id", "k.id", "k.hash"), "simhash-kept")
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)  # own names, so that no column of the input can clash
    at = {c: F.col(n) for c, n in zip(docs.columns, names, strict=True)}
    rows = plain.select("*", at["doc_id"].isNull().alias("no_id"), F.coalesce(at["doc_id"].cast("long"), F.lit(0)).alias("id"),
                        F.xxhash64(F.coalesce(at["text"], F.lit(""))).alias("hash"))
    keys = ["no_id", "id", "hash"]
    out = rows.join(chosen, keys, "left_semi").dropDuplicates(keys)  # one exchange serves both
    return out.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
