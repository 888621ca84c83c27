"""Source divergence audit: which sources of a language use other words than the rest.

A language keeps the terms that stand in at least ``LEAST_DOCS`` of its documents.
Every (lang, source) group, and each language as a whole, gives each kept term the
smoothed share p = 1 + floor(10^9 (count + 2) / (N + 2 V)); two shares diverge by
f = floor((p - q)^2 / (p + q)). ``pair`` compares a group with every other source of
its language, f summed over all kept terms; ``term`` names the terms that a group uses
more than its language, by f, the first ``TOP``.

The terms are found by a dominance skyband. f grows with the group's count and falls
with the language's, and equal values are ranked by the term's bytes; so a term with k
others that have no lower count in the group, no higher one in the language and
earlier bytes is not among the first k. A task keeps, group by group, the terms that
fewer than k of its others dominate; the skybands are merged the same way and only
what is left is ranked, exactly. No term is dropped otherwise, and a group of any
size is spread over all tasks.

Pairs are summed as blocks: sources are dealt to blocks of about ``BLOCK``, a term's
counts go to the pairs of blocks they belong to, and a task adds up one small matrix
per pair of blocks; terms that neither block has are counted, not listed.

All arithmetic is in longs and exact (long division in base 1000, for N + 2 V up to
9 * 10^15). Texts are counted whole, in runs of a few megabytes.

Defined cases: null text, lang or source = ''; repeated rows count each; a language
without kept terms has pairs of value 0 and no terms; a single source has no pairs; an
empty table = an empty result; further columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import small, text_runs, written

LEAST_DOCS = 10
TOP = 10
#: Sources of a block, and parts into which the terms of a pair of blocks are dealt.
BLOCK, PARTS = 128, 32
#: Bytes of text counted at once in a task.
CHUNK = 8 << 20
#: Terms a task holds in its skybands before it passes them on.
HELD = 200_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x41] = _FOLD[0x5B:0x61] = _FOLD[0x7B:0x80] = 0x20
_FOLD[0x41:0x5B] += 0x20


def _terms(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, A-Z lower-cased, and the text each belongs to."""
    text = text.cast(pa.large_string())
    ends = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, 8 * text.offset)
    data = _FOLD[np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]]
    folded = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(ends - ends[0]), pa.py_buffer(data))
    lists = pc.split_pattern(folded, " ")
    terms, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.not_equal(terms, "")
    return terms.filter(some), owner.filter(some).to_numpy()


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    encoded = values.dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def _summed(keys: np.ndarray, *counts: np.ndarray) -> tuple:
    """Distinct keys and the sums of the counts under each."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], *(np.add.reduceat(c[order], new) if len(new) else c for c in counts)


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents with it); one row with a null
    term for every group."""
    def tally(batches):
        for lang, source, text in text_runs(batches, ("lang", "source", "text"), CHUNK):
            (lang_of, langs), (source_of, sources) = _codes(lang), _codes(source)
            group_of = lang_of * len(sources) + source_of
            terms, owner = _terms(text)
            term_of, names = _codes(terms)
            m = max(1, len(names))
            pair, n = _summed(owner * m + term_of, np.ones(len(owner), np.int64))
            key, n, docs_with = _summed(group_of[pair // m] * m + pair % m, n, np.ones(len(pair), np.int64))
            groups = np.unique(group_of)
            group = np.r_[key // m, groups]
            yield pa.RecordBatch.from_arrays([
                langs.take(pa.array(group // len(sources))), sources.take(pa.array(group % len(sources))),
                pa.concat_arrays([names.take(pa.array(key % m)).cast(pa.string()), pa.nulls(len(groups), pa.string())]),
                pa.array(np.r_[n, np.zeros(len(groups), np.int64)]), pa.array(np.r_[docs_with, np.zeros(len(groups), np.int64)])],
                names=["lang", "source", "term", "n", "docs"])

    filled = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return (filled.mapInArrow(tally, "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: str, total: str) -> Column:
    """1 + floor(10^9 count / total) of two long expressions, count <= total."""
    value, rest = "0L", f"({count})"
    for _ in range(3):
        scaled = f"({rest} * 1000L)"
        value, rest = f"({value} * 1000L + {scaled} div greatest({total}, 1L))", f"({scaled} % greatest({total}, 1L))"
    return F.expr(f"{value} + 1L")


def kept_terms(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, groups). kept: lang, source, term, n, lang_n. groups: lang, source, size (N + 2 V),
    lang_size, v (kept terms)."""
    of_term = Window.partitionBy("lang", "term")
    totals = counts.filter("term IS NOT NULL").withColumns({
        "lang_docs": F.sum("docs").over(of_term), "lang_n": F.sum("n").over(of_term), "nth": F.row_number().over(of_term.orderBy("source"))})
    kept = totals.filter(F.col("lang_docs") >= LEAST_DOCS).select("lang", "source", "term", "n", "lang_n", (F.col("nth") == 1).alias("first"))
    return kept, counts.filter("term IS NULL").select("lang", "source")


def _sized(kept: DataFrame, groups: DataFrame) -> DataFrame:
    by_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast("long")).alias("v"))
    every = groups.join(by_group, ["lang", "source"], "left").fillna(0, ["n", "v"])
    langs = every.groupBy("lang").agg(F.sum("v").alias("lang_v"), F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("sources"))
    return every.join(small(langs), "lang").select(
        "lang", "source", "sources", F.col("lang_v").alias("v"), (F.col("n") + 2 * F.col("lang_v")).alias("size"), (F.col("lang_n") + 2 * F.col("lang_v")).alias("lang_size"))


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int, step: int = 512) -> np.ndarray:
    """Places of the points that fewer than ``k`` others dominate: no lower ``n``, no higher
    ``lang_n``, lower ``term`` (all different). Dominators come first in this order, and
    those of the skyband are enough to count."""
    order = np.lexsort((term, lang_n, -n))
    lang_n, term = lang_n[order], term[order]
    kept = np.zeros(0, np.int64)
    for at in range(0, len(order), step):
        left = np.arange(at, min(at + step, len(order)))
        beaten = np.zeros(len(left), np.int64)
        for k0 in range(0, len(kept), step):
            some = kept[k0:k0 + step]
            beaten += ((lang_n[some] <= lang_n[left, None]) & (term[some] < term[left, None])).sum(1)
            left, beaten = left[beaten < k], beaten[beaten < k]
        within = np.tril((lang_n[left] <= lang_n[left, None]) & (term[left] < term[left, None]), -1)
        # among the points of this step, one that is itself out still stands for k others
        beaten += within.sum(1)
        kept = np.r_[kept, left[beaten < k]]
    return order[kept]


def _skybands(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """The rows of lang, source, term, n, lang_n that are in the skyband of their group among
    the rows seen; groups are passed on once the task holds many terms."""
    held, rows = {}, 0

    def reduced(table):
        rank = pc.rank(table["term"].cast(pa.binary()), sort_keys="ascending", tiebreaker="dense").to_numpy()
        return table.take(pa.array(np.sort(skyband(table["n"].to_numpy(), table["lang_n"].to_numpy(), rank, k))))

    for batch in batches:
        lang_of, langs = _codes(batch.column("lang"))
        source_of, sources = _codes(batch.column("source"))
        group = lang_of * len(sources) + source_of
        order = np.argsort(group, kind="stable")
        table = pa.Table.from_batches([batch]).take(pa.array(order))
        cuts = np.r_[np.flatnonzero(np.r_[True, np.diff(group[order]) != 0]), len(order)] if len(order) else np.zeros(1, np.int64)
        for a, b in zip(cuts, cuts[1:]):
            g = int(group[order[a]])
            key = (langs[g // len(sources)].as_py(), sources[g % len(sources)].as_py())
            part = table.slice(a, b - a)
            before = held.get(key)
            rows -= 0 if before is None else len(before)
            held[key] = reduced(part if before is None else pa.concat_tables([before, part]))
            rows += len(held[key])
        if rows > HELD:
            yield from (x for t in held.values() for x in t.to_batches())
            held, rows = {}, 0
    yield from (x for t in held.values() for x in t.to_batches())


def top_terms(kept: DataFrame, sized: DataFrame, k: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the first ``k`` terms of each group."""
    at = kept.select("lang", "source", "term", "n", "lang_n").join(small(sized.select("lang", "source", "size", "lang_size")), ["lang", "source"])
    over = (at.withColumns({"p": share("n + 2", "size"), "q": share("lang_n + 2", "lang_size")}).filter("p > q")
            .select("lang", "source", "term", "n", "lang_n", "p", "q"))
    schema = over.schema
    local = over.mapInArrow(lambda batches: _skybands(batches, k), schema)
    merged = local.repartition("lang", "source").mapInArrow(lambda batches: _skybands(batches, k), schema)
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return (merged.select("lang", "source", F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k))


def pair_values(kept: DataFrame, sized: DataFrame) -> DataFrame:
    """lang, source, item, value, rank: every other source of the language, nearest last."""
    blocks = F.ceil(F.col("sources") / BLOCK).cast("long")
    block = F.pmod(F.xxhash64("source"), blocks)
    groups = sized.withColumns({"blocks": blocks, "block": block, "p0": F.when(F.col("v") > 0, share("2L", "size")).otherwise(0)})
    rows = kept.select("lang", "source", "term", "n").join(small(groups.select("lang", "source", "size", "blocks", "block")), ["lang", "source"])
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    terms = rows.select("lang", "source", "block", other, "term", share("n + 2", "size").alias("p"), F.pmod(F.xxhash64("term"), F.lit(PARTS)).alias("part"))
    heads = groups.select("lang", "source", "block", other, F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), F.lit(PARTS).alias("parts")) \
        .select("lang", "source", "block", "other", "term", "p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    a, b = F.least("block", "other"), F.greatest("block", "other")
    dealt = terms.unionByName(heads).select("lang", a.alias("a"), b.alias("b"), "part", "term", "source", (F.col("block") <= F.col("other")).alias("row"),
                                            (F.col("block") >= F.col("other")).alias("col"), "p")
    dealt = dealt.repartition("lang", "a", "b", "part").sortWithinPartitions("lang", "a", "b", "part", F.col("term").asc_nulls_first(), "source")
    sums = dealt.mapInArrow(_matrices, "lang string, source string, item string, value long, terms long, base long")
    total = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"), F.max("base").alias("base"))
    of_lang = small(sized.groupBy("lang").agg(F.max("v").alias("v")))
    value = F.col("value") + (F.col("v") - F.col("terms")) * F.col("base")
    both = total.join(of_lang, "lang").select("lang", "source", "item", value.alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    return both.withColumn("rank", F.row_number().over(order))


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // np.maximum(p + q, 1)


class _Matrix:
    """Sums for one pair of blocks over one part of the terms. The heads (null term) name the
    sources; then come the terms, each with the sources that have it."""

    def __init__(self):
        self.names, self.base, self.at = ([], []), ([], []), ({}, {})
        self.total, self.terms, self.dense = None, 0, []

    def head(self, source, row, col, p):
        for side, here in enumerate((row, col)):
            if here:
                self.at[side][source] = len(self.names[side])
                self.names[side].append(source)
                self.base[side].append(p)

    def add(self, rows):
        """One term: (source, row, col, p) of the sources that have it."""
        if self.total is None:
            self.base = tuple(np.array(x, np.int64) for x in self.base)
            self.total = np.zeros((len(self.base[0]), len(self.base[1])), np.int64)
        p = self.base[0].copy(), self.base[1].copy()
        for source, row, col, value in rows:
            for side, here in enumerate((row, col)):
                if here:
                    p[side][self.at[side][source]] = value
        self.dense.append(p)
        self.terms += 1
        if len(self.dense) * self.total.size > 1 << 20:
            self.flush()

    def flush(self):
        if self.dense:
            p, q = (np.stack(x) for x in zip(*self.dense, strict=True))
            self.total += _f(p[:, :, None], q[:, None, :]).sum(0)
            self.dense = []

    def rows(self, lang, diagonal):
        self.flush()
        base = _f(np.array(self.base[0], np.int64)[:, None], np.array(self.base[1], np.int64)[None, :])
        total = np.zeros_like(base) if self.total is None else self.total
        for i, x in enumerate(self.names[0]):
            for j, y in enumerate(self.names[1]):
                if x != y:
                    yield lang, x, y, int(total[i, j]), self.terms, int(base[i, j])
                    if not diagonal:
                        yield lang, y, x, int(total[i, j]), self.terms, int(base[i, j])


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["lang", "source", "item", "value", "terms", "base"]

    def sums():
        key = matrix = None
        term, rows = None, []
        for batch in batches:
            for lang, a, b, part, t, source, row, col, p in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (lang, a, b, part) != key:
                    if matrix:
                        if rows:
                            matrix.add(rows)
                        yield from matrix.rows(key[0], key[1] == key[2])
                    key, matrix, term, rows = (lang, a, b, part), _Matrix(), None, []
                if t is None:
                    matrix.head(source, row, col, p)
                    continue
                if t != term:
                    if rows:
                        matrix.add(rows)
                    term, rows = t, []
                rows.append((source, row, col, p))
        if matrix:
            if rows:
                matrix.add(rows)
            yield from matrix.rows(key[0], key[1] == key[2])

    held = []
    for r in sums():
        held.append(r)
        if len(held) == 10_000:
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in held])
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in held])


def divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value, rank of ``docs`` (text, lang, source)."""
    kept, groups = kept_terms(written(count_terms(docs), "terms"))
    kept = written(kept, "kept-terms")
    sized = written(_sized(kept, groups), "sized-groups")
    parts = [frame.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
             for name, frame in (("pair", pair_values(kept, sized)), ("term", top_terms(kept, sized)))]
    return parts[0].unionByName(parts[1])
