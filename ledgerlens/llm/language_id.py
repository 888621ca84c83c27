"""Language identification with hyperdimensional profiles.

Every letter has a random +-1 vector (seeded by its code point, so any script
works). A letter n-gram is the product of its letters' vectors, each rotated by
its distance from the n-gram's end; a text is the sum (bundle) of its n-grams,
and a language's prototype is the bundle of all its training texts, each of
unit length so that long texts do not outweigh the rest. A text goes to the
prototype with the largest cosine; the score is that cosine, clipped to 0..1.

Texts are lower-cased and cut at non-letters; words are padded by one blank, so
that n-grams see word ends. Each batch counts its distinct n-grams per text and
multiplies the sparse counts with the n-gram vectors: memory is bounded by the
batch. Prototypes are sums, gathered by Spark as one vector per task and language
from a bounded sample of the training rows (``sample``; smallest hashes per
language), learnt only from text and lang.

Defined cases: null text or no letter: ``und`` with score 0; no training row:
``und``; null lang is no training row; ties of cosines go to the smaller language
code; repeated rows count as often as they occur; an empty table = an empty
result; further columns are ignored."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out

DIM = 1024
N = 3
SEED = 20_111
SAMPLE = 4_000      # training texts per language at most
CHUNK = 64          # texts counted together
PIECE = 1 << 18     # code points of a text counted at a time
UND = "und"


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


@functools.lru_cache(maxsize=65_536)
def letter_vector(code: int, dim: int = DIM) -> np.ndarray:
    return (np.random.default_rng((SEED, code)).integers(0, 2, dim, dtype=np.int8) * 2 - 1).astype(np.int8)


def codes_of(text: str) -> np.ndarray:
    """Lower-cased letters as code points, other runs as one blank, one blank at either end."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    points = np.where(_letters()[points], points, 32)
    points = np.concatenate([[32], points, [32]])
    return points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]


def gram_counts(text: str | None, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter n-grams of a text (letters packed 21 bits each) and their counts."""
    points = codes_of(text or "")
    if len(points) < n or not (points != 32).any():
        return np.empty(0, np.int64), np.empty(0, np.float32)
    grams, counts = [], []
    for s in range(0, len(points) - n + 1, PIECE):
        own = points[s:s + PIECE + n - 1]
        packed = np.zeros(len(own) - n + 1, np.int64)
        for i in range(n):
            packed = packed << 21 | own[i:len(own) - n + 1 + i]
        g, c = np.unique(packed, return_counts=True)
        grams.append(g)
        counts.append(c)
    if len(grams) == 1:
        return grams[0], counts[0].astype(np.float32)
    g, at = np.unique(np.concatenate(grams), return_inverse=True)
    return g, np.bincount(at, np.concatenate(counts)).astype(np.float32)


def gram_vectors(grams: np.ndarray, n: int = N, dim: int = DIM) -> np.ndarray:
    """Bind: product of the letters' vectors, rotated by their place."""
    out = np.ones((len(grams), dim), np.int8)
    for i in range(n):
        codes, at = np.unique(grams >> 21 * (n - 1 - i) & 0x1FFFFF, return_inverse=True)
        table = np.stack([np.roll(letter_vector(int(c), dim), n - 1 - i) for c in codes]) if len(codes) else np.ones((0, dim), np.int8)
        out *= table[at]
    return out


class GramTable:
    """The vectors of the n-grams met so far; forgotten when it holds ``most``."""

    def __init__(self, most: int = 16_384, n: int = N, dim: int = DIM):
        self.most, self.n, self.dim = most, n, dim
        self.grams, self.slots = np.empty(0, np.int64), np.empty(0, np.int64)
        self.vectors = np.empty((most, dim), np.float32)

    def rows(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct n-grams (at most ``most``)."""
        at = np.searchsorted(self.grams, grams)
        known = at < len(self.grams)
        known[known] = self.grams[at[known]] == grams[known]
        new = grams[~known]
        if len(new):
            if len(self.grams) + len(new) > self.most:
                self.grams, self.slots, new = np.empty(0, np.int64), np.empty(0, np.int64), grams
            slots = np.arange(len(self.grams), len(self.grams) + len(new))
            self.vectors[slots] = gram_vectors(new, self.n, self.dim)
            every = np.concatenate([self.grams, new])
            order = np.argsort(every)
            self.grams, self.slots = every[order], np.concatenate([self.slots, slots])[order]
            at = np.searchsorted(self.grams, grams)
        return self.vectors[self.slots[at]]


def bundles(texts: list[str | None], table: GramTable) -> np.ndarray:
    """One vector per text: the sum of its n-grams' vectors."""
    each = [gram_counts(t, table.n) for t in texts]
    grams = np.unique(np.concatenate([g for g, _ in each])) if each else np.empty(0, np.int64)
    out = np.zeros((len(texts), table.dim), np.float32)
    for s in range(0, len(grams), 8192):  # a text of many scripts may have many n-grams
        own = grams[s:s + 8192]
        counts = np.zeros((len(texts), len(own)), np.float32)
        for i, (g, c) in enumerate(each):
            at = np.searchsorted(own, g)
            ok = at < len(own)
            ok[ok] = own[at[ok]] == g[ok]
            counts[i, at[ok]] = c[ok]
        out += counts @ table.rows(own)
    return out


def _chunks(column: pa.Array) -> Iterator[list]:
    for s in range(0, len(column), CHUNK):
        yield column[s:s + CHUNK].to_pylist()


def learn(docs: DataFrame, is_training: Column, sample: int = SAMPLE, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages and their prototypes (unit rows) from the rows where ``is_training``."""
    rows = docs.filter(is_training & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per language
    if not sizes:
        return [], np.zeros((0, dim), np.float32)
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])[F.col("lang")]
    place = F.pmod(F.xxhash64("doc_id", F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    rows = rows.filter(place < share).select(F.col("lang").cast("string").alias("lang"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        table = GramTable(dim=dim)
        for batch in batches:
            langs = batch.column(0).to_pylist()
            at = 0
            for texts in _chunks(batch.column(1)):
                x = bundles(texts, table).astype(np.float64)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
                for lang, v in zip(langs[at:at + len(texts)], x, strict=True):
                    sums[lang] = sums[lang] + v if lang in sums else v
                at += len(texts)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], ["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
    sums = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).collect()  # ``dim`` numbers per language
    langs = sorted({r["lang"] for r in sums})
    out = np.zeros((len(langs), dim), np.float64)
    for r in sums:
        out[langs.index(r["lang"]), r["i"]] = r["x"]
    return langs, (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def predict_frame(docs: DataFrame, langs: list[str], prototypes: np.ndarray, keep: list[str]) -> DataFrame:
    """``keep`` columns + lang_pred, score for every row of ``docs`` (with a text column)."""
    dim = prototypes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = GramTable(dim=dim)
        for batch in batches:
            preds, scores = [], []
            for texts in _chunks(batch.column(len(keep))):
                x = bundles(texts, table)
                norm = np.linalg.norm(x, axis=1)
                if not langs:
                    preds += [UND] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                cos = (x @ prototypes.T) / np.maximum(norm, 1e-9)[:, None]
                best = cos.argmax(1)
                letters = norm > 0
                preds += [langs[b] if ok else UND for b, ok in zip(best, letters, strict=True)]
                scores += np.where(letters, np.clip(cos[np.arange(len(best)), best], 0, 1), 0).astype(float).tolist()
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                                             [*batch.schema.names[:len(keep)], "lang_pred", "score"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["lang_pred string", "score double"])
    return docs.select(*[f"`{c}`" for c in keep], "text").mapInArrow(run, schema)


def identify(docs: DataFrame, sample: int = SAMPLE, dim: int = DIM) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    langs, prototypes = learn(docs, ~held_out(F.col("doc_id")), sample, dim)
    return (predict_frame(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), langs, prototypes, ["doc_id", "held_out"])
            .select("doc_id", "held_out", "lang_pred", "score"))
