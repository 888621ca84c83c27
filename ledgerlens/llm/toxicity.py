"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic
function of its features (0 without any: no evidence, no offence, however long the
text); the document's is their noisy-or, 1 - prod(1 - p). Only document labels train
the model, which then says which sentences offend.

Features of a sentence are its distinct lower-case words and word beginnings of
``PREFIXES`` letters (inflected forms share them). Which features enter is
decided by distributed document counts over all training rows: those that occur
clearly more often in toxic documents. Distinct texts only are counted, as many
copies of one document say no more than one. The weights are fitted on a bounded
sample of labelled rows (``sample`` distinct texts; smallest hashes per class) by
gradient descent with an L1 penalty, in numpy on the driver: what is
collected is bounded by ``sample`` documents' feature ids. Features too scarce in
that sample are weighted by counts over all training rows: their log odds between
the toxic texts that the fitted weights miss and the clean ones, where chance among
all features does not explain them.

Labels are learnt only from rows whose crc32(doc_id) mod 5 is not 0; a score
depends on the text alone.

Defined cases: null text = empty; a text without features scores 0; no labelled row or one class only: the class share for all;
null labels are not labels; ids with several labels take the largest; repeated
rows are scored each; an empty table = an empty result; further columns are
ignored."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import held_out, small, written

SAMPLE = 16_000
MAX_FEATURES = 4_096
PREFIXES = (4, 5, 6)
MIN_DOCS = 5
_TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")


def sentence_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences: runs up to . ! ? or a line's end, without blanks around."""
    out = []
    for m in re.finditer(r"[^.!?\n]+[.!?]*", text):
        own = m.group()
        start = m.start() + len(own) - len(own.lstrip())
        end = m.end() - (len(own) - len(own.rstrip()))
        if end > start:
            out.append((start, end))
    return out


def word_features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}*" for n in PREFIXES if len(word) >= n]]


class Lexicon:
    """Feature weights behind a quick test on the first letters."""

    def __init__(self, ids: dict[str, int]):
        self.ids = ids
        self.short = min(PREFIXES)
        self.gate = {f.rstrip("*")[:self.short] for f in ids}

    def sentences(self, text: str) -> dict[int, set[int]]:
        """The feature ids of the sentences (by number) that have any."""
        gate, short, ids = self.gate, self.short, self.ids
        n, some, hits = 0, False, {}
        for token in _TOKEN.findall(text.lower()):
            if token in _ENDS:
                n += some
                some = False
                continue
            some = True
            if token[:short] in gate:
                own = [ids[f] for f in word_features(token) if f in ids]
                if own:
                    hits.setdefault(n, set()).update(own)
        return hits


def _tokens_with_label(batch: pa.RecordBatch) -> Iterator[tuple[set[str], int, int]]:
    for text, label, copies in zip(batch.column(0), *(batch.column(i).to_pylist() for i in (1, 2)), strict=True):
        words = set(_TOKEN.findall((text.as_py() or "").lower())) - _ENDS
        yield {f for w in words for f in word_features(w)}, label, copies


def feature_counts(rows: DataFrame) -> DataFrame:
    """(text, label, copies) -> feature, pos, neg: documents of either class that have it;
    each of ``copies`` equal rows counts as its part of one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[float]] = {}

        def emit() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.float64()),
                                              pa.array([c[1] for c in counts.values()], pa.float64())], ["feature", "pos", "neg"])
            counts.clear()
            return out

        for batch in batches:
            for features, label, copies in _tokens_with_label(batch):
                for f in features:
                    counts.setdefault(f, [0.0, 0.0])[0 if label else 1] += 1 / copies
                if len(counts) > 200_000:
                    yield emit()
        yield emit()

    parts = rows.select("text", "label", "copies").mapInArrow(run, "feature string, pos double, neg double")
    return parts.groupBy("feature").agg(*[F.round(F.sum(c)).cast("long").alias(c) for c in ("pos", "neg")])


class Model:
    def __init__(self, ids: dict[str, int], weights: np.ndarray, bias: float, constant: float | None = None):
        self.lexicon, self.weights, self.bias, self.constant = Lexicon(ids), weights, bias, constant

    def sentence_p(self, features: set[int]) -> float:
        return float(1 / (1 + np.exp(-(self.bias + self.weights[sorted(features)].sum()))))

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        z = self.bias + np.array([self.weights[sorted(h)].sum() for h in self.lexicon.sentences(text or "").values()])
        return float(-np.expm1(-np.logaddexp(0, z).sum()))


def fit_noisy_or(sentence_doc: np.ndarray, feature: np.ndarray, sentence: np.ndarray, labels: np.ndarray, width: int,
                 rounds: int = 600, rate: float = 2.0, l1: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient descent with momentum. ``sentence_doc``: document of each
    sentence with features; (``feature``, ``sentence``): its features. Either class has half
    of the say."""
    weights, bias = np.zeros(width), -5.0
    docs = len(labels)
    share = np.where(labels > 0, 0.5 / max(1, labels.sum()), 0.5 / max(1, docs - labels.sum())) * docs
    speed, speed_b = np.zeros(width), 0.0
    for _ in range(rounds):
        z = bias + np.bincount(sentence, weights[feature], minlength=len(sentence_doc))
        loss = np.bincount(sentence_doc, np.logaddexp(0, z), minlength=docs)
        p = -np.expm1(-loss)
        # d log-likelihood / d loss: clean documents pull down by 1, toxic ones up by (1 - p) / p.
        pull = np.where(labels > 0, (1 - p) / np.maximum(p, 1e-9), -1.0) * share
        own = pull[sentence_doc] / (1 + np.exp(-z))
        speed = 0.9 * speed + np.bincount(feature, own[sentence], minlength=width) / docs
        speed_b = 0.9 * speed_b + own.sum() / docs
        weights += rate * speed
        weights = np.sign(weights) * np.maximum(np.abs(weights) - rate * l1, 0)
        bias = float(np.clip(bias + 0.05 * rate * speed_b, -10, -2))
    return weights, bias


def missed_counts(rows: DataFrame, model: Model, ids: dict[str, int], scarce: set[int]) -> dict[int, float]:
    """(text, copies) of toxic documents -> of those that ``model`` scores under 0.5, how many
    have each of the ``scarce`` features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, counts = Lexicon(ids), {}
        for batch in batches:
            for text, copies in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                own = scarce.intersection(set().union(*lexicon.sentences(text.as_py()).values()))
                if own and model.score(text.as_py()) < 0.5:
                    for f in own:
                        counts[f] = counts.get(f, 0.0) + 1 / copies
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(list(counts.values()), pa.float64())], ["id", "n"])

    parts = rows.select("text", "copies").mapInArrow(run, "id int, n double")
    return {r["id"]: round(r["n"]) for r in parts.groupBy("id").agg(F.sum("n").alias("n")).collect()}  # a row per scarce feature


def beyond_chance(pos: float, neg: float, share: float, tries: int) -> bool:
    """Would less than one of ``tries`` features have ``pos`` of its pos + neg documents in a class
    of that share by chance (Chernoff bound)?"""
    n = pos + neg
    own = pos / n if n else 0.0
    if own <= share:
        return False
    gap = own * np.log(own / share) + ((1 - own) * np.log((1 - own) / (1 - share)) if own < 1 else 0.0)
    return bool(n * gap >= np.log(max(tries, 1)))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, max_features: int = MAX_FEATURES) -> Model:
    """Fit on documents whose id is labelled and outside the held-out fold."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")))
    # Ids and text hashes alone are shuffled; copies of a text count once, with their largest label.
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    distinct = (plain.select("doc_id", "h").join(known, "doc_id").groupBy("h", "doc_id").agg(F.max("label").alias("label"), F.count(F.lit(1)).alias("copies"))
                .groupBy("h").agg(F.max("label").alias("label"), F.min(F.struct("doc_id", "copies")).alias("first"))
                .select("h", "label", "first.doc_id", "first.copies"))
    distinct = written(distinct, "toxicity-labelled")
    sizes = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        share = float(next(iter(sizes), 0))
        return Model({}, np.zeros(0), -6.0, constant=share)
    rows = plain.filter(~held_out(F.col("doc_id"))).join(small(distinct), ["doc_id", "h"])
    rows = written(rows.select("doc_id", "h", "text", "label", "copies"), "toxicity-rows")
    part = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / 2 / n)))])[F.col("label")]
    chosen = rows.filter(F.pmod(F.col("h"), F.lit(1 << 30)) / float(1 << 30) < part)  # about ``sample`` texts at most
    picked = written(chosen.dropDuplicates(["doc_id", "h"]).select("text", "label"), "toxicity-sample")
    pos_n, neg_n = sizes[1], sizes[0]
    rate, base = (F.col("pos") + 0.5) / (pos_n + 1.0), (F.col("neg") + 0.5) / (neg_n + 1.0)
    gain = (F.col("pos") / pos_n - F.col("neg") / neg_n) * F.log(rate / base)
    counts = written(feature_counts(rows), "toxicity-counts")
    best = (counts.filter((F.col("pos") >= MIN_DOCS) & (rate > 2 * base))
            .orderBy(gain.desc(), "feature").limit(max_features).select("feature", "neg").collect())
    ids = {r["feature"]: i for i, r in enumerate(best)}
    if not ids:
        return Model({}, np.zeros(0), -6.0, constant=pos_n / (pos_n + neg_n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(ids)
        for batch in batches:
            sents = [[sorted(h) for h in lexicon.sentences(text.as_py()).values()] for text in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(sents, pa.list_(pa.list_(pa.int32())))], ["label", "sents"])

    bags = picked.mapInArrow(run, "label int, sents array<array<int>>").toPandas()  # at most ``sample`` rows of ids
    doc, sentence, feature = [], [], []
    doc_of, feature_of = [], []
    for i, sents in enumerate(bags["sents"]):
        own = {f for s in sents for f in s}
        feature_of += own
        doc_of += [i] * len(own)
        for s in sents:
            feature += list(s)
            sentence += [len(doc)] * len(s)
            doc.append(i)
    weights, bias = fit_noisy_or(np.array(doc, int), np.array(feature, int), np.array(sentence, int), bags["label"].to_numpy(), len(ids))
    toxic_docs = bags["label"].to_numpy()[np.array(doc_of, int)] > 0 if doc_of else np.zeros(0, bool)
    seen = np.bincount(np.array(feature_of, int)[toxic_docs], minlength=len(ids))
    if len(bags) < pos_n + neg_n:  # else the sample is the whole
        scarce = {i for i in range(len(ids)) if weights[i] == 0 and seen[i] < 2 * MIN_DOCS}
        if scarce:
            missed, tries = missed_counts(rows.filter("label = 1"), Model(ids, weights, bias), ids, scarce), counts.count()
            for i, n in missed.items():
                odds = np.log((n + 0.5) / (pos_n + 1.0)) - np.log((best[i]["neg"] + 0.5) / (neg_n + 1.0))
                if odds > 0 and beyond_chance(n, best[i]["neg"], pos_n / (pos_n + neg_n), tries):
                    weights[i] = odds - bias
    used = [(f, weights[i]) for f, i in ids.items() if weights[i] != 0]
    return Model({f: i for i, (f, _) in enumerate(used)}, np.array([w for _, w in used]), bias)


def score_frame(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns + score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.array([model.score(t.as_py()) for t in batch.column(len(keep))], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                                             [*batch.schema.names[:len(keep)], "score", "predicted"])

    kinds = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {kinds[c]}" for c in keep] + ["score double", "predicted int"])
    return docs.select(*[f"`{c}`" for c in keep], "text").mapInArrow(run, schema)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """doc_id, sentence (from 0), start, end (code points), p of the sentences that offend."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for i, (s, e) in enumerate(sentence_spans(text or "")):
                    hits = model.lexicon.sentences(text[s:e])
                    p = model.sentence_p(set().union(*hits.values())) if hits else 0.0
                    if p >= least:
                        out.append((doc, i, s, e, p))
            cols = list(zip(*out, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "sentence", "start", "end", "p"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, sentence int, start long, end long, p double")


def score_documents(docs: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, **params)
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return score_frame(rows, model, ["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")
