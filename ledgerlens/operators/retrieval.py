"""Chunking, TF-IDF indexing and top-k retrieval as DataFrame jobs over
tables of documents and questions (SURVEY §2.J, J1-J9).

* Chunking folds the paragraphs of one document after the other, in Arrow batches.
* The TF-IDF index is relational: terms counted per text in Arrow batches, a
  window over ``term`` for df, ``groupBy(unit)`` for the norm.
* Scoring adds up postings in blocks of units and questions, which return each
  question's best only; ranking per question keeps the top k with a window that
  Spark plans as a per-group limit.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.expr import py_strip
from ledgerlens.functions.stopwords import ENGLISH
from ledgerlens.session import shared_table
from ledgerlens.sources.tables import spread

# What a Python worker holds at a time, whatever the size of Spark's batches.
BATCH_CHARS, BATCH_TOKENS = 1_000_000, 100_000
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def english_stop_words() -> list[str]:
    """The public default English stop words of Spark ML (no JVM needed)."""
    return list(ENGLISH)


def normalize_whitespace(c: Column) -> Column:
    """Unify line endings and collapse all (Unicode) whitespace runs."""
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def guard_normalize(c: Column) -> Column:
    """J1 guard variant: lower + trim + collapse."""
    return normalize_whitespace(F.lower(c.cast("string")))


def chunk_text(text: str, max_chars: int, overlap_chars: int) -> list[tuple[str, int, int]]:
    """J2 for one text: (chunk, start, end) of chunks of whole paragraphs.

    Paragraph bounds and the running total of their widths are computed once; a chunk's last
    paragraph is then found by binary search in the totals and its text joined once, so the
    work is linear in the text."""
    norm = text.replace("\r\n", "\n").replace("\r", "\n").strip()
    raw = norm.split("\n\n")
    begins = np.cumsum([0, *(len(p) + 2 for p in raw)])[:-1]
    bodies, starts = [], []
    for p, at in zip(raw, begins.tolist()):
        body = p.strip()
        if body:
            bodies.append(body)
            starts.append(at + len(p) - len(p.lstrip()))
    upto = np.cumsum([len(b) + 2 for b in bodies])  # width of the paragraphs up to each, separators included
    out, i, before = [], 0, None                    # before: the chunk that the next one overlaps
    while i < len(bodies):
        body, start = bodies[i], starts[i]
        if before is None and len(body) > max_chars:
            out += [(norm[s:min(s + max_chars, start + len(body))], s, min(s + max_chars, start + len(body))) for s in range(start, start + len(body), max_chars)]
            i += 1
            continue
        first = body
        if before is not None:
            shared = before[len(before) - overlap_chars:] if len(before) > overlap_chars else before
            shared = shared if overlap_chars else ""
            first, start = f"{shared}\n\n{body}".strip(), max(0, start - len(shared))
        after = max(i + 1, int(np.searchsorted(upto, upto[i] + max_chars - len(first), side="right")))
        before = "\n\n".join([first, *bodies[i + 1:after]])
        out.append((before, start, start + len(before)))
        i = after
    return out


def chunk_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    max_chars: int = 900, overlap_chars: int = 120) -> DataFrame:
    """J2 + J3: one row per chunk: (source id, chunk_ordinal, chunk_id, text,
    start_char, end_char). ``chunk_id`` = '<source>:<ordinal>'.

    Paragraphs (parted by blank lines, stripped, non-empty) are folded into chunks of at
    most ``max_chars`` characters; the chunk after a full one starts with the last
    ``overlap_chars`` characters of it. A paragraph longer than ``max_chars`` is cut into
    pieces without overlap where no chunk is open, and kept whole behind an overlap. A text
    is folded in one task, row by row (:func:`chunk_text`); nothing is shuffled."""
    if max_chars <= 100:
        raise ValueError("max_chars must be greater than 100.")
    if overlap_chars < 0:
        raise ValueError("overlap_chars cannot be negative.")
    if overlap_chars >= max_chars:
        raise ValueError("overlap_chars must be smaller than max_chars.")

    def fold(batches):
        names = ["row", "chunk_ordinal", "text", "start_char", "end_char"]
        for batch in batches:
            rows, size = [], 0
            for at, text in enumerate(batch.column("_t")):
                for n, (chunk, start, end) in enumerate(chunk_text(text.as_py(), max_chars, overlap_chars)):
                    rows.append((at, n, chunk, start, end))
                    size += len(chunk)
                if size > BATCH_CHARS or at == len(batch) - 1:
                    if rows:
                        columns = dict(zip(names, zip(*rows)))
                        source = batch.column("source").take(pa.array(columns.pop("row"), pa.int64()))
                        yield pa.RecordBatch.from_arrays(
                            [source, *(pa.array(columns[c], pa.string() if c == "text" else pa.int32()) for c in names[1:])], names=["source", *names[1:]])
                    rows, size = [], 0

    staged = spread(docs.select(F.col(id_col).alias("source"), F.col(text_col).alias("_t")).where(F.col("_t").isNotNull()))
    schema = T.StructType([T.StructField("source", docs.schema[id_col].dataType), T.StructField("chunk_ordinal", T.IntegerType()),
                           T.StructField("text", T.StringType()), T.StructField("start_char", T.IntegerType()), T.StructField("end_char", T.IntegerType())])
    return staged.mapInArrow(fold, schema).select(
        "source", "chunk_ordinal",
        F.concat(F.col("source").cast("string"), F.lit(":"), F.col("chunk_ordinal").cast("string")).alias("chunk_id"),
        "text", "start_char", "end_char")


def tokens_column(text: Column) -> Column:
    """J4 (tokens): lower-case runs of >= 2 word characters (none in a null text)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def explode_terms(df: DataFrame, key: str, text: Column, stop_words: Sequence[str] | None = None,
                  ngram_max: int = 2) -> DataFrame:
    """(key, term) rows: tokens are materialised in one projection, stop
    words removed by Spark ML's hash-set ``StopWordsRemover`` (JVM, codegen),
    then n-grams and the explode read that column."""
    from pyspark.ml.feature import NGram
    stops = english_stop_words() if stop_words is None else list(stop_words)
    raw = df.select(F.col(key).alias(key), tokens_column(text).alias("_raw"))
    if stops:
        toks = StopWordsRemover(inputCol="_raw", outputCol="_toks", stopWords=stops,
                                caseSensitive=True).transform(raw).drop("_raw")
    else:
        toks = raw.withColumnRenamed("_raw", "_toks")
    grams = [F.col("_toks")]
    for n in range(2, ngram_max + 1):
        # Spark ML's NGram: space-joined n-grams of the surviving tokens (empty when too short)
        toks = NGram(n=n, inputCol="_toks", outputCol=f"_g{n}").transform(toks)
        grams.append(F.col(f"_g{n}"))
    # explode_outer: a plain explode would infer size(...) > 0 and rebuild the term array in a pushed filter
    return toks.select(key, F.explode_outer(F.concat(*grams)).alias("term")).where(F.col("term").isNotNull())


def term_counts(units: DataFrame, unit_col: str, text: Column, stop_words: Sequence[str] | None = None,
                ngram_max: int = 2) -> DataFrame:
    """(unit, term, tf), one row per distinct term of a row's text. Tokens come from
    Spark ML's ``StopWordsRemover``; a batch's n-grams are joined and counted as arrays
    where the texts are read, so neither texts nor single occurrences are shuffled."""
    raw = units.select(F.col(unit_col).alias("unit"), tokens_column(text).alias("_raw"))
    stops = english_stop_words() if stop_words is None else list(stop_words)
    toks = raw.withColumnRenamed("_raw", "_toks") if not stops else StopWordsRemover(
        inputCol="_raw", outputCol="_toks", stopWords=stops, caseSensitive=True).transform(raw).drop("_raw")
    schema = T.StructType([T.StructField("unit", units.schema[unit_col].dataType), T.StructField("term", T.StringType()),
                           T.StructField("tf", T.IntegerType())])

    def count(batches):
        for batch in batches:
            # BATCH_TOKENS at a time: a worker's memory
            sizes = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("_toks")), 0).to_numpy(zero_copy_only=False))
            first = 0
            while first < len(batch):
                start = sizes[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sizes, start + BATCH_TOKENS, side="right")))
                part = batch.slice(first, last - first)
                row = pc.list_parent_indices(part.column("_toks")).to_numpy(zero_copy_only=False)
                tok = pc.list_flatten(part.column("_toks"))
                first = last
                grams, rows = [tok], [row]
                gram = tok
                for n in range(2, ngram_max + 1):
                    if len(tok) < n:
                        break
                    gram = pc.binary_join_element_wise(gram.slice(0, len(tok) - n + 1), tok.slice(n - 1), " ")
                    whole = row[:len(tok) - n + 1] == row[n - 1:]
                    grams.append(gram.filter(pa.array(whole)))
                    rows.append(row[:len(tok) - n + 1][whole])
                code = pa.concat_arrays(grams).dictionary_encode()
                if not len(code):
                    continue
                width = len(code.dictionary)
                key, tf = np.unique(np.concatenate(rows).astype(np.int64) * width + code.indices.to_numpy(), return_counts=True)
                for at in range(0, len(key), BATCH_TOKENS):
                    k = key[at:at + BATCH_TOKENS]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("unit").take(pa.array(k // width)), code.dictionary.take(pa.array(k % width)),
                         pa.array(tf[at:at + BATCH_TOKENS], pa.int32())], names=["unit", "term", "tf"])

    return toks.mapInArrow(count, schema)


def _sum_squares(raw: Column) -> Column:
    return F.sqrt(F.sum(raw * raw))


def tfidf_counts(units: DataFrame, unit_col: str, text_col: str = "text",
                 stop_words: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """(tf(unit, term, tf), the number of units). Rows that repeat a unit's id are one unit."""
    rows, n = units.agg(F.count(F.col(unit_col)), F.count_distinct(F.col(unit_col))).first()
    docs = spread(units.select(F.col(unit_col).alias("unit"), F.col(text_col).alias("_t")))
    tf = term_counts(docs, "unit", F.col("_t"), stop_words)
    return (tf if rows == n else tf.groupBy("unit", "term").agg(F.sum("tf").alias("tf"))), n


def idf_column(df: Column, n: int) -> Column:
    return F.ln(F.lit(1.0 + n) / (F.lit(1.0) + df)) + F.lit(1.0)


def tfidf_weighed(tf: DataFrame, n: int) -> DataFrame:
    """(unit, term, df, raw = tf*idf). The counts move once, to their term, where a window
    counts its units."""
    held = tf.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("term")))
    return held.select("unit", "term", "df", (F.col("tf") * idf_column(F.col("df"), n)).alias("raw"))


def tfidf_raw(units: DataFrame, unit_col: str, text_col: str = "text",
              stop_words: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """J5 building blocks: (raw(unit, term, raw = tf*idf), idf(term, df, idf),
    norms(unit, norm)); ``norms`` is a partially aggregated per-unit sum of squares."""
    tf, n = tfidf_counts(units, unit_col, text_col, stop_words)
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("term", "df", idf_column(F.col("df"), n).alias("idf"))
    raw = tfidf_weighed(tf, n).drop("df")
    norms = raw.groupBy("unit").agg(_sum_squares(F.col("raw")).alias("norm"))
    return raw, idf, norms


def tfidf_unit_stats(units: DataFrame, unit_col: str, text_col: str = "text", stop_words: Sequence[str] | None = None) -> DataFrame:
    """J5 per unit in one grouping: (unit, n_terms, max_weight, norm); a unit's largest weight is
    its largest raw value over its norm, so no normalised row is made."""
    raw, _, _ = tfidf_raw(units, unit_col, text_col, stop_words)
    return raw.groupBy("unit").agg(F.count(F.lit(1)).alias("n_terms"), F.max("raw").alias("_m"), _sum_squares(F.col("raw")).alias("norm")) \
        .select("unit", "n_terms", (F.col("_m") / F.col("norm")).alias("max_weight"), "norm")


def tfidf_index(units: DataFrame, unit_col: str, text_col: str = "text",
                stop_words: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(weights(unit, term, weight), idf(term, df, idf)) with raw tf,
    smooth idf = ln((1+n)/(1+df)) + 1 and L2-normalised rows."""
    raw, idf, norms = tfidf_raw(units, unit_col, text_col, stop_words)
    weights = raw.join(norms, "unit").select("unit", "term", (F.col("raw") / F.col("norm")).alias("weight"))
    return weights, idf


def best_of_block(tid: np.ndarray, unit: np.ndarray, weight: np.ndarray, n_units: int, q: np.ndarray, qtid: np.ndarray,
                  qw: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """J6 for one block: (question, unit, score) rows that hold every question's ``k`` best units
    with a common term, whichever way scores a rounding apart are tied. ``unit`` are numbers
    in tie order, ``q`` is sorted; of equal scores the ``k`` largest units are kept."""
    order = np.argsort(tid, kind="stable")
    tid, unit, weight = tid[order], unit[order], weight[order]
    lo, hi = np.searchsorted(tid, qtid, side="left"), np.searchsorted(tid, qtid, side="right")
    found = hi > lo
    q, qw, lo, hi = q[found], qw[found], lo[found], hi[found]
    starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, np.int64)
    ends = np.r_[starts[1:], len(q)]
    group = 64
    width = -(-n_units // group) * group
    out_q, out_u, out_s = [], [], []
    for a, b in zip(starts.tolist(), ends.tolist()):
        spans = list(zip(lo[a:b].tolist(), hi[a:b].tolist(), qw[a:b].tolist()))
        score = np.bincount(np.concatenate([unit[x:y] for x, y, _ in spans]),
                            np.concatenate([weight[x:y] * w for x, y, w in spans]), minlength=width)
        tops = score.reshape(-1, group).max(axis=1)
        # the k-th largest of the groups' maxima is no more than the k-th largest score
        least = np.partition(tops, len(tops) - k)[len(tops) - k] if len(tops) >= k else 0.0
        at = np.flatnonzero(score >= least - 2e-12) if least > 2e-12 else np.flatnonzero(score > 0)
        s = score[at]
        if len(at) > k:
            kth = np.partition(s, len(s) - k)[len(s) - k]
            near = s >= kth - 2e-12
            at, s = at[near], s[near]
            by = np.lexsort((-at, -s))
            at, s = at[by], s[by]
            run = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
            place = np.arange(len(s)) - np.repeat(run, np.diff(np.r_[run, len(s)]))
            at, s = at[place < k], s[place < k]
        out_q.append(np.full(len(at), q[a])), out_u.append(at), out_s.append(s)
    join = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
    return join(out_q, np.int64), join(out_u, np.int64), join(out_s, float)


BLOCK_UNITS, BLOCK_QUESTIONS = 32_768, 65_536


def best_units(qvec: DataFrame, weights: DataFrame, n_units: int, n_questions: int, k: int) -> DataFrame:
    """J6 + the first cut of J7: (q, unit, score), the rows that can be among a question's ``k``
    best. ``qvec``: (q, tid, qw); ``weights``: (unit, tid, weight). Units and questions are
    dealt to blocks by hash; one task scores a block of questions against a block of units,
    adding up the postings of the questions' terms, so no (question, unit) pair leaves it
    but the best. Each block of units goes to every block of questions and back: the work
    is questions x units, the memory that of one block of each."""
    cores = weights.sparkSession.sparkContext.defaultParallelism
    n_b = max(1, -(-n_units // BLOCK_UNITS), min(cores, -(-n_units // 1024)))
    n_c = max(1, -(-n_questions // BLOCK_QUESTIONS))
    spread_over = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    left = weights.withColumn("b", block("unit", n_b)).withColumn("c", spread_over(n_c))
    right = qvec.withColumn("c", block("q", n_c)).withColumn("b", spread_over(n_b))
    schema = T.StructType([T.StructField("q", qvec.schema["q"].dataType), T.StructField("unit", weights.schema["unit"].dataType),
                           T.StructField("score", T.DoubleType())])

    def score(units: pa.Table, questions: pa.Table) -> pa.Table:
        def numbered(column):
            code = column.combine_chunks().dictionary_encode()
            code = code if isinstance(code, pa.DictionaryArray) else code.combine_chunks()
            order = pc.sort_indices(code.dictionary).to_numpy()
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            return place[code.indices.to_numpy()], code.dictionary.take(pa.array(order))
        if not len(units) or not len(questions):
            return pa.Table.from_arrays([pa.array([], questions.schema.field("q").type), pa.array([], units.schema.field("unit").type),
                                         pa.array([], pa.float64())], names=["q", "unit", "score"])
        u, unit_ids = numbered(units.column("unit"))
        q, q_ids = numbered(questions.column("q"))
        qtid, qw = questions.column("tid").to_numpy(), questions.column("qw").to_numpy()
        by = np.lexsort((qtid, q))
        gq, gu, gs = best_of_block(units.column("tid").to_numpy(), u, units.column("weight").to_numpy(), len(unit_ids),
                                   q[by], qtid[by], qw[by], k)
        return pa.Table.from_arrays([q_ids.take(pa.array(gq)), unit_ids.take(pa.array(gu)), pa.array(gs)], names=["q", "unit", "score"])

    return left.groupBy("b", "c").cogroup(right.groupBy("b", "c")).applyInArrow(score, schema)


def top_k(scores: DataFrame, k: int = 3, min_score: float = 0.0, tie_col: str = "unit",
          score_digits: int = 12) -> DataFrame:
    """Top k per question by score desc (tie-break ``tie_col`` desc),
    ``score >= min_score``; the filter on row_number is planned as a per-group
    limit before the final window. Scores are compared at ``score_digits``
    decimals so exact-copy documents tie regardless of float summation order
    (which depends on partitioning)."""
    if k <= 0:
        raise ValueError("top_k must be positive.")
    w = Window.partitionBy("q").orderBy(F.desc(F.bround("score", score_digits)), F.desc(tie_col))
    return (scores.where(F.col("score") >= min_score)
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k))


def fill_top_k(ranked: DataFrame, questions: DataFrame, units: DataFrame, k: int) -> DataFrame:
    """Questions with fewer than k matching units get units of score 0 up to k, in the
    order of the ties (largest id first). The k largest ids always hold enough of them, so
    at most 2k rows per question are ranked again; blank questions get nothing.
    ``questions``: (q, text); ``units``: (unit)."""
    last = units.select("unit").orderBy(F.desc("unit")).limit(k).agg(F.collect_list("unit")).scalar()
    zero = (questions.where(F.coalesce(normalize_whitespace(F.col("text")), F.lit("")) != "")
            .select("q", last.alias("_u")).select("q", F.explode_outer("_u").alias("unit"), F.lit(0.0).alias("score"))
            .where(F.col("unit").isNotNull()))
    both = ranked.select("q", "unit", "score").unionByName(zero).groupBy("q", "unit").agg(F.max("score").alias("score"))
    return top_k(both, k)


def unit_norms(tf: DataFrame, n: int, postings: DataFrame) -> DataFrame:
    """(unit, norm) of the units in ``postings``. A norm needs all terms of its unit, and
    their document frequencies over all units; where few units hold a posting, only the
    counts of the terms of these are moved."""
    held = postings.select("unit").distinct()
    some = held.count()
    if not some:
        return tf.sparkSession.createDataFrame([], T.StructType([tf.schema["unit"], T.StructField("norm", T.DoubleType())]))
    if some < n // 8:
        held = shared_table(held, "posted-units")
        tf = tf.join(tf.join(held, "unit", "left_semi").select("term").distinct(), "term", "left_semi")
    weighed = tfidf_weighed(tf, n)
    weighed = weighed.join(held, "unit", "left_semi") if some < n // 8 else weighed
    return weighed.groupBy("unit").agg(_sum_squares(F.col("raw")).alias("norm"))


def retrieve(questions: DataFrame, q_col: str, q_text: str, units: DataFrame, unit_col: str,
             unit_text: str = "text", k: int = 3, min_score: float = 0.0,
             stop_words: Sequence[str] | None = None, source_filter: DataFrame | None = None) -> DataFrame:
    """J3-J7 composed: (q, unit, score, rank). Units that share no term with the question
    have score 0 and fill up the k places unless ``min_score`` is above 0. ``source_filter``
    (a one-column frame of allowed unit ids) is applied as a left-semi join before ranking;
    the index covers all units."""
    tf, n = tfidf_counts(units, unit_col, unit_text, stop_words)
    asks = questions.select(F.col(q_col).alias("q"), normalize_whitespace(F.col(q_text)).alias("text"))
    qtf = shared_table(tfidf_counts(asks, "q", stop_words=stop_words)[0].withColumnRenamed("unit", "q"), "question-terms")
    asked = qtf.select("term").distinct()
    postings = shared_table(tf.join(asked, "term", "left_semi"), "postings")
    terms = shared_table(postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                         .select("term", idf_column(F.col("df"), n).alias("idf"), F.monotonically_increasing_id().alias("tid")), "terms")
    w = qtf.join(terms, "term").select("q", "tid", (F.col("tf") * F.col("idf")).alias("raw"))
    q_norm = w.groupBy("q").agg(_sum_squares(F.col("raw")).alias("norm"))
    qvec = shared_table(w.join(q_norm, "q").select("q", "tid", (F.col("raw") / F.col("norm")).alias("qw")), "question-vectors")
    norms = shared_table(unit_norms(tf, n, postings), "unit-norms")
    ids = units.select(F.col(unit_col).alias("unit"))
    if source_filter is not None:
        postings = postings.join(source_filter.toDF("unit"), "unit", "left_semi")
        ids = ids.join(source_filter.toDF("unit"), "unit", "left_semi")
    weights = postings.join(terms, "term").join(norms, "unit").select("unit", "tid", (F.col("tf") * F.col("idf") / F.col("norm")).alias("weight"))
    best = best_units(qvec, weights, n, qvec.select("q").distinct().count(), k)
    ranked = top_k(best, k, min_score)
    if min_score > 0:
        return ranked
    return fill_top_k(ranked, questions.select(F.col(q_col).alias("q"), F.col(q_text).alias("text")), ids, k)


def build_context(ranked: DataFrame, chunks: DataFrame, max_context_chars: int = 2500,
                  unit_col: str = "chunk_id") -> DataFrame:
    """Per question, '[Source: .. | Score: ..]\\n<text>' sections in rank
    order while the running length (separators not counted) fits; empty when the first does not."""
    return context_sections(ranked.join(chunks.select(F.col(unit_col).alias("unit"), "source", "text"), "unit"),
                            max_context_chars)


def context_sections(hits: DataFrame, max_context_chars: int = 2500) -> DataFrame:
    """J8 over hits that already hold their chunks: (q, rank, score, source, text)."""
    sec = hits.withColumn("section", F.concat(
        F.lit("[Source: "), F.col("source").cast("string"), F.lit(" | Score: "),
        F.format_string("%.3f", F.col("score")), F.lit("]\n"), py_strip(F.col("text"))))
    w = Window.partitionBy("q").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    sec = sec.withColumn("_run", F.sum(F.length("section")).over(w))
    # running lengths only grow, so the sections before the first that does not fit are those within the limit
    fits = F.when(F.col("_run") <= max_context_chars, F.struct("rank", "section"))
    return sec.groupBy("q").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(fits)), lambda s: s["section"]), "\n\n---\n\n").alias("context"))
