"""The training-data pipeline: language ID, toxicity, SimHash near-dedup, mixing
to source weights, best-fit packing. Each stage takes (spark, docs, sf_dir) and
works on all rows that the stage before kept; ``run`` writes every stage's result as
Parquet in the shared checkpoint folder and reads it again for the next one.

Stages that filter or mix return the columns they were given, in order, whatever
further columns there are; the last returns pieces of token sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import language_id, mixing, packing, simhash, toxicity
from ledgerlens.llm.common import held_out, load, written

#: A text goes when no letter is in it or its best cosine is below this, the
#: standard deviation of the cosine of unrelated profiles (1 / sqrt(dimension)).
LEAST_LANGUAGE = 1 / language_id.DIM ** 0.5


def _own_names(docs: DataFrame) -> tuple[DataFrame, list[str], dict]:
    """The rows under names of the stage's own, so that no column of the input can clash."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), names, dict(zip(docs.columns, names, strict=True))


def stage_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language learnt, go."""
    langs, prototypes = language_id.learn(docs.select("doc_id", "lang", "text"), ~held_out(F.col("doc_id")))
    plain, names, at = _own_names(docs)
    scored = language_id.predict_frame(plain.withColumn("text", F.col(at["text"])), langs, prototypes, names)
    kept = scored.filter((F.col("lang_pred") != language_id.UND) & (F.col("score") >= LEAST_LANGUAGE)) if langs else scored
    return kept.select(*[F.col(n).alias(c) for c, n in at.items()])


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    model = toxicity.train(docs.select("doc_id", "text"), load(spark, sf_dir, "labels"))
    plain, names, at = _own_names(docs)
    scored = toxicity.score_frame(plain.withColumn("text", F.col(at["text"])), model, names)
    return scored.filter("predicted = 0").select(*[F.col(n).alias(c) for c, n in at.items()])


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.keep_first(docs)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix takes them."""
    return mixing.mix_documents(docs)


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences; a repeated document is packed each time."""
    return packing.pack(docs)


STAGES = [("language ID", stage_language), ("toxicity", stage_toxicity), ("SimHash near-dedup", stage_near_dedup),
          ("mixing sources to target weights", stage_mix), ("best-fit packing", stage_pack)]

#: Language ID, toxicity and tokenisation have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
