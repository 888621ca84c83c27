"""The registered queries of the operators, one each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (chat_format, context_tree, conversation_repair, html_extract, language_id, license_scan, mixing, multi_index, oracles, packing, simhash,
                            source_divergence, topk_pivots, toxicity)
from ledgerlens.llm.common import load


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat_format.with_probe(load(spark, sf_dir, "conversations"))
    return chat_format.read_back(chat_format.format_examples(turns)).drop("n_examples")


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(load(spark, sf_dir, "embeddings"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_topk_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_pivots.quantized(load(spark, sf_dir, "embeddings"))
    return topk_pivots.search(vectors, F.col("id") % topk_pivots.EVERY == 0)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(load(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no files: a document lies at source/hundreds/tens/doc_id, and the
    first of every ten is its directory's licence file."""
    docs = load(spark, sf_dir, "documents")
    tens, hundreds = F.floor(F.col("doc_id") / 10), F.floor(F.col("doc_id") / 100)
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE."), F.col("doc_id"))).otherwise(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), hundreds.cast("string"), tens.cast("string"), name)
    found = license_scan.scan(docs.select(F.col("doc_id").alias("file_id"), path.alias("path"), "text"))
    return found.withColumnRenamed("file_id", "doc_id")


def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(load(spark, sf_dir, "pages"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = conversation_repair.damage(load(spark, sf_dir, "conversations"))
    return conversation_repair.repaired_digests(damaged, conversation_repair.audit(damaged))


def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(load(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.divergence(load(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_chat_format, op2_embedding_near_dedup, op3_toxicity, op4_mix_sources, op5_topk_pivots, op6_language_id,
                                    op7_license_scan, op8_html_main_text, op9_simhash_near_dedup, op10_best_two_fit, op11_conversation_repair, op12_context_tree, op13_source_divergence)}


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": oracles.CHAT, "op2_embedding_near_dedup": oracles.EMBEDDINGS, "op4_mix_sources": oracles.MIX, "op5_topk_pivots": oracles.TOPK,
            "op11_conversation_repair": oracles.REPAIR, "op13_source_divergence": oracles.DIVERGENCE}
