"""Registered queries of the operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from traitlab.llm import bpe, embeddings, html, jaccard, lines, mixing, packing, quality, repair, rules, substrings, toxicity, tries
from traitlab.llm.common import table

#: token shares by language that the mix aims at
LANGUAGE_WEIGHTS = {"en": 0.4, "fr": 0.2, "de": 0.2, "es": 0.2}


def byte_bpe() -> str:
    """Vocabulary file; TRAITLAB_BPE names another."""
    if path := os.environ.get("TRAITLAB_BPE"):
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = mixing.mix(docs, docs, "lang", LANGUAGE_WEIGHTS)
    return out.withColumn("rate", F.round("rate", 6))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).drop("rejected_by")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def token_digests(encoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(bpe.encode_decode(table(spark, sf_dir, "documents"), byte_bpe()))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), byte_bpe())


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.repair(repair.faulted(rows, F.col("present"))).digests()


QUERIES = {
    f.__name__: f
    for f in (op1_mix_sources, op2_ngram_jaccard_join, op3_quality_classifier, op4_quality_rules, op5_substring_dedup, op6_bpe_round_trip, op7_html_extraction, op8_line_dedup, op9_embedding_near_dedup, op10_toxicity, op11_curve_packing, op12_conversation_trie, op13_conversation_repair)
}
