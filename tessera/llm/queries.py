"""The registered queries of the training-data operators: each applies its
operator, with production parameters, to the whole table and derives the
digest columns from the operator's output."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, cuckoolines, curriculum, oddsketch, ppm, prefixtrie, projection, resampling, rulecascade, secretscan, sql
from tessera.llm import substrings, surrogates, toxicity
from tessera.llm.common import documents


def op1_minhash_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_documents(documents(spark, sf_dir))


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curriculum.assign(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op3_pii_surrogates(spark: SparkSession, sf_dir: str, key: bytes = b"surrogates-of-the-test-tables") -> DataFrame:
    return surrogates.surrogates(documents(spark, sf_dir).select("doc_id", "text"), key).select("doc_id", "n_entities", "text")


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rulecascade.quality(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = cuckoolines.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text").withColumn("held_out", ppm.held_out(F.col("doc_id"), 3, 1))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.fit(docs.where(~F.col("held_out")), labels)
    return toxicity.classify(docs, model).select("doc_id", "held_out", "score", "predicted")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", ppm.held_out(F.col("doc_id"), 4, 2))
    model = ppm.fit(docs.where(~F.col("held_out")))
    return ppm.identify(docs.select("doc_id", "held_out", "text"), model, keep_text=False)


def op9_bpe(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    coded = bpe.encode_decode_digests(docs, path or public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"), digest=True)
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.lower(F.hex("kept")).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefixtrie.prefix_trie(turns, prefixtrie.grafted, prefixtrie.STEP, prefixtrie.MOST).drop("key")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    drawn = resampling.resample(documents(spark, sf_dir).select("doc_id", "text"), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    base, all_ = secretscan.base("found"), secretscan.reported("found")
    counts = [secretscan.count_of("found", k).alias(f"n_{k}") for k in secretscan.BASE]
    verdicts = [secretscan.with_verdict("found", v).alias(f"n_{v}") for v in secretscan.VERDICTS]
    return found.select("doc_id", *counts, F.sha2(secretscan.listed(base), 256).alias("base_sha256"), secretscan.listed(all_).alias("spans"), *verdicts)


QUERIES = {
    "op1_minhash_odd_sketch": op1_minhash_odd_sketch,
    "op2_curriculum_mix": op2_curriculum_mix,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_embedding_dedup": op4_embedding_dedup,
    "op5_quality_cascade": op5_quality_cascade,
    "op6_line_dedup": op6_line_dedup,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_bpe": op9_bpe,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_secret_scan": op13_secret_scan,
}

SQL = {
    "op2_curriculum_mix": sql.OP2,
    "op5_quality_cascade": sql.OP5,
    "op6_line_dedup": sql.OP6,
    "op10_substring_dedup": sql.OP10,
    "op11_prefix_trie": sql.OP11,
    "op12_importance_resampling": sql.OP12,
    "op13_secret_scan": sql.OP13,
}
