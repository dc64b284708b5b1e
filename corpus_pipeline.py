"""The corpus pipeline over ``documents``: language ID, line dedup, near-dedup,
mixing sources to target weights, BPE.

Each stage takes all rows that its predecessor kept and returns the columns of
documents (the last one its digests).  Rows without letters go in the first
stage; lines go in the second, never a row; of each group of near-duplicates one
row stays in the third (also rows without a doc_id, and rows that repeat the kept
one in full); the fourth takes and repeats rows by their sources' targets and
puts them in training order.  Null and empty texts are rejected by the first
stage; an empty table passes through every stage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, cuckoolines, curriculum, oddsketch, ppm
from tessera.llm.common import documents, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled rows outside the held-out fold, rejects rows
    without a language, and fills in missing labels."""
    model = ppm.fit(docs.where(~ppm.held_out(F.col("doc_id"), 4, 2)))
    known = ppm.identify(docs.select(*COLUMNS), model).where(F.col("lang_pred") != ppm.UND)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = cuckoolines.dedup_lines(docs.select(*COLUMNS))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return oddsketch.dedup_rows(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mixed(docs.select(*COLUMNS)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode_digests(docs.select("doc_id", "lang", "source", "text"), public_tokenizers.path("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: language ID and BPE are not expressible in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
