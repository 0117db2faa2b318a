"""A training corpus from `documents`: language, near duplicates, secrets, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of `documents`. The mixture hands
its slots on as the order of the rows it writes, which packing follows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from voxtally.llm.common import settle, stored_order
from voxtally.llm.languages import fit_languages, keep_known_languages
from voxtally.llm.mixing import keep_mixture, mix_sources, share_whole_sources, sort_by_mixture
from voxtally.llm.near_duplicates import drop_near_duplicates
from voxtally.llm.packing import pack
from voxtally.llm.secrets import fit_on_documents, redact, scan_secrets

# Similarity of near duplicates; a pair just there shares none of 27 bands of 4 in fewer than one of a million cases.
PERCENT = 80
BANDS = 27


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null texts, texts without letters, doubtful ones."""
    return keep_known_languages(docs, fit_languages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, similarity 0.8 or more), the document with the least id stays."""
    return drop_near_duplicates(docs, percent=PERCENT, bands=BANDS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets become [SECRET], and n_chars follows."""
    found = scan_secrets(docs, fit_on_documents(docs), into="_found")
    clean = found.withColumn("text", redact(F.col("text"), F.col("_found")))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).drop("_found")


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the order of their slots; sources whole, none above a quarter of all rows: only what one has beyond that goes."""
    placed = settle(share_whole_sources(mix_sources(docs)), "placed")
    return sort_by_mixture(keep_mixture(docs, placed), placed)


def packed_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in windows of 1024 tokens, which follow each other in the order of the mix."""
    return pack(stored_order(docs, "_place"), public_tokenizers.path("byte_bpe_50k.json"), added=True, order="_place")


STAGES = [
    ("language_id", language_id), ("near_dedup", near_dedup), ("mask_secrets", mask_secrets),
    ("source_mixture", source_mixture), ("packed_windows", packed_windows),
]

# The language model, the secret model and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over `documents`; gives the pieces of the last one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
