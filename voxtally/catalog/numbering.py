"""Ids, batches, sorting and stacking."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.registry import (
    LEXICON, PHRASES, REVIEWS, extraction_sql, phrase_source, query, reviews, stacked_sql, table,
)
from voxtally.constants import EXTRACTION_BATCH, PAIN, SUBTOPIC_BATCH
from voxtally.operators.extract import rule_extract
from voxtally.operators.keys import batch_id, batch_id_within, dense_id, global_phrase_key
from voxtally.operators.phrases import explode_phrases, stack_phrases
from voxtally.session import shared_path
from voxtally.sources.files import append_if_exists, write_table


@query("dense_row_id", """
SELECT event_id, event_type, row_number() OVER (ORDER BY ts, event_id) AS row_id FROM events""")
def dense_row_id(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return dense_id(events, ["ts", "event_id"]).select("event_id", "event_type", "row_id")


@query("phrase_id", f"WITH {PHRASES} SELECT phrase_id, pp_mod FROM phrases")
def phrase_id(spark, sf_dir):
    return explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN).select(
        "phrase_id", "pp_mod")


@query("phrase_id_global", f"""
WITH {PHRASES}
SELECT "Review_No" || '-' || (row_number() OVER (ORDER BY pp_mod, phrase_id) - 1) AS phrase_id, pp_mod
FROM phrases""")
def phrase_id_global(spark, sf_dir):
    phrases = explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)
    return global_phrase_key(phrases, ["pp_mod", "phrase_id"]).select("phrase_id", "pp_mod")


@query("batch_number", f"""
SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // {EXTRACTION_BATCH} + 1 AS batch
FROM documents""")
def batch_number(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return batch_id(docs, ["doc_id"], EXTRACTION_BATCH).select("doc_id", "text", "batch")


@query("batch_number_per_topic", f"""
SELECT event_id, event_type,
       (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // {SUBTOPIC_BATCH} AS batch
FROM events""")
def batch_number_per_topic(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    return batch_id_within(events, "event_type", ["event_id"], SUBTOPIC_BATCH).select(
        "event_id", "event_type", "batch")


@query("sort_desc_nulls_last", f"""
WITH {REVIEWS} SELECT review_unique_id, airline, strftime(ts, '%Y-%m-%d') AS day FROM reviews
ORDER BY ts DESC NULLS LAST, review_unique_id""")
def sort_desc_nulls_last(spark, sf_dir):
    rows = reviews(spark, sf_dir).select("review_unique_id", "airline", "ts")
    return rows.orderBy(F.col("ts").desc_nulls_last(), "review_unique_id").select(
        "review_unique_id", "airline", F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("union_phrases", f"""
WITH {extraction_sql('documents', 'doc_id', 'text')}, {stacked_sql()}
SELECT "Review_No", sentiment, topic, pp_mod, type FROM stacked""")
def union_phrases(spark, sf_dir):
    extraction = rule_extract(table(spark, sf_dir, "documents"), "doc_id", "text", LEXICON)
    return stack_phrases(extraction).drop("phrase_id")


@query("append_source", """
SELECT CAST(doc_id AS VARCHAR) AS "Review_No", source AS data_source, text AS "Original Review" FROM documents
UNION ALL
SELECT conv_id || '/' || turn, 'conversation', text FROM conversations""")
def append_source(spark, sf_dir):
    columns = ["Review_No", "data_source", "Original Review"]
    stored = shared_path(spark, "posts")
    write_table(table(spark, sf_dir, "conversations").select(
        F.col("text").alias("Original Review"), F.lit("conversation").alias("data_source"),
        F.concat_ws("/", "conv_id", "turn").alias("Review_No"), "role"), stored)
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("Review_No"), F.col("source").alias("data_source"),
        F.col("text").alias("Original Review"), "lang")
    with_posts = append_if_exists(docs, stored, columns)
    return append_if_exists(with_posts, f"{stored}-absent", columns)
