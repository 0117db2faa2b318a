"""Streams over the driver's tables; each runs until its input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.aggregates import rules_sql
from voxtally.catalog.models import ONE_LINE, english_model
from voxtally.catalog.registry import LEXICON, detect_sql, extraction_sql, query, table
from voxtally.functions.text import join_or_null
from voxtally.operators.extract import rule_extract
from voxtally.operators.language import LANGUAGE_COLUMNS, translate
from voxtally.schemas import EXTRACTION
from voxtally.session import shared_path
from voxtally.streaming.inference import start_inference
from voxtally.streaming.ingest import start_ingest
from voxtally.streaming.vocabulary import start_vocabulary

_LABEL, _ENTITY = rules_sql("text")


def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(_export(sf_dir, name))


def _export(sf_dir, name):
    """Pattern for a table that is one file or a folder of files."""
    return f"{sf_dir}/{name}.parquet*"


@query("stream_ingest", f"""
WITH single AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text),
{detect_sql('single')}
SELECT text, doc_id, {_LABEL} AS label, {_ENTITY} AS main_entity, lang_name AS "Original Review Language",
       CASE WHEN lang_code = 'en' THEN text ELSE 'EN ' || {ONE_LINE} END AS "Translated Review"
FROM detected""")
def stream_ingest(spark, sf_dir):
    sink, checkpoint = shared_path(spark, "sink"), shared_path(spark, "checkpoint")
    answers = shared_path(spark, "translations")
    schema = table(spark, sf_dir, "documents").select("text", "doc_id").schema

    def translator(rows):
        return translate(rows, "doc_id", "_foreign", english_model(), "Translate to English.", store=answers)

    # The second run finds nothing new, and a new stream over the same export sees only known ids.
    for folder in (checkpoint, checkpoint, shared_path(spark, "checkpoint")):
        start_ingest(spark, _export(sf_dir, "documents"), sink, folder, schema, "text", "text",
                     translator=translator).awaitTermination()
    return spark.read.parquet(sink).select("text", "doc_id", "label", "main_entity", *LANGUAGE_COLUMNS)


@query("stream_resume", f"""
WITH {extraction_sql('documents', 'doc_id', 'text')}
SELECT review_id, sentiment, topic, nullif(array_to_string(pains, ', '), '') AS pain_points,
       nullif(array_to_string(delights, ', '), '') AS moments_of_delight
FROM extraction""")
def stream_resume(spark, sf_dir):
    store = shared_path(spark, "answers")

    def infer(batch):
        return rule_extract(batch, "review_id", "text", LEXICON)

    for _ in range(2):  # a lost checkpoint: the second stream repeats all input, asks nothing
        start_inference(
            _stream(spark, sf_dir, "documents").select(
                F.col("doc_id").cast("string").alias("doc_id"), "text"),
            "doc_id", infer, store, shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.schema(EXTRACTION).parquet(store).select(
        "review_id", "sentiment", "topic",
        join_or_null(F.col("pain_points")).alias("pain_points"),
        join_or_null(F.col("moments_of_delight")).alias("moments_of_delight"))


@query("stream_vocab", """
SELECT DISTINCT topic FROM (SELECT source AS topic FROM documents UNION ALL SELECT event_type FROM events)""")
def stream_vocab(spark, sf_dir):
    store = shared_path(spark, "vocabulary")
    for name, col in (("documents", "source"), ("events", "event_type")):
        start_vocabulary(
            _stream(spark, sf_dir, name).select(F.col(col).alias("topic")), "topic", store,
            shared_path(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(store).select("topic")
