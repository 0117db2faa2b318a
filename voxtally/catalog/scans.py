"""Sources, sinks and stored batches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxtally.catalog.registry import LEXICON, extraction_sql, query, table
from voxtally.functions.text import join_or_null
from voxtally.operators.extract import rule_extract
from voxtally.operators.infer import infer_resumable
from voxtally.schemas import EXTRACTION
from voxtally.session import shared_path
from voxtally.sources.files import (
    contiguous_batches, read_folder_or_empty, read_many, union_all, write_table,
)

_MIXED = StructType().add("text", "string").add("lang", "string").add("role", "string")


@query("scan_union", """
SELECT text, lang, NULL AS role FROM documents
UNION ALL SELECT text, NULL, role FROM conversations""")
def scan_union(spark, sf_dir):
    patterns = [f"{sf_dir}/documents*.parquet", f"{sf_dir}/conversation?.parquet",
                f"{sf_dir}/absent-*.parquet"]
    return read_many(spark, patterns, _MIXED, columns=["text", "lang", "role"], fmt="parquet")


@query("union_by_name", """
SELECT text, lang, NULL AS role FROM documents
UNION ALL SELECT text, NULL, role FROM conversations""")
def union_by_name(spark, sf_dir):
    return union_all([
        table(spark, sf_dir, "documents").select("lang", "text"),
        table(spark, sf_dir, "conversations").select("text", "role")])


@query("combine_folder", "SELECT event_id, event_type, value FROM events")
def combine_folder(spark, sf_dir):
    schema = StructType().add("event_id", "long").add("event_type", "string").add("value", "double")
    folder = shared_path(spark, "folder")
    write_table(table(spark, sf_dir, "events").select(*schema.names), folder, "csv")
    stored = read_folder_or_empty(spark, folder, schema, "csv")
    return stored.unionByName(read_folder_or_empty(spark, f"{folder}-absent", schema, "csv"))


@query("batches_until_gap", """
WITH numbered AS (SELECT event_id, event_id // 50 + 1 AS batch_no FROM events),
gap AS (SELECT max(batch_no) * 3 // 4 AS lost FROM numbered)
SELECT event_id, batch_no FROM numbered, gap WHERE batch_no < lost""")
def batches_until_gap(spark, sf_dir):
    numbered = table(spark, sf_dir, "events").select(
        "event_id", F.floor(F.col("event_id") / 50).alias("zero")).select(
        "event_id", (F.col("zero") + 1).alias("batch_no"))
    lost = numbered.agg(F.floor(F.max("batch_no") * 3 / 4).alias("lost"))
    stored = numbered.where(F.col("batch_no") != lost.scalar())
    return contiguous_batches(stored, "batch_no")


@query("resume_batches", f"""
WITH {extraction_sql('documents', 'doc_id', 'text')}
SELECT review_id, sentiment, topic, nullif(array_to_string(pains, ', '), '') AS pain_points,
       nullif(array_to_string(delights, ', '), '') AS moments_of_delight
FROM extraction""")
def resume_batches(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("review_id"), "text", "lang")

    def infer(part):
        return rule_extract(part, "review_id", "text", LEXICON)

    store = shared_path(spark, "resume")
    infer_resumable(docs.where("lang = 'en'"), "review_id", infer, store, EXTRACTION)
    done = infer_resumable(docs, "review_id", infer, store, EXTRACTION, slices=2)
    return done.select(
        "review_id", "sentiment", "topic",
        join_or_null(F.col("pain_points")).alias("pain_points"),
        join_or_null(F.col("moments_of_delight")).alias("moments_of_delight"))
