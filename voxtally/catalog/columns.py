"""Filters, projections and value choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.registry import query, quoted, table
from voxtally.constants import LANGUAGE_NAMES
from voxtally.functions.choose import (
    coerce_to_set, first_non_empty, map_or_keep, replace_map, update_where,
)
from voxtally.operators.filters import drop_nulls, long_enough, project, since, where_ci, where_in


@query("project_rename", """
SELECT doc_id AS "Review_No", source AS data_source, lang AS "Original Review Language",
       text AS "Original Review" FROM documents""")
def project_rename(spark, sf_dir):
    return project(
        table(spark, sf_dir, "documents"),
        {"doc_id": "Review_No", "source": "data_source", "lang": "Original Review Language",
         "text": "Original Review"},
        ["Review_No", "data_source", "Original Review Language", "Original Review"])


@query("min_date_filter", """
SELECT event_id, user_id, event_type, value FROM events WHERE ts >= TIMESTAMP '2024-01-15'""")
def min_date_filter(spark, sf_dir):
    return since(table(spark, sf_dir, "events"), "ts", "2024-01-15").select(
        "event_id", "user_id", "event_type", "value")


@query("source_filter_ci", "SELECT doc_id, source, text FROM documents WHERE lower(source) = 'src3'")
def source_filter_ci(spark, sf_dir):
    return where_ci(table(spark, sf_dir, "documents"), "source", "SRC3").select(
        "doc_id", "source", "text")


@query("source_in_list", """
SELECT doc_id, source, text FROM documents WHERE source IN ('src1', 'src3', 'SRC5')""")
def source_in_list(spark, sf_dir):
    return where_in(table(spark, sf_dir, "documents"), "source", ["src1", "src3", "SRC5"]).select(
        "doc_id", "source", "text")


@query("min_length_filter", """
SELECT conv_id, turn, role, text FROM conversations WHERE text IS NOT NULL AND length(text) > 5""")
def min_length_filter(spark, sf_dir):
    return long_enough(table(spark, sf_dir, "conversations"), "text", 5).select(
        "conv_id", "turn", "role", "text")


@query("drop_nulls", """
SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
WHERE l.toxic IS NOT NULL""")
def drop_null_rows(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").select("doc_id").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return drop_nulls(joined, ["toxic"]).select("doc_id", "quality", "toxic")


@query("coerce_topic", """
SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type ELSE 'Others' END AS topic
FROM events""")
def coerce_topic(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", coerce_to_set(
        F.col("event_type"), ["view", "click", "purchase"], "Others").alias("topic"))


@query("replace_values", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'Baggage Services' WHEN 'click' THEN 'Baggage Services'
       ELSE event_type END AS topic FROM events""")
def replace_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", replace_map(
        F.col("event_type"), {"view": "Baggage Services", "click": "Baggage Services"})
        .alias("topic"))


_NAMES = " ".join(f"WHEN {quoted(c)} THEN {quoted(n)}" for c, n in LANGUAGE_NAMES.items())


@query("lang_name", f"""
WITH coded AS (SELECT doc_id, CASE WHEN lang = 'es' THEN 'xx-' || source ELSE ' ' || upper(lang) || ' ' END AS code
               FROM documents)
SELECT doc_id, CASE lower(trim(code)) {_NAMES} ELSE code END AS language FROM coded""")
def lang_name(spark, sf_dir):
    code = F.when(F.col("lang") == "es", F.concat(F.lit("xx-"), "source")).otherwise(
        F.concat(F.lit(" "), F.upper("lang"), F.lit(" ")))
    return table(spark, sf_dir, "documents").select(
        "doc_id", map_or_keep(code, LANGUAGE_NAMES).alias("language"))


@query("first_non_empty", """
SELECT d.doc_id, CASE WHEN l.toxic IS NULL OR l.toxic = 1 THEN d.source ELSE d.text END AS chosen
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def first_non_empty_text(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    original = F.when(F.col("toxic") == 1, F.lit("")).when(F.col("toxic") == 0, F.col("text"))
    return joined.select("doc_id", first_non_empty(original, F.col("source")).alias("chosen"))


@query("update_where", """
SELECT doc_id, CASE WHEN lang <> 'en' THEN '[translated] ' || text ELSE text END AS translated
FROM documents""")
def update_where_rows(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", update_where(
        text, F.col("lang") != "en", F.concat(F.lit("[translated] "), text)).alias("translated"))
