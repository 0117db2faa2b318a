"""Counts, vocabularies and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxtally.catalog.registry import (
    LEXICON, PHRASES, REVIEWS, extraction_sql, overlap_sql, phrase_source, query, quoted, reviews,
    stacked_sql, table, taxonomy,
)
from voxtally.constants import KEYWORD_RULES, PAIN
from voxtally.operators.classify import keyword_classify
from voxtally.operators.dedup import distinct_pairs, distinct_rows, keep_first, keep_latest
from voxtally.operators.extract import rule_extract
from voxtally.operators.filters import since, where_ci
from voxtally.operators.mapping import map_by_overlap
from voxtally.operators.phrases import explode_phrases, stack_phrases
from voxtally.operators.rollup import (
    StepCounts, count_by, date_range, distinct_count, feedback_rollup, label_distribution,
    lang_split_counts, null_count, string_agg_chunks, string_agg_list, vocabulary,
)
from voxtally.session import shared_path
from voxtally.sources.files import read_folder_or_empty, write_table
from voxtally.sources.taxonomy import taxonomy_labels


def rules_sql(text: str, rules=KEYWORD_RULES) -> tuple[str, str]:
    """CASE expressions for label and entity."""
    def case(pick: int, default: str) -> str:
        arms = " ".join(
            "WHEN " + " OR ".join(f"contains(lower({text}), {quoted(k.lower())})" for k in rule[2])
            + f" THEN {quoted(rule[pick])}" for rule in rules)
        return f"CASE WHEN {text} IS NULL THEN NULL {arms} ELSE {quoted(default)} END"

    return case(0, "OTHER"), case(1, "Unknown")


LABEL, ENTITY = rules_sql("text")


@query("keyword_classify", f"SELECT doc_id, {LABEL} AS label, {ENTITY} AS main_entity FROM documents")
def classify(spark, sf_dir):
    return keyword_classify(table(spark, sf_dir, "documents"), "text").select(
        "doc_id", "label", "main_entity")


@query("count_by_entity", f"WITH {REVIEWS} SELECT airline, count(*) AS n FROM reviews GROUP BY airline")
def count_by_entity(spark, sf_dir):
    return count_by(reviews(spark, sf_dir), "airline")


@query("label_distribution", f"""
WITH c AS (SELECT {LABEL} AS label, {ENTITY} AS entity FROM documents)
SELECT 'label' AS field, label AS value, count(*) AS n FROM c WHERE label IS NOT NULL GROUP BY label
UNION ALL SELECT 'main_entity', entity, count(*) FROM c WHERE entity IS NOT NULL GROUP BY entity""")
def distribution(spark, sf_dir):
    return label_distribution(
        keyword_classify(table(spark, sf_dir, "documents"), "text"), "label", "main_entity")


@query("date_range", """
SELECT strftime(min(ts), '%Y-%m-%d') AS first, strftime(max(ts), '%Y-%m-%d') AS last FROM events""")
def range_of_dates(spark, sf_dir):
    return date_range(table(spark, sf_dir, "events"), "ts").select(
        F.date_format("first", "yyyy-MM-dd").alias("first"),
        F.date_format("last", "yyyy-MM-dd").alias("last"))


@query("null_count", """
SELECT count(*) - count(l.quality) AS quality_nulls, count(*) - count(d.text) AS text_nulls
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def nulls(spark, sf_dir):
    joined = table(spark, sf_dir, "documents").join(
        table(spark, sf_dir, "labels"), "doc_id", "left")
    return null_count(joined, "quality", "text")


@query("distinct_reviews", f"""
WITH {PHRASES} SELECT count(*) AS rows, count(DISTINCT "Review_No") AS distinct_values FROM phrases""")
def distinct_reviews(spark, sf_dir):
    phrases = explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)
    return distinct_count(phrases, "Review_No")


@query("vocab_merge", """
SELECT DISTINCT topic FROM (SELECT source AS topic FROM documents UNION ALL SELECT event_type FROM events)
WHERE topic IS NOT NULL""")
def vocab_merge(spark, sf_dir):
    return vocabulary(
        "topic",
        table(spark, sf_dir, "documents").select(F.col("source").alias("topic")),
        table(spark, sf_dir, "events").select(F.col("event_type").alias("topic")))


@query("vocab_from_batches", "SELECT DISTINCT lang || ' ' || source AS subtopic FROM documents")
def vocab_from_batches(spark, sf_dir):
    folder = shared_path(spark, "subtopics")
    batches = table(spark, sf_dir, "documents").select(
        F.concat_ws(" ", "lang", "source").alias("subtopic"))
    write_table(batches, folder)
    return vocabulary(
        "subtopic", read_folder_or_empty(spark, folder, StructType().add("subtopic", "string")))


@query("lang_split_counts", """
SELECT count(*) FILTER (lang = 'en') AS english, count(*) FILTER (lang IS DISTINCT FROM 'en') AS non_english
FROM documents""")
def lang_split(spark, sf_dir):
    return lang_split_counts(table(spark, sf_dir, "documents"), "lang")


@query("stage_metrics", """
WITH latest AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1),
chosen AS (SELECT * FROM latest WHERE lower(event_type) IN ('view')),
dated AS (SELECT * FROM chosen WHERE ts >= TIMESTAMP '2024-01-15')
SELECT 1 AS position, 'loaded' AS step, (SELECT count(*) FROM events) AS rows
UNION ALL SELECT 2, 'deduplicated', (SELECT count(*) FROM latest)
UNION ALL SELECT 3, 'source', (SELECT count(*) FROM chosen)
UNION ALL SELECT 4, 'dated', (SELECT count(*) FROM dated)""")
def stage_metrics(spark, sf_dir):
    counts = StepCounts()
    loaded = counts.step(
        table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type"), "loaded")
    latest = counts.step(keep_latest(loaded, "user_id", "ts", [F.col("event_id")]), "deduplicated")
    chosen = counts.step(where_ci(latest, "event_type", "view"), "source")
    dated = counts.step(since(chosen, "ts", "2024-01-15"), "dated")
    dated.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(counts.rows(), "position int, step string, rows bigint")


@query("string_agg_list", """
SELECT lang, string_agg(source, ', ' ORDER BY source) AS sources
FROM (SELECT DISTINCT lang, source FROM documents) GROUP BY lang""")
def string_agg(spark, sf_dir):
    return string_agg_list(table(spark, sf_dir, "documents"), ["lang"], "source", "sources", None)


@query("string_agg_chunks", """
WITH v AS (SELECT DISTINCT event_type, CAST(user_id AS VARCHAR) AS u FROM events),
n AS (SELECT event_type, u, row_number() OVER (PARTITION BY event_type ORDER BY u) - 1 AS k FROM v)
SELECT event_type, k // 50 + 1 AS chunk, string_agg(u, ', ' ORDER BY u) AS users FROM n GROUP BY event_type, k // 50""")
def string_chunks(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("event_type", F.col("user_id").cast("string").alias("user_id"))
    return string_agg_chunks(users, ["event_type"], "user_id", "users", 50)


def labelled_phrases(spark, sf_dir):
    """Documents to labelled phrases: rule extraction, one explode, labels by shared words."""
    phrases = stack_phrases(
        rule_extract(table(spark, sf_dir, "documents"), "doc_id", "text", LEXICON))
    return map_by_overlap(phrases, taxonomy_labels(taxonomy(spark), "AIRLINE"))


LABELLED = f"{extraction_sql('documents', 'doc_id', 'text')}, {stacked_sql()}, {overlap_sql()}"


@query("feedback_rollup", f"""
WITH {LABELLED}
SELECT topic, subtopic, type, sentiment, count(*) AS phrases, count(DISTINCT "Review_No") AS records
FROM labelled GROUP BY topic, subtopic, type, sentiment""")
def rollup(spark, sf_dir):
    return feedback_rollup(
        labelled_phrases(spark, sf_dir), "topic", "subtopic", "type", "sentiment")


@query("dedup_latest", """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def dedup_latest(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return keep_latest(events, "user_id", "ts", [F.col("event_id")]).select(
        "user_id", "event_id", "event_type")


@query("dedup_first", """
SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text""")
def dedup_first(spark, sf_dir):
    return keep_first(
        table(spark, sf_dir, "documents").select("text", "doc_id"), "text", [F.col("doc_id")])


@query("distinct_rows", "SELECT DISTINCT text, lang FROM documents")
def distinct(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "documents").select("text", "lang"))


@query("distinct_pairs", "SELECT DISTINCT user_id, event_type FROM events")
def pairs(spark, sf_dir):
    return distinct_pairs(table(spark, sf_dir, "events"), "user_id", "event_type")
