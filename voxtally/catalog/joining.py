"""Joins and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.registry import PHRASES, REVIEWS, phrase_source, query, reviews, table
from voxtally.constants import PAIN
from voxtally.functions.text import title_case
from voxtally.operators.joins import (
    in_topics, join_labels, join_metadata, lookup_inner, new_only, topic_candidates, unmapped,
)
from voxtally.operators.phrases import explode_phrases
from voxtally.sources.taxonomy import taxonomy_labels, topic_list, upper_type, valid_topics


def _phrases(spark, sf_dir):
    return explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)


def part_taxonomy(spark, sf_dir):
    """Taxonomy from the parts: brand as topic, noun as root subtopic, adjectives as modifiers."""
    words = F.split("p_name", " ")
    return upper_type(
        table(spark, sf_dir, "part")
        .select(F.initcap("p_type").alias("type"), F.col("p_brand").alias("topic"),
                title_case(words[1]).alias("root_subtopic"), words[0].alias("mod"),
                (F.col("p_size") > 25).alias("big"))
        .groupBy("type", "topic", "root_subtopic")
        .agg(F.collect_set(F.when(F.col("big"), F.col("mod"))).alias("neg"),
             F.collect_set(F.when(~F.col("big"), F.col("mod"))).alias("pos"))
        .select("type", "topic", "root_subtopic",
                F.array_join(F.concat(F.array_sort("neg"), F.array(F.lit("Poor Experience with"))), ", ")
                .alias("negative_mods"),
                F.array_join(F.concat(F.array_sort("pos"), F.array(F.lit("Great Experience with"))), ", ")
                .alias("positive_mods")))


PART_LABELS = """part_labels AS (
  SELECT DISTINCT upper(p_type) AS entity, p_brand AS topic,
         CASE WHEN p_size > 25 THEN 'Pain Point' ELSE 'Moment of Delight' END AS type,
         upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' ||
         upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] AS subtopic
  FROM part)"""


@query("join_subtopic", f"""
WITH {PHRASES}
SELECT phrase_id, pp_mod, CASE WHEN length(pp_mod) > 20 THEN 'long ' || topic END AS subtopic FROM phrases""")
def join_subtopic(spark, sf_dir):
    phrases = _phrases(spark, sf_dir)
    labelled = phrases.where(F.length("pp_mod") > 20).select(
        F.col("phrase_id").alias("id"), F.concat(F.lit("long "), "topic").alias("subtopic"))
    repeated = labelled.withColumn("subtopic", F.concat("subtopic", F.lit(" (again)")))
    return join_labels(phrases, labelled.unionByName(repeated)).select(
        "phrase_id", "pp_mod", "subtopic")


@query("join_metadata", f"""
WITH {REVIEWS}, {PHRASES}
SELECT p.phrase_id, p.pp_mod, r.airline, r.ratings AS rating, r.review_language
FROM phrases p JOIN reviews r ON r.review_unique_id = p."Review_No"
WHERE r.ts >= TIMESTAMP '2024-01-02'""")
def join_meta(spark, sf_dir):
    meta = reviews(spark, sf_dir).select(
        F.col("review_unique_id").alias("Review_No"), "airline", "ts",
        F.col("ratings").alias("rating"), "review_language")
    return join_metadata(_phrases(spark, sf_dir), meta).where("ts >= '2024-01-02'").select(
        "phrase_id", "pp_mod", "airline", "rating", "review_language")


_CODES = {"src1": "RUH", "src2": "JED", "src4": "DMM"}


@query("place_lookup", """
SELECT doc_id, text, CASE source WHEN 'src1' THEN 'RUH' WHEN 'src2' THEN 'JED' ELSE 'DMM' END AS airport
FROM documents WHERE source IN ('src1', 'src2', 'src4')""")
def place_lookup(spark, sf_dir):
    return lookup_inner(table(spark, sf_dir, "documents"), "source", _CODES, "airport").select(
        "doc_id", "text", "airport")


@query("unmapped_values", """
SELECT DISTINCT source FROM documents WHERE source NOT IN ('src1', 'src2', 'src4')""")
def unmapped_values(spark, sf_dir):
    return unmapped(table(spark, sf_dir, "documents"), "source", _CODES)


@query("topic_candidates", f"""
WITH {PHRASES}, {PART_LABELS},
lists AS (SELECT topic, type, string_agg(DISTINCT subtopic, ', ' ORDER BY subtopic) AS candidates
          FROM part_labels WHERE entity = 'ECONOMY' GROUP BY topic, type)
SELECT p.phrase_id, l.topic, l.candidates FROM phrases p
JOIN lists l ON l.topic = replace(p.topic, 'src', 'Brand#') AND l.type = p.type""")
def topic_candidate_lists(spark, sf_dir):
    labels = taxonomy_labels(part_taxonomy(spark, sf_dir), "ECONOMY")
    phrases = _phrases(spark, sf_dir).withColumn(
        "topic", F.regexp_replace("topic", "src", "Brand#"))
    return topic_candidates(phrases, labels).select(
        "phrase_id", "topic", F.array_join("candidates", ", ").alias("candidates"))


@query("incremental_anti", """
SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def incremental_anti(spark, sf_dir):
    return new_only(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "doc_id").select(
        "doc_id", "text")


@query("valid_topic_semi", f"""
WITH {PHRASES}
SELECT phrase_id, replace(topic, 'src', 'Brand#') AS topic FROM phrases
WHERE replace(topic, 'src', 'Brand#') IN (SELECT p_brand FROM part WHERE p_type = 'PROMO' UNION ALL SELECT 'Others')""")
def valid_topic_semi(spark, sf_dir):
    phrases = _phrases(spark, sf_dir).withColumn(
        "topic", F.regexp_replace("topic", "src", "Brand#"))
    return in_topics(phrases, valid_topics(part_taxonomy(spark, sf_dir), "PROMO")).select(
        "phrase_id", "topic")


@query("taxonomy_labels", f"""
WITH {PART_LABELS} SELECT topic, type, subtopic FROM part_labels WHERE entity = 'SMALL'""")
def labels_of_taxonomy(spark, sf_dir):
    return taxonomy_labels(part_taxonomy(spark, sf_dir), "SMALL")


@query("topic_list", """
SELECT string_agg(topic, ', ' ORDER BY topic) || ', Others' AS topics
FROM (SELECT DISTINCT p_brand AS topic FROM part WHERE p_type = 'LARGE')""")
def topics_of_taxonomy(spark, sf_dir):
    return topic_list(part_taxonomy(spark, sf_dir), "LARGE")
