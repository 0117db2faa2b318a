"""Feed preparation and dashboard tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.aggregates import LABELLED, labelled_phrases, rules_sql
from voxtally.catalog.models import comments, picking_model, reading_model
from voxtally.catalog.registry import (
    LEXICON, REVIEWS, detect_sql, extraction_sql, label_rows, overlap_sql, query, quoted, reviews, stacked_sql, taxonomy, values,
)
from voxtally.catalog.textual import _MIXED, written_dates
from voxtally.constants import AIRPORT_COLUMNS, LANGUAGE_NAMES, OTHERS, POST_LABELS
from voxtally.functions.prompts import render_record
from voxtally.operators.extract import model_extract, rule_extract
from voxtally.operators.mapping import map_by_model, map_by_overlap
from voxtally.operators.phrases import stack_phrases
from voxtally.plans.final import (
    AIRLINES, AIRPORTS, FinalConfig, final_table, place_metadata, review_metadata,
)
from voxtally.plans.prep import prep_places, prep_posts, prep_reviews, prep_survey
from voxtally.plans.social import social_final
from voxtally.session import shared_path
from voxtally.sources.files import write_table
from voxtally.sources.taxonomy import taxonomy_labels

MIN_DAY = "2024-01-02"
_LANGUAGES = "CASE lower(trim(review_language)) " + " ".join(
    f"WHEN {quoted(c)} THEN {quoted(n)}" for c, n in LANGUAGE_NAMES.items()
) + " ELSE review_language END"


@query("prep_reviews", f"""
WITH dated AS (SELECT user_id, event_id, event_type, CAST({_MIXED} AS TIMESTAMP) AS date FROM events),
latest AS (SELECT * FROM dated
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date DESC NULLS LAST, event_id) = 1)
SELECT CAST(user_id AS VARCHAR) AS review_unique_id, event_id, strftime(date, '%Y-%m-%d') AS date
FROM latest WHERE lower(event_type) = 'view' AND date >= TIMESTAMP '2024-01-02'""")
def prepared_reviews(spark, sf_dir):
    raw = written_dates(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("review_unique_id"),
        F.initcap("event_type").alias("data_source"), "event_id", "date")
    return prep_reviews(raw, "view", MIN_DAY, tiebreak=["event_id"]).select(
        "review_unique_id", "event_id", "date")


PLACES = {"src1": "RUH", "src2": "JED", "src4": "DMM", "src5": "RUH", "src7": "JED"}


def raw_places(spark, sf_dir):
    """Documents as map reviews, every one listed twice."""
    rows = reviews(spark, sf_dir).select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
        .alias("PUBLISHED AT DATETIME"),
        F.col("data_source").alias("PLACE NAME"), F.col("ratings").alias("SCORE"),
        F.col("translated_text").alias("TEXT"),
        F.when(F.col("airline") != "line0", F.col("raw_text")).otherwise("").alias("ORIGINAL TEXT"),
        F.col("review_language").alias("LANG"), F.lit("maps").alias("ORIGIN"))
    return rows.unionByName(rows)


PREPARED_PLACES = f"""{REVIEWS},
raw_places AS (
  SELECT DISTINCT CASE data_source WHEN 'src1' THEN 'RUH' WHEN 'src2' THEN 'JED' WHEN 'src4' THEN 'DMM'
                  WHEN 'src5' THEN 'RUH' WHEN 'src7' THEN 'JED' END AS airport,
         date_trunc('second', ts) - INTERVAL 3 HOUR AS published, translated_text AS text, ratings AS score_x,
         review_language, CASE WHEN airline <> 'line0' THEN raw_text ELSE '' END AS original_text
  FROM reviews),
places AS (
  SELECT *, row_number() OVER (ORDER BY published, airport, text, original_text) AS review_no
  FROM raw_places WHERE airport IS NOT NULL AND published >= TIMESTAMP '2024-01-02')"""


@query("prep_places", f"""
WITH {PREPARED_PLACES}
SELECT review_no AS "Review_No", airport AS "Airport", strftime(published, '%Y-%m-%d %H:%M:%S') AS published,
       text, score_x, review_language AS lang, original_text, 'maps' AS origin
FROM places""")
def prepared_places(spark, sf_dir):
    return prep_places(raw_places(spark, sf_dir), PLACES, MIN_DAY).select(
        "Review_No", "Airport",
        F.date_format("published_at_datetime_x", "yyyy-MM-dd HH:mm:ss").alias("published"),
        "text", "score_x", "lang", "original_text", "origin")


def raw_posts(spark, sf_dir):
    """Documents as posts, each with a second copy of a later time."""
    rows = reviews(spark, sf_dir).select(
        F.col("review_unique_id").alias("INTERNAL UNIQUE ID"), F.col("raw_text").alias("CONTENT"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("PUBLISHED AT"))
    later = rows.withColumn("CONTENT", F.concat(F.lit("again "), "CONTENT")).withColumn(
        "PUBLISHED AT", F.lit("2025-01-01T00:00:00Z"))
    return rows.unionByName(later)


_LABEL, _ENTITY = rules_sql("raw_text")


@query("prep_posts", f"""
WITH {REVIEWS}
SELECT review_unique_id AS "INTERNAL UNIQUE ID", raw_text AS "CONTENT",
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS published, {_LABEL} AS label, {_ENTITY} AS main_entity
FROM reviews""")
def prepared_posts(spark, sf_dir):
    return prep_posts(raw_posts(spark, sf_dir)).select(
        "INTERNAL UNIQUE ID", "CONTENT",
        F.date_format("PUBLISHED AT", "yyyy-MM-dd HH:mm:ss").alias("published"),
        "label", "main_entity")


@query("prep_survey", r"""
SELECT conv_id || '-' || turn AS id, role AS channel, text AS comment,
       CAST(len([w FOR w IN string_split_regex(text, '\s+') IF w <> '']) AS INTEGER) AS number_of_words,
       CAST(len(regexp_extract_all(text, '\p{L}[\p{L}\p{N}]*|\p{N}+|[^\s\p{L}\p{N}]')) AS INTEGER) AS number_of_tokens
FROM conversations WHERE length(text) > 5""")
def prepared_survey(spark, sf_dir):
    return prep_survey(comments(spark, sf_dir))


# --- social --------------------------------------------------------------------------------------

POST_RULES = (
    ("AIRPORT", "RUH", ("trash", "la ")),
    ("AIRLINE", "saudia", ("scum", "the ")),
    ("AIRLINE", "Unknown", ("der ",)),
)
_RULED, _RULED_ENTITY = rules_sql("raw_text", POST_RULES)


def _social(spark, sf_dir):
    posts = prep_posts(raw_posts(spark, sf_dir), POST_RULES)
    return social_final(
        posts, POST_LABELS[0], LEXICON, taxonomy_labels(taxonomy(spark), "AIRLINE"),
        FinalConfig(AIRLINES.columns), "airline")


SOCIAL = f"""ruled AS (
  SELECT review_unique_id, raw_text, ts, {_RULED} AS label, {_RULED_ENTITY} AS entity FROM reviews),
chosen AS (SELECT * FROM ruled WHERE label = 'AIRLINE'),
{extraction_sql('chosen', 'review_unique_id', 'raw_text', 'post_extraction')},
{stacked_sql('post_extraction', 'post_phrases')},
{overlap_sql('post_phrases', 'post_labelled')},
{detect_sql('chosen', 'review_unique_id', 'raw_text')},
social AS (
  SELECT p."Review_No", p.sentiment, p.topic, p.pp_mod, p.subtopic, p.type, 'X' AS data_source,
         c.entity AS airline, strftime(c.ts, '%Y-%m-%d') AS date, NULL::DOUBLE AS rating,
         d.lang_name AS "Original Review Language", c.raw_text AS "Original Review", c.raw_text AS "Translated Review"
  FROM post_labelled p JOIN chosen c ON c.review_unique_id = p."Review_No"
  JOIN detected d ON d.review_unique_id = p."Review_No")"""


@query("social_final", f"WITH {REVIEWS}, {SOCIAL} SELECT * FROM social")
def social(spark, sf_dir):
    return _social(spark, sf_dir)


_FIRST_LABELS = f"""post_phrases_labels AS (
  SELECT topic, type, min(label) AS label FROM (VALUES {values(label_rows())}) t(topic, type, label) GROUP BY topic, type)"""


@query("social_final_by_model", f"""
WITH {REVIEWS}, ruled AS (
  SELECT review_unique_id, raw_text, ts, {_RULED} AS label, {_RULED_ENTITY} AS entity FROM reviews),
chosen AS (SELECT * FROM ruled WHERE label = 'AIRLINE'),
{extraction_sql('chosen', 'review_unique_id', 'raw_text', 'post_extraction')},
{stacked_sql('post_extraction', 'post_phrases')}, {_FIRST_LABELS},
{detect_sql('chosen', 'review_unique_id', 'raw_text')}
SELECT p."Review_No", p.sentiment, p.topic, p.pp_mod,
       CASE WHEN l.topic IS NULL THEN NULL WHEN contains(p.pp_mod, 'the') THEN 'Others' ELSE l.label END AS subtopic, p.type, 'X' AS data_source,
       c.entity AS airline, strftime(c.ts, '%Y-%m-%d') AS date, NULL::DOUBLE AS rating,
       d.lang_name AS "Original Review Language", c.raw_text AS "Original Review", c.raw_text AS "Translated Review"
FROM post_phrases p JOIN chosen c ON c.review_unique_id = p."Review_No" JOIN detected d ON d.review_unique_id = p."Review_No"
LEFT JOIN post_phrases_labels l ON l.topic = p.topic AND l.type = p.type""")
def social_by_model(spark, sf_dir):
    """Extraction and labels by stand-in models; each distinct text and each distinct phrase is asked once."""
    def extract(rows):
        messages = rows.select("post", render_record(("Review_Number", F.col("post")), ("Review", F.col("Original Review"))).alias("message"))
        topics = sorted({topic for _, _, topic in LEXICON} | {OTHERS})
        return model_extract(messages, "post", "message", "Extract.", reading_model(LEXICON), topics)

    def mapper(phrases, labels):
        return map_by_model(phrases, labels, "Sort each {type} into one of: {subtopics}", picking_model(), shared_path(spark, "labels"))

    posts = prep_posts(raw_posts(spark, sf_dir), POST_RULES)
    return social_final(
        posts, POST_LABELS[0], LEXICON, taxonomy_labels(taxonomy(spark), "AIRLINE"), FinalConfig(AIRLINES.columns), "airline",
        extract=extract, mapper=mapper)


# --- dashboard tables ----------------------------------------------------------------------------

@query("final_airlines", f"""
WITH {REVIEWS}, {SOCIAL}, {LABELLED}
SELECT l."Review_No", l.sentiment, l.topic, l.pp_mod, l.subtopic, l.type, r.data_source, r.airline,
       strftime(r.ts, '%Y-%m-%d') AS date, r.ratings AS rating, {_LANGUAGES} AS "Original Review Language",
       r.raw_text AS "Original Review", r.translated_text AS "Translated Review"
FROM labelled l JOIN reviews r ON r.review_unique_id = l."Review_No"
WHERE CAST(r.ts AS DATE) >= DATE '2024-01-02'
UNION ALL
SELECT "Review_No", sentiment, topic, pp_mod, subtopic, type, data_source, airline, date, rating,
       "Original Review Language", "Original Review", "Translated Review" FROM social""")
def final_airlines(spark, sf_dir):
    stored = shared_path(spark, "social")
    write_table(_social(spark, sf_dir), stored)
    prepared = reviews(spark, sf_dir).withColumn("date", F.to_date("ts"))
    # Extraction is stored once; phrases and labels are both read from it, as in a real run.
    phrases = shared_path(spark, "phrases")
    write_table(labelled_phrases(spark, sf_dir), phrases)
    labelled = spark.read.parquet(phrases)
    return final_table(
        labelled.drop("subtopic"),
        labelled.select(F.col("phrase_id").alias("id"), "subtopic"),
        review_metadata(prepared), FinalConfig(AIRLINES.columns, min_date=MIN_DAY), stored)


@query("final_airports", f"""
WITH {PREPARED_PLACES}, {extraction_sql('places', 'review_no', 'text')}, {stacked_sql()}, {overlap_sql()}
SELECT l."Review_No", l.sentiment, CASE l.topic WHEN 'Baggage' THEN 'Baggage Services' ELSE l.topic END AS topic,
       l.pp_mod, l.type, p.airport AS "Airport", strftime(p.published, '%Y-%m-%d') AS date, p.score_x AS rating,
       'maps' AS data_source, {_LANGUAGES} AS "Original Review Language",
       CASE WHEN p.original_text <> '' THEN p.original_text ELSE p.text END AS "Original Review",
       p.text AS "Translated Review", l.subtopic
FROM labelled l JOIN places p ON CAST(p.review_no AS VARCHAR) = l."Review_No" """)
def final_airports(spark, sf_dir):
    places = prep_places(raw_places(spark, sf_dir), PLACES, MIN_DAY)
    phrases = map_by_overlap(
        stack_phrases(rule_extract(places, "Review_Key", "text", LEXICON)),
        taxonomy_labels(taxonomy(spark), "AIRLINE"))
    return final_table(phrases, None, place_metadata(places, "Review_Key", MIN_DAY),
                       FinalConfig(AIRPORT_COLUMNS, AIRPORTS.topic_renames, MIN_DAY))
