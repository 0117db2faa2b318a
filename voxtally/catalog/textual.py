"""Dates, text, labels, replies and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.registry import PHRASES, phrase_source, query, table
from voxtally.constants import PAIN, SENTIMENTS, TRANSLATION_BATCH
from voxtally.functions.dates import day_text, parse_mixed, parse_utc, strict_day, utc_day
from voxtally.functions.labels import label_format
from voxtally.functions.prompts import inject, numbered_prompt, render_record
from voxtally.functions.replies import flatten_reply, parse_numbered, parse_reply, strip_fence
from voxtally.functions.text import (
    concat_label, join_or_null, normalise, title_case, token_count, word_count,
)
from voxtally.operators.keys import batch_id
from voxtally.operators.phrases import explode_phrases
from voxtally.schemas import REPLY_REVIEWS

# Ways to write the time of an event, chosen by event type and day.
_WRITTEN_SPARK = {
    "view": "yyyy-MM-dd HH:mm:ss", "click": "dd/MM/yyyy", "purchase": "MMM d, yyyy",
    "signup": "d-M-yyyy H:mm",
}
# Further ways of exports, chosen by the event's number, each with its resolution in DuckDB's strftime.
_EXPORTS = (
    ("EEEE, MMMM d, yyyy", "%Y-%m-%d 00:00:00"), ("d-MMM-yyyy", "%Y-%m-%d 00:00:00"), ("MMMM yyyy", "%Y-%m-01 00:00:00"),
    ("d MMM yyyy h:mm a", "%Y-%m-%d %H:%M:00"), ("dd/MM/yy HH:mm", "%Y-%m-%d %H:%M:00"), ("d/M/yyyy'T'HH:mm", "%Y-%m-%d %H:%M:00"),
    ("dd/MM/yyyy HH:mm:ss'.0'", "%Y-%m-%d %H:%M:%S"), ("yyyyMMdd", "%Y-%m-%d 00:00:00"), ("yyyy-MM", "%Y-%m-01 00:00:00"),
    ("d'th' MMMM yyyy", "%Y-%m-%d 00:00:00"), ("dd/MM/yyyy hh:mm a", "%Y-%m-%d %H:%M:00"),
    ("yyyy-MM-dd hh:mm a", "%Y-%m-%d %H:%M:00"), ("d-MMM-yy", "%Y-%m-%d 00:00:00"), ("EEE, dd MMM yyyy HH:mm:ss 'GMT'", "%Y-%m-%d %H:%M:%S"),
)


def written_dates(spark, sf_dir):
    """Events with their time as text in mixed formats; `error` events have text that is no date
    in the first half of a month and month-first dates in the second.
    """
    text = F.when(F.dayofmonth("ts") > 12, F.date_format("ts", "MM/dd/yyyy")).otherwise("n/a")
    for kind, fmt in _WRITTEN_SPARK.items():
        text = F.when(F.col("event_type") == kind, F.date_format("ts", fmt)).otherwise(text)
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", text.alias("date"))


_MIXED = """CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN 'click' THEN strftime(ts, '%Y-%m-%d 00:00:00')
       WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d 00:00:00')
       WHEN 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:00')
       ELSE CASE WHEN day(ts) > 12 THEN strftime(ts, '%Y-%m-%d 00:00:00') END END"""


_EXPORTED = " ".join(f"WHEN {i} THEN strftime(ts, '{out}')" for i, (_, out) in enumerate(_EXPORTS))


@query("parse_mixed_date", f"""
SELECT event_id, {_MIXED} AS parsed FROM events
UNION ALL SELECT -1 - event_id, CASE event_id % {len(_EXPORTS)} {_EXPORTED} END FROM events""")
def parse_mixed_date(spark, sf_dir):
    text = F.lit(None).cast("string")
    for i, (fmt, _) in enumerate(_EXPORTS):
        text = F.when(F.col("event_id") % len(_EXPORTS) == i, F.date_format("ts", fmt)).otherwise(text)
    exports = table(spark, sf_dir, "events").select((-1 - F.col("event_id")).alias("event_id"), text.alias("date"))
    both = written_dates(spark, sf_dir).select("event_id", "date").unionByName(exports)
    return both.select(
        "event_id", F.date_format(parse_mixed(F.col("date")), "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("parse_utc", """
SELECT event_id, CASE event_type WHEN 'view' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN 'click' THEN strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S')
       WHEN 'purchase' THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
       WHEN 'signup' THEN strftime(ts, '%Y-%m-%d 00:00:00') END AS instant
FROM events
UNION ALL SELECT -1 - event_id, CASE event_id % 8 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
  WHEN 2 THEN strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d %H:%M:00') WHEN 3 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
  WHEN 4 THEN strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:00') WHEN 5 THEN strftime(ts, '%Y-%m-%d %H:%M:00')
  WHEN 6 THEN strftime(ts, '%Y-%m-%d 00:00:00') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END FROM events""")
def parse_utc_time(spark, sf_dir):
    def written(fmt, suffix=""):
        return F.concat(F.date_format("ts", fmt), F.lit(suffix))

    text = (F.when(F.col("event_type") == "view", written("yyyy-MM-dd'T'HH:mm:ss", "Z"))
            .when(F.col("event_type") == "click", written("yyyy-MM-dd'T'HH:mm:ss", "+03:00"))
            .when(F.col("event_type") == "purchase", written("yyyy-MM-dd HH:mm:ss"))
            .when(F.col("event_type") == "signup", written("yyyy-MM-dd"))
            .otherwise("soon"))
    events = table(spark, sf_dir, "events")
    # Times of posts: with the year last, with half-day clocks month first, with an offset behind, and so on.
    forms = (("EEE MMM dd HH:mm:ss '+0000' yyyy", ""), ("MM/dd/yyyy hh:mm:ss a", ""), ("MM/dd/yyyy HH:mm", " -0500"), ("yyyy/MM/dd HH:mm", ""),
             ("yyyy-MM-dd HH:mm", " +03:00"), ("yyyy-MM-dd hh:mm a", ""), ("d-MMM-yy", ""), ("EEE, dd MMM yyyy HH:mm:ss", " GMT"))
    posts = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        posts = F.when(F.col("event_id") % len(forms) == i, written(*form)).otherwise(posts)
    rows = events.select("event_id", text.alias("text")).union(events.select(-1 - F.col("event_id"), posts))
    return rows.select(
        "event_id", F.date_format(parse_utc(F.col("text")), "yyyy-MM-dd HH:mm:ss").alias("instant"))


@query("format_date", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day,
       CASE WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-%d') END AS reread
FROM events""")
def format_date(spark, sf_dir):
    text = F.when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd")).otherwise(
        F.date_format("ts", "dd.MM.yyyy"))
    return table(spark, sf_dir, "events").select(
        "event_id", day_text(F.col("ts")).alias("day"),
        day_text(strict_day(text)).alias("reread"))


@query("utc_date", """
SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d') AS day FROM events""")
def utc_date(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+03:00"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format(utc_day(parse_utc(text)), "yyyy-MM-dd").alias("day"))


@query("normalise_text", r"""
SELECT doc_id, regexp_replace(lower(text), '^\s+|\s+$', '', 'g') AS clean FROM documents""")
def normalise_text(spark, sf_dir):
    padded = F.concat(F.lit("\t \n"), "text", F.lit(" \r\n"))
    return table(spark, sf_dir, "documents").select("doc_id", normalise(padded).alias("clean"))


@query("explode_phrases", f"WITH {PHRASES} SELECT * FROM phrases")
def explode(spark, sf_dir):
    return explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)


@query("explode_phrases_raw", r"""
SELECT doc_id AS "Review_No", 'neutral' AS sentiment, source AS topic,
       regexp_replace(lower(unnest(string_split(text, ','))), '^\s+|\s+$', '', 'g') AS pp_mod, 'Pain Point' AS type
FROM documents""")
def explode_raw(spark, sf_dir):
    return explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN, keep_empty=True)


@query("title_case", r"""
SELECT doc_id, array_to_string([upper(w[1]) || w[2:] FOR w IN
       regexp_extract_all(lower(replace(text, 'ß', 'ss')), '(\p{L}+|[^\p{L}]+)', 1)], '') AS title
FROM documents""")
def title(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", title_case(F.replace("text", F.lit("ß"), F.lit("ss"))).alias("title"))


@query("label_format", r"""
SELECT p_partkey, CASE p_type
  WHEN 'ECONOMY' THEN upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' || split_part(p_name, ' ', 2)
  WHEN 'SMALL' THEN split_part(p_name, ' ', 2)
  WHEN 'LARGE' THEN 'Well made-' || split_part(p_name, ' ', 2)
  WHEN 'PROMO' THEN NULL
  ELSE p_name END AS label
FROM part""")
def format_labels(spark, sf_dir):
    words = F.split("p_name", " ")
    raw = (F.when(F.col("p_type") == "ECONOMY", F.concat(words[0], F.lit("-"), words[1]))
           .when(F.col("p_type") == "SMALL", F.concat(F.lit("Poor Experience with - "), words[1]))
           .when(F.col("p_type") == "LARGE", F.concat(F.lit("well-made-"), words[1]))
           .when(F.col("p_type") != "PROMO", F.concat(F.lit(" "), "p_name", F.lit(" "))))
    # `well-made-x` is cut at its first hyphen: `Well made-x`; title case applies to the left part.
    return table(spark, sf_dir, "part").select("p_partkey", label_format(raw).alias("label"))


@query("concat_label", """
SELECT p_partkey, CASE WHEN p_size > 10 THEN p_type || ' - ' || p_name END AS label FROM part""")
def concat_labels(spark, sf_dir):
    mod = F.when(F.col("p_size") > 10, F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", concat_label(mod, F.col("p_name"), " - ").alias("label"))


@query("join_or_null", """
SELECT doc_id, CASE WHEN lang = 'en' THEN replace(text, ' ', ', ') END AS joined FROM documents""")
def join_list(spark, sf_dir):
    words = F.when(F.col("lang") == "en", F.split("text", " ")).otherwise(
        F.array().cast("array<string>"))
    return table(spark, sf_dir, "documents").select("doc_id", join_or_null(words).alias("joined"))


@query("word_count", r"""
SELECT doc_id, CAST(len([w FOR w IN string_split_regex(text, '\s+') IF w <> '']) AS INTEGER) AS words
FROM documents""")
def count_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", word_count(F.col("text")).alias("words"))


@query("token_count", r"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '\p{L}[\p{L}\p{N}]*|\p{N}+|[^\s\p{L}\p{N}]')) AS INTEGER) AS tokens
FROM documents""")
def count_tokens(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", token_count(F.col("text")).alias("tokens"))


@query("strip_fence", r"""
SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS reply FROM documents""")
def fences(spark, sf_dir):
    fenced = F.when(F.col("lang") == "en", F.concat(F.lit("```json\n"), "text", F.lit("\n```"))).when(
        F.col("lang") == "fr", F.concat(F.lit(" ```\n"), "text", F.lit("\n``` "))).otherwise(
        F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", strip_fence(fenced).alias("reply"))


@query("parse_numbered", rf"""
WITH clean AS (
  SELECT doc_id, [regexp_replace(x, '^\s+|\s+$', '', 'g') FOR x IN string_split(text, chr(10))] AS lines
  FROM documents)
SELECT doc_id, n - 1 AS pos, CASE WHEN n % 7 <> 3 THEN nullif(lines[n], '') END AS line
FROM clean, range(1, {TRANSLATION_BATCH + 1}) t(n)""")
def numbered_lines(spark, sf_dir):
    lines = F.split("text", "\n")
    reply = F.array_join(F.transform(
        lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    # Blank lines stay blank, as a model would leave them; it also skips every seventh line, repeats a
    # number and adds one that was not asked.
    reply = F.regexp_replace(reply, r"(?m)^\d+\.[ \t]*$", "")
    reply = F.regexp_replace(reply, r"(?m)^(3|10|17)\. .*$", "")
    reply = F.concat(reply, F.lit("\n1. again\n99. unasked"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.posexplode(parse_numbered(reply, TRANSLATION_BATCH)).alias("pos", "line")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def replies(spark, sf_dir):
    """One JSON reply per document: English ones are good and fenced, French ones cut off, German
    ones carry an unknown sentiment, Spanish ones lack it.
    """
    sentiment = (F.when(F.col("lang") == "de", "angry").when(F.col("lang") == "es", None)
                 .otherwise("neutral"))
    record = F.struct(
        F.col("doc_id").cast("string").alias("id"), sentiment.alias("sentiment"),
        F.array(F.struct(
            F.col("source").alias("topic"), F.array("text").alias("pain_points"),
            F.array().cast("array<string>").alias("moments_of_delight"))).alias("topics"))
    text = F.to_json(F.struct(F.array(record).alias("reviews")))
    cut = F.substring(text, F.lit(1), F.length(text) - 5)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("lang") == "fr", cut).when(
            F.col("lang") == "en", F.concat(F.lit("```json\n"), text, F.lit("\n```"))).otherwise(text)
        .alias("reply"))


@query("parse_reply", """
SELECT doc_id, CASE lang WHEN 'en' THEN 'good' WHEN 'fr' THEN 'truncated' WHEN 'de' THEN 'invalid'
       ELSE 'missing' END AS outcome
FROM documents""")
def parse_replies(spark, sf_dir):
    good, rejects = parse_reply(
        replies(spark, sf_dir), "reply", REPLY_REVIEWS, {"sentiment": SENTIMENTS})
    return good.select("doc_id", F.lit("good").alias("outcome")).unionByName(
        rejects.select("doc_id", F.col("reject_reason").alias("outcome")))


@query("flatten_reply", """
SELECT CAST(doc_id AS VARCHAR) AS id, 'neutral' AS sentiment, source AS topic, text AS pain_points,
       NULL AS moments_of_delight
FROM documents WHERE lang = 'en'""")
def flatten(spark, sf_dir):
    good, _ = parse_reply(
        replies(spark, sf_dir), "reply", REPLY_REVIEWS, {"sentiment": SENTIMENTS})
    return flatten_reply(good, "reviews").select(
        "id", "sentiment", "topic", join_or_null(F.col("pain_points")).alias("pain_points"),
        join_or_null(F.col("moments_of_delight")).alias("moments_of_delight"))


@query("render_record", """
SELECT doc_id, 'Review_Number: ' || doc_id || chr(10) || 'Language: ' || lang || chr(10) || 'Review: ' || text AS message
FROM documents""")
def render(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", render_record(
        ("Review_Number", F.col("doc_id")), ("Language", F.col("lang")),
        ("Review", F.col("text"))).alias("message"))


@query("inject_template", """
SELECT doc_id, '{"id": ' || doc_id || ', "topics": [{topics}], "text": ' || text || '}' AS prompt
FROM documents""")
def inject_values(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", inject(
        '{"id": {id}, "topics": [{topics}], "text": {text}}',
        id=F.col("doc_id").cast("string"), text=F.col("text")).alias("prompt"))


@query("numbered_prompt", rf"""
WITH b AS (SELECT doc_id, text, (row_number() OVER (ORDER BY doc_id) - 1) // {TRANSLATION_BATCH} + 1 AS batch,
                  (row_number() OVER (ORDER BY doc_id) - 1) % {TRANSLATION_BATCH} + 1 AS n FROM documents)
SELECT batch, string_agg(n || '. ' || regexp_replace(text, '\s*[\r\n]+\s*', ' ', 'g'), chr(10) ORDER BY n) AS prompt
FROM b GROUP BY batch""")
def prompts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return numbered_prompt(
        batch_id(docs, ["doc_id"], TRANSLATION_BATCH), "batch", "doc_id", "text")
