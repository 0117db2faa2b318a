"""Model operators with stand-in models: deterministic functions that answer like one."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxtally.catalog.aggregates import labelled_phrases, rules_sql
from voxtally.catalog.joining import PART_LABELS, part_taxonomy
from voxtally.catalog.registry import (
    LEXICON, PHRASES, detect_sql, extraction_sql, overlap_sql, phrase_source, query, quoted, stacked_sql, table,
    values,
)
from voxtally.constants import OTHERS, PAIN
from voxtally.functions.prompts import render_record
from voxtally.functions.text import join_or_null
from voxtally.operators.classify import classify_fallback, keyword_classify
from voxtally.operators.extract import model_extract, rule_extract
from voxtally.operators.infer import infer_batches
from voxtally.operators.language import detect_language, enrich_language, translate
from voxtally.operators.mapping import map_by_model, map_fixed, map_fixed_by_model
from voxtally.operators.phrases import explode_phrases
from voxtally.operators.runlog import RunLog
from voxtally.operators.survey import induce_topics
from voxtally.operators.taxonomy_jobs import clean_labels, expand_seed
from voxtally.plans.survey import survey_flow, survey_messages
from voxtally.schemas import EXTRACTED
from voxtally.session import shared_path
from voxtally.sources.taxonomy import taxonomy_labels


# --- language ------------------------------------------------------------------------------------

@query("detect_language", f"WITH {detect_sql()} SELECT doc_id, lang_code, lang_name FROM detected")
def detect(spark, sf_dir):
    return detect_language(table(spark, sf_dir, "documents"), "text").select(
        "doc_id", "lang_code", "lang_name")


def english_model():
    """Translator stand-in: repeats each numbered line behind `EN`."""
    def predict(instruction, messages):
        import re

        return "\n".join(re.sub(r"^(\d+)\. ", r"\1. EN ", line) for line in messages[0].split("\n"))

    return predict


ONE_LINE = r"regexp_replace(regexp_replace(text, '\s*[\r\n]+\s*', ' ', 'g'), '\s+$', '')"


@query("translate_batches", f"SELECT doc_id, 'EN ' || {ONE_LINE} AS translated FROM documents")
def translate_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return translate(docs, "doc_id", "text", english_model(), "Translate to English.").select(
        "doc_id", "translated")


@query("enrich_language", rf"""
WITH {detect_sql()}
SELECT doc_id, lang_name AS "Original Review Language",
       CASE WHEN lang_code = 'en' THEN text ELSE 'EN ' || {ONE_LINE} END AS "Translated Review"
FROM detected""")
def enrich(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("Original Review"))

    def translator(rows):
        return translate(rows, "doc_id", "_foreign", english_model(), "Translate to English.")

    return enrich_language(docs, translator=translator).select(
        "doc_id", "Original Review Language", "Translated Review")


# --- extraction ----------------------------------------------------------------------------------

_EXTRACTION = f"""
WITH {extraction_sql('documents', 'doc_id', 'text')}
SELECT review_id, sentiment, topic, nullif(array_to_string(pains, ', '), '') AS pain_points,
       nullif(array_to_string(delights, ', '), '') AS moments_of_delight
FROM extraction"""


def _joined(extraction):
    return extraction.select(
        "review_id", "sentiment", "topic",
        join_or_null(F.col("pain_points")).alias("pain_points"),
        join_or_null(F.col("moments_of_delight")).alias("moments_of_delight"))


@query("extract_sentiment", _EXTRACTION)
def extract(spark, sf_dir):
    return _joined(rule_extract(table(spark, sf_dir, "documents"), "doc_id", "text", LEXICON))


def reading_model(lexicon, records="reviews"):
    """Extraction stand-in: looks the lexicon up in each message and answers in fenced JSON. It
    calls the topic `Others` `Misc`, which is no valid topic, and repeats the first record.
    """
    entries = list(lexicon)

    def predict(instruction, messages):
        import json

        answers = []
        for message in messages:
            key, text = message.split("\n", 1)
            text = text.lower()
            topics = {}
            for phrase, kind, topic in entries:
                if phrase in text:
                    found = topics.setdefault(topic, {"pain": [], "delight": []})
                    if len(found[kind]) < 3:
                        found[kind].append(phrase)
            ordered = [t for t in dict.fromkeys(t for _, _, t in entries) if t in topics]
            balance = sum(len(f["delight"]) - len(f["pain"]) for f in topics.values())
            answers.append({
                "id": key.split(": ", 1)[1],
                "sentiment": "positive" if balance > 0 else "negative" if balance < 0 else "neutral",
                "topics": [{"topic": t, "pain_points": topics[t]["pain"],
                            "moments_of_delight": topics[t]["delight"]} for t in ordered]
                or [{"topic": "Misc", "pain_points": [], "moments_of_delight": []}]})
        return "```json\n" + json.dumps({records: answers + answers[:1]}, ensure_ascii=False) + "\n```"

    return predict


@query("extract_by_model", _EXTRACTION)
def extract_by_model(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", render_record(
        ("Review_Number", F.col("doc_id")), ("Review", F.col("text"))).alias("message"))
    topics = sorted({topic for _, _, topic in LEXICON} | {OTHERS})
    return _joined(model_extract(
        docs, "doc_id", "message", "Extract.", reading_model(LEXICON), topics))


@query("infer_batches", """
SELECT CAST(doc_id AS VARCHAR) AS id, source, source <> 'src7' AS ok,
       CASE WHEN source = 'src7' THEN 2 ELSE 1 END AS attempts,
       CASE WHEN source = 'src7' THEN 'RuntimeError: busy' END AS error
FROM documents""")
def infer(spark, sf_dir):
    def predict(instruction, messages):
        import json

        if instruction == "src7":
            raise RuntimeError("busy")
        return json.dumps({"count": len(messages)})

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    batches = infer_batches(docs, "doc_id", "text", predict, F.col("source"), ["source"],
                            retries=2, backoff=0.0)
    return batches.select(
        F.explode("record_ids").alias("id"), "source", "ok", "attempts", "error")


def unsteady_model(down):
    """Extraction stand-in for groups: sources in `down` cannot be reached, `src3` answers with broken JSON, `src5`
    leaves out the messages with an even number.
    """
    def predict(instruction, messages):
        import json

        if instruction in down:
            raise RuntimeError("busy")
        if instruction == "src3":
            return '{"reviews": [}]}'
        ids = [message.split("\n", 1)[0].split(": ", 1)[1] for message in messages]
        return json.dumps({"reviews": [
            {"id": i, "sentiment": "neutral", "topics": []} for i in ids if instruction != "src5" or int(i) % 2]})

    return predict


@query("infer_failures", """
WITH failed AS (
  SELECT doc_id, source, CASE source WHEN 'src7' THEN 'call' WHEN 'src3' THEN 'malformed' ELSE 'unanswered' END AS reason
  FROM documents WHERE source IN ('src3', 'src7') OR (source = 'src5' AND doc_id % 2 = 0))
SELECT run, CAST(doc_id AS VARCHAR) AS review_id, reason, CASE reason WHEN 'call' THEN 'RuntimeError: busy' END AS error,
       CASE reason WHEN 'call' THEN 2 ELSE 1 END AS attempts
FROM failed, (VALUES (1), (2)) r(run) WHERE run = 1 OR source <> 'src7'""")
def infer_failures(spark, sf_dir):
    """What is open after a run in which a source could not be reached, and after the next one."""
    store = shared_path(spark, "answers")
    log = RunLog(spark, store, "review_id", EXTRACTED)
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", render_record(
        ("Review_Number", F.col("doc_id")), ("Review", F.col("text"))).alias("message"))
    found = []
    for run, down in ((1, ("src7",)), (2, ())):
        model_extract(docs, "doc_id", "message", F.col("source"), unsteady_model(down), store=store,
                      group_cols=["source"], retries=2, backoff=0.0)
        path = shared_path(spark, "failures")
        log.failures().withColumn("run", F.lit(run)).write.parquet(path)
        found.append(spark.read.parquet(path).select("run", "review_id", "reason", "error", "attempts"))
    return found[0].unionByName(found[1])


# --- labels --------------------------------------------------------------------------------------

@query("map_subtopic", f"""
WITH {extraction_sql('documents', 'doc_id', 'text')}, {stacked_sql()}, {overlap_sql()}
SELECT phrase_id, topic, type, pp_mod, subtopic FROM labelled""")
def map_subtopic(spark, sf_dir):
    return labelled_phrases(spark, sf_dir).select(
        "phrase_id", "topic", "type", "pp_mod", "subtopic")


def picking_model():
    """Label stand-in: picks the first allowed label, or an unknown one for phrases with `the`."""
    def predict(instruction, messages):
        import json

        first = instruction.split("one of: ", 1)[1].split(", ")[0]
        answers = []
        for message in messages:
            key, phrase = message.split("\n", 1)
            answers.append({"id": key.split(": ", 1)[1],
                            "subtopic": "Something Else" if "the" in phrase else first})
        return json.dumps({"reviews": answers})

    return predict


@query("map_subtopic_by_model", f"""
WITH {PHRASES}, {PART_LABELS},
lists AS (SELECT topic, type, min(subtopic) AS first_label FROM part_labels WHERE entity = 'MEDIUM' GROUP BY topic, type)
SELECT p.phrase_id, p.pp_mod, CASE WHEN l.topic IS NULL THEN NULL WHEN contains(p.pp_mod, 'the') THEN 'Others'
       ELSE l.first_label END AS subtopic
FROM phrases p LEFT JOIN lists l ON l.topic = replace(p.topic, 'src', 'Brand#') AND l.type = p.type""")
def map_subtopic_by_model(spark, sf_dir):
    phrases = explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN).withColumn(
        "topic", F.regexp_replace("topic", "src", "Brand#"))
    labels = taxonomy_labels(part_taxonomy(spark, sf_dir), "MEDIUM")
    return map_by_model(
        phrases, labels, "Sort each {type} into one of: {subtopics}", picking_model(),
        shared_path(spark, "labels")).select("phrase_id", "pp_mod", "subtopic")


SURVEY_LABELS = (
    "Agent the Behaviour", "Der Die Das Process", "Los Response Con", "Website Une Des Les",
    "Thanedble Support", "Worthless Channel", "Of And To Timeliness",
)


@query("survey_map_fixed", rf"""
WITH labels AS (SELECT * FROM (VALUES {values((label,) for label in SURVEY_LABELS)}) t(label)),
tokens AS (SELECT DISTINCT label, unnest(string_split_regex(lower(label), '[^\p{{L}}]+')) AS token FROM labels),
{PHRASES},
wordy AS (SELECT DISTINCT phrase_id, unnest(string_split_regex(pp_mod, '[^\p{{L}}]+')) AS token FROM phrases),
scores AS (SELECT w.phrase_id, t.label, count(*) AS n FROM wordy w JOIN tokens t ON t.token = w.token AND w.token <> '' GROUP BY ALL),
best AS (SELECT phrase_id, label FROM scores QUALIFY row_number() OVER (PARTITION BY phrase_id ORDER BY n DESC, label) = 1)
SELECT p.phrase_id, p.topic, p.pp_mod, coalesce(b.label, 'Other') AS subtopic
FROM phrases p LEFT JOIN best b ON b.phrase_id = p.phrase_id""")
def survey_map_fixed(spark, sf_dir):
    phrases = explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)
    return map_fixed(phrases, SURVEY_LABELS).select("phrase_id", "topic", "pp_mod", "subtopic")


def standardising_model(labels):
    """Survey label stand-in: phrases with `the` get the first label, others a label of no list."""
    first = labels[0]

    def predict(instruction, messages):
        import json

        answers = []
        for message in messages:
            item, topic = message.rsplit("\n", 1)
            phrase = item.split(": ", 1)[1]
            answers.append({"pain_point": phrase, "topic": topic.split(": ", 1)[1],
                            "subtopic": first if "the" in phrase else "Anything"})
        return json.dumps({"reviews": answers}, ensure_ascii=False)

    return predict


def both_sides_model(labels):
    """The survey label stand-in for pains and delights: the field of a reply has the name its side asks for."""
    pains = standardising_model(labels)

    def predict(instruction, messages):
        reply = pains(instruction, messages)
        return reply if messages[0].startswith("Pain Point: ") else reply.replace('"pain_point": ', '"mod": ')

    return predict


@query("survey_map_by_model", f"""
WITH {PHRASES}
SELECT phrase_id, topic, pp_mod, CASE WHEN contains(pp_mod, 'the') THEN {quoted(SURVEY_LABELS[0])} ELSE 'Other' END AS subtopic
FROM phrases""")
def survey_map_by_model(spark, sf_dir):
    phrases = explode_phrases(phrase_source(spark, sf_dir), "doc_id", "text", PAIN)
    return map_fixed_by_model(
        phrases, SURVEY_LABELS, "Sort each {item_singular} into one of: {subtopics}",
        standardising_model(SURVEY_LABELS), shared_path(spark, "labels")).select(
        "phrase_id", "topic", "pp_mod", "subtopic")


@query("clean_labels", """
SELECT upper(p_type) AS type, p_brand AS service,
       CASE p_type WHEN 'SMALL' THEN 'Great Experience with - ' || p_name WHEN 'LARGE' THEN p_name
       ELSE replace(p_name, ' ', ' - ') END AS old_subtopic,
       CASE WHEN p_type = 'SMALL' THEN 'Great ' ELSE '' END ||
       upper(p_name[1]) || split_part(p_name, ' ', 1)[2:] || ' ' ||
       upper(split_part(p_name, ' ', 2)[1]) || split_part(p_name, ' ', 2)[2:] ||
       CASE WHEN p_type = 'SMALL' THEN ' Experience' ELSE '' END AS cleaned_subtopic
FROM part""")
def clean(spark, sf_dir):
    raw = (F.when(F.col("p_type") == "SMALL", F.concat(F.lit("Great Experience with - "), "p_name"))
           .when(F.col("p_type") == "LARGE", F.col("p_name"))
           .otherwise(F.replace("p_name", F.lit(" "), F.lit(" - "))))
    return clean_labels(table(spark, sf_dir, "part").select(
        F.upper("p_type").alias("type"), F.col("p_brand").alias("topic"), raw.alias("subtopic")))


@query("expand_taxonomy_seed", """
SELECT DISTINCT p_type AS type, p_brand AS topic, p_brand || ' Desk' AS root_subtopic,
       'slow, closed' AS negative_mods, NULL AS positive_mods
FROM part""")
def expand(spark, sf_dir):
    def predict(instruction, messages):
        import json

        kind, service = (line.split(": ", 1)[1] for line in messages[0].split("\n"))
        return json.dumps({"type": kind, "service": service, "subtopics": [
            {"root_subtopic": f"{service} Desk", "positive_mods": [],
             "negative_mods": ["slow", "closed"]}]})

    seed = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("CATEGORY_NAME"), F.col("p_type").alias("TYPE"))
    return expand_seed(seed, "Expand.", predict)


_LABEL, _ENTITY = rules_sql("text")


@query("classify_fallback", f"""
WITH ruled AS (SELECT doc_id, text, {_LABEL} AS label, {_ENTITY} AS entity FROM documents)
SELECT doc_id, CASE WHEN entity = 'Unknown' AND contains(text, 'worthless') THEN 'AIRLINE' ELSE label END AS label,
       CASE WHEN entity = 'Unknown' AND contains(text, 'worthless') THEN 'flynas' ELSE entity END AS main_entity
FROM ruled""")
def fallback(spark, sf_dir):
    def predict(instruction, messages):
        import json

        answers = []
        for message in messages:
            key, text = message.split("\n", 1)
            if "worthless" in text:
                answers.append({"id": key.split(": ", 1)[1], "label": "AIRLINE",
                                "main_entity": "flynas"})
        return json.dumps({"tweets": answers})

    posts = keyword_classify(table(spark, sf_dir, "documents"), "text")
    return classify_fallback(posts, "doc_id", "text", "Classify.", predict).select(
        "doc_id", "label", "main_entity")


# --- survey --------------------------------------------------------------------------------------

def comments(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role").alias("channel"),
        F.col("text").alias("comment"))


def topic_model():
    """Survey stand-in: the topic is the channel, known from the second round on; the comment is a
    pain point when it is long and a delight when it is short.
    """
    def predict(instruction, messages):
        import json

        answers = []
        for message in messages:
            key, channel, comment = message.split("\n", 2)
            text = comment.split(": ", 1)[1]
            long = len(text) > 200
            answers.append({
                "id": key.split(": ", 1)[1], "sentiment": "negative" if long else "positive",
                "topics": [{"topic": channel.split(": ", 1)[1].title() + " Messages",
                            "pain_points": [text] if long else [],
                            "moments_of_delight": [] if long else [text]}]})
        return json.dumps({"comments": answers}, ensure_ascii=False)

    return predict


_TOPICS = """
  SELECT conv_id || '-' || turn AS review_id, upper(role[1]) || role[2:] || ' Messages' AS topic,
         CASE WHEN length(text) > 200 THEN 'negative' ELSE 'positive' END AS sentiment, text
  FROM conversations WHERE length(text) > 5"""


@query("survey_topics", f"SELECT review_id, topic, sentiment FROM ({_TOPICS})")
def survey_topics(spark, sf_dir):
    messages = survey_messages(comments(spark, sf_dir)).where(F.length("comment") > 5)
    return induce_topics(
        messages, "id", "message", "Find topics.", "Known topics: [{topics}]", topic_model(),
        growth=2).select("review_id", "topic", "sentiment")


@query("survey_flow", rf"""
WITH topics AS ({_TOPICS}),
phrases AS (
  SELECT review_id AS "Review_No", topic, CASE sentiment WHEN 'negative' THEN 'Pain Point' ELSE 'Moment of Delight' END AS type,
         regexp_replace(lower(unnest(string_split(text, chr(1)))), '^\s+|\s+$', '', 'g') AS pp_mod
  FROM topics),
labels AS (SELECT * FROM (VALUES {values((label,) for label in SURVEY_LABELS)}) t(label)),
tokens AS (SELECT DISTINCT label, unnest(string_split_regex(lower(label), '[^\p{{L}}]+')) AS token FROM labels),
wordy AS (SELECT DISTINCT "Review_No", pp_mod, unnest(string_split_regex(pp_mod, '[^\p{{L}}]+')) AS token FROM phrases),
scores AS (SELECT w."Review_No", t.label, count(*) AS n FROM wordy w JOIN tokens t ON t.token = w.token AND w.token <> '' GROUP BY ALL),
best AS (SELECT "Review_No", label FROM scores QUALIFY row_number() OVER (PARTITION BY "Review_No" ORDER BY n DESC, label) = 1)
SELECT p."Review_No", p.topic, p.type, p.pp_mod, coalesce(b.label, 'Other') AS subtopic
FROM phrases p LEFT JOIN best b ON b."Review_No" = p."Review_No" """)
def survey(spark, sf_dir):
    return survey_flow(
        comments(spark, sf_dir), "Find topics.", "Known topics: [{topics}]", topic_model(),
        SURVEY_LABELS, growth=2).select("Review_No", "topic", "type", "pp_mod", "subtopic")


_FLOW_PHRASES = rf"""
topics AS ({_TOPICS}),
phrases AS (
  SELECT review_id AS "Review_No", topic, CASE sentiment WHEN 'negative' THEN 'Pain Point' ELSE 'Moment of Delight' END AS type,
         regexp_replace(lower(unnest(string_split(text, chr(1)))), '^\s+|\s+$', '', 'g') AS pp_mod
  FROM topics)"""


@query("survey_flow_by_model", f"""
WITH {_FLOW_PHRASES}
SELECT "Review_No", topic, type, pp_mod, CASE WHEN contains(pp_mod, 'the') THEN {quoted(SURVEY_LABELS[0])} ELSE 'Other' END AS subtopic
FROM phrases""")
def survey_by_model(spark, sf_dir):
    def mapper(phrases, labels):
        return map_fixed_by_model(
            phrases, labels, "Sort each {item_singular} into one of: {subtopics}", both_sides_model(labels),
            shared_path(spark, "labels"))

    return survey_flow(
        comments(spark, sf_dir), "Find topics.", "Known topics: [{topics}]", topic_model(),
        SURVEY_LABELS, mapper=mapper, growth=2).select("Review_No", "topic", "type", "pp_mod", "subtopic")
