"""Query registry and the input frames that queries share, in Spark and in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxtally.constants import LANGUAGE_NAMES, STOP_WORDS
from voxtally.operators.language import KANA_SHARE, OWN_LETTERS, OWN_SHARE, SCRIPTS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL that gives the same rows."""
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- reviews: documents with date and rating of the event of the same number ---------------------

def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), "ts", "value")
    return docs.join(events, "doc_id").select(
        F.col("doc_id").cast("string").alias("review_unique_id"),
        F.col("source").alias("data_source"),
        F.concat(F.lit("line"), (F.col("doc_id") % 3).cast("string")).alias("airline"),
        "ts", F.col("value").alias("ratings"), F.col("lang").alias("review_language"),
        F.col("text").alias("raw_text"),
        F.concat(F.lit("[en] "), "text").alias("translated_text"))


REVIEWS = """reviews AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS review_unique_id, d.source AS data_source,
         'line' || (d.doc_id % 3) AS airline, e.ts, e.value AS ratings,
         d.lang AS review_language, d.text AS raw_text, '[en] ' || d.text AS translated_text
  FROM documents d JOIN events e ON e.event_id = d.doc_id)"""


# --- phrases: the comma-separated parts of a document ---------------------------------------------

def phrase_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.lit("neutral").alias("sentiment"), F.col("source").alias("topic"))


PHRASES = r"""parts AS (
  SELECT doc_id, source AS topic, unnest(string_split(text, ',')) AS part,
         generate_subscripts(string_split(text, ','), 1) - 1 AS pos
  FROM documents),
phrases AS (
  SELECT CAST(doc_id AS VARCHAR) AS "Review_No", 'neutral' AS sentiment, topic,
         regexp_replace(lower(part), '^\s+|\s+$', '', 'g') AS pp_mod, 'Pain Point' AS type,
         doc_id || '-0-p-' || pos AS phrase_id
  FROM parts
  WHERE regexp_replace(lower(part), '^\s+|\s+$', '', 'g') <> '')"""


# --- lexicon and taxonomy of the rule extractor (own small tables) --------------------------------

LEXICON = (
    ("trash", "pain", "Halls and Shops"),
    ("disgusting", "pain", "Halls and Shops"),
    ("worthless", "pain", "Journey"),
    ("pathetic", "pain", "Gate and Queue"),
    ("stupid", "pain", "Gate and Queue"),
    ("loser", "pain", "Help Desk"),
    ("moron", "pain", "Help Desk"),
    ("idiot", "pain", "Help Desk"),
    ("clown", "pain", "Help Desk"),
    ("scum", "pain", "Baggage"),
    ("gate", "delight", "Gate and Queue"),
    ("thanedble", "delight", "Help Desk"),
    ("thatin", "delight", "Journey"),
    ("orantion", "delight", "Journey"),
    ("rewh", "delight", "Baggage"),
    ("hehely", "delight", "Halls and Shops"),
    ("éque", "delight", "Help Desk"),
    ("ciónue", "delight", "Journey"),
    ("ciónas", "pain", "Journey"),
    ("ench", "delight", "Baggage"),
    ("keit", "pain", "Help Desk"),
)

# topic, root subtopic, negative modifiers, positive modifiers
TAXONOMY_ROWS = (
    ("Halls and Shops", "Cleanliness", "trash everywhere, disgusting, Poor Experience with", "hehely, Great Experience with"),
    ("Halls and Shops", "Waiting Area", "crowded, disgusting", "roomy, hehely"),
    ("Journey", "Punctuality", "worthless, ciónas", "thatin, ciónue"),
    ("Journey", "Cabin", "worn, Poor Experience with", "orantion, thatin"),
    ("Gate and Queue", "Gate", "pathetic, closed", "gate open, Great Experience with"),
    ("Gate and Queue", "Queue", "stupid, long", "short"),
    ("Help Desk", "Staff", "loser, moron, idiot", "thanedble, éque"),
    ("Help Desk", "Hotline", "clown, keit, Poor Experience with", "thanedble line"),
    ("Baggage", "Belt", "scum, slow", "rewh, ench"),
    ("Baggage", "Tracking", "lost", "rewh tracked"),
)


def label_rows() -> list[tuple[str, str, str]]:
    """(topic, type, label) that the taxonomy rows stand for, written out for the SQL side."""
    rows = []
    for topic, root, negative, positive in TAXONOMY_ROWS:
        for kind, mods in (("Pain Point", negative), ("Moment of Delight", positive)):
            for mod in mods.split(","):
                if not mod.strip().lower().endswith("experience with"):
                    rows.append((topic, kind, f"{mod.strip().title()} {root}"))
    return rows


def taxonomy(spark: SparkSession, entity: str = "AIRLINE") -> DataFrame:
    return spark.createDataFrame(
        [(entity, *row) for row in TAXONOMY_ROWS],
        "type string, topic string, root_subtopic string, negative_mods string, positive_mods string")


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def values(rows) -> str:
    return ", ".join("(" + ", ".join(quoted(v) for v in row) + ")" for row in rows)


def extraction_sql(source: str, id_col: str, text_col: str, name: str = "extraction") -> str:
    """CTE with the rows of the rule extractor: topics in lexicon order, three phrases each."""
    topics = list(dict.fromkeys(topic for _, _, topic in LEXICON))

    def hits(topic: str, kind: str) -> str:
        cases = ", ".join(
            f"CASE WHEN contains(lower({text_col}), {quoted(p)}) THEN {quoted(p)} END"
            for p, k, t in LEXICON if k == kind and t == topic)
        return f"[x FOR x IN CAST([{cases}] AS VARCHAR[]) IF x IS NOT NULL][1:3]"

    structs = ", ".join(
        f"{{'topic': {quoted(t)}, 'pains': {hits(t, 'pain')}, 'delights': {hits(t, 'delight')}}}"
        for t in topics)
    return f"""{name}_hits AS (
  SELECT CAST({id_col} AS VARCHAR) AS review_id,
         [d FOR d IN [{structs}] IF len(d.pains) + len(d.delights) > 0] AS details
  FROM {source}),
{name}_filled AS (
  SELECT review_id,
         list_sum([len(d.delights) FOR d IN details]) - list_sum([len(d.pains) FOR d IN details]) AS balance,
         CASE WHEN len(details) > 0 THEN details
              ELSE [{{'topic': 'Others', 'pains': CAST([] AS VARCHAR[]), 'delights': CAST([] AS VARCHAR[])}}]
         END AS details
  FROM {name}_hits),
{name} AS (
  SELECT review_id,
         CASE WHEN balance > 0 THEN 'positive' WHEN balance < 0 THEN 'negative' ELSE 'neutral' END AS sentiment,
         unnest(details).topic AS topic, unnest(details).pains AS pains,
         unnest(details).delights AS delights, generate_subscripts(details, 1) - 1 AS topic_pos
  FROM {name}_filled)"""


def stacked_sql(source: str = "extraction", name: str = "stacked") -> str:
    """CTE with one row per phrase of an extraction CTE."""
    def side(col: str, kind: str, mark: str) -> str:
        return f"""SELECT review_id AS "Review_No", sentiment, topic, unnest({col}) AS pp_mod, '{kind}' AS type,
         review_id || '-' || topic_pos || '-{mark}-' || (generate_subscripts({col}, 1) - 1) AS phrase_id
  FROM {source}"""

    return f"""{name} AS (
  {side('pains', 'Pain Point', 'p')}
  UNION ALL
  {side('delights', 'Moment of Delight', 'd')})"""


def overlap_sql(source: str = "stacked", name: str = "labelled") -> str:
    """CTE that adds the label sharing most words with the phrase."""
    return rf"""{name}_labels AS (
  SELECT * FROM (VALUES {values(label_rows())}) t(topic, type, label)),
{name}_tokens AS (
  SELECT DISTINCT topic, type, label, unnest(string_split_regex(lower(label), '[^\p{{L}}]+')) AS token
  FROM {name}_labels),
{name}_words AS (
  SELECT DISTINCT topic, type, pp_mod, unnest(string_split_regex(lower(pp_mod), '[^\p{{L}}]+')) AS token
  FROM {source}),
{name}_scores AS (
  SELECT w.topic, w.type, w.pp_mod, t.label, count(*) AS n
  FROM {name}_words w JOIN {name}_tokens t
    ON t.topic = w.topic AND t.type = w.type AND t.token = w.token AND w.token <> ''
  GROUP BY ALL),
{name}_best AS (
  SELECT topic, type, pp_mod, label FROM {name}_scores
  QUALIFY row_number() OVER (PARTITION BY topic, type, pp_mod ORDER BY n DESC, label) = 1),
{name}_topics AS (SELECT DISTINCT topic, type FROM {name}_labels),
{name} AS (
  SELECT s.*, CASE WHEN b.label IS NOT NULL THEN b.label WHEN t.topic IS NOT NULL THEN 'Others' END AS subtopic
  FROM {source} s
  LEFT JOIN {name}_best b ON b.topic = s.topic AND b.type = s.type AND b.pp_mod = s.pp_mod
  LEFT JOIN {name}_topics t ON t.topic = s.topic AND t.type = s.type)"""


def detect_sql(relation: str = "documents", key: str = "doc_id", column: str = "text") -> str:
    """CTEs up to `detected`: key, text, lang_code, lang_name; the rules of `detect_language`."""
    def listed(code: str) -> str:
        return ", ".join(quoted(w) for w in STOP_WORDS[code].split())

    scores = ", ".join(
        f"{{'score': -len([t FOR t IN tokens IF t IN ({listed(code)})]), 'rank': {i}, 'code': {quoted(code)}}}"
        for i, code in enumerate(STOP_WORDS))

    def count(pattern: str) -> str:
        return f"len(regexp_extract_all(text, {quoted(pattern.replace('{Is', '{'))}))"

    counts = ", ".join(f"{{'n': -{count(p)}, 'i': {i}, 'code': {quoted(c)}}}" for i, (c, p) in enumerate(SCRIPTS))
    kana, han = count(SCRIPTS[0][1]), count(SCRIPTS[2][1])
    own = " ".join(
        f"WHEN top.code = 'ar' AND {count(p)} >= {OWN_SHARE} * -top.n THEN {quoted(c)}" for c, p in OWN_LETTERS)
    scripts = f"""WHEN top.n = 0 THEN NULL WHEN top.code IN ('zh', 'ja')
      THEN CASE WHEN {kana} >= {KANA_SHARE} * ({kana} + {han}) THEN 'ja' ELSE 'zh' END {own} ELSE top.code"""
    names = "CASE lang_code WHEN 'unknown' THEN 'Unknown' " + " ".join(
        f"WHEN {quoted(c)} THEN {quoted(n)}" for c, n in LANGUAGE_NAMES.items()) + " ELSE lang_code END"
    return rf"""tokens AS (
  SELECT {key}, {column} AS text, string_split_regex(lower({column}), '[^\p{{L}}]+') AS tokens,
         len(regexp_extract_all({column}, '\p{{Latin}}')) AS latin, len(regexp_extract_all({column}, '\p{{L}}')) AS letters,
         list_sort([{counts.replace('(text,', '(' + column + ',')}])[1] AS top
  FROM {relation}),
best AS (
  SELECT {key}, text, CASE WHEN latin * 2 > letters THEN NULL {scripts} END AS script,
         list_sort([{scores}])[1] AS best
  FROM tokens),
coded AS (
  SELECT {key}, text, coalesce(script, CASE WHEN best.score < 0 THEN best.code END, 'unknown') AS lang_code FROM best),
detected AS (SELECT {key}, text, lang_code, {names} AS lang_name FROM coded)"""
