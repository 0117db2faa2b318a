"""Preparation of the four feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from voxtally.constants import KEYWORD_RULES, MIN_DATE, PLACE_CODES
from voxtally.functions.dates import day_text, parse_mixed, parse_utc
from voxtally.functions.staging import computed
from voxtally.functions.text import token_count, word_count
from voxtally.operators.classify import keyword_classify
from voxtally.operators.dedup import distinct_rows, keep_first, keep_latest
from voxtally.operators.filters import long_enough, project, since, where_ci
from voxtally.operators.joins import lookup_inner
from voxtally.operators.keys import dense_id


def prep_reviews(
    df: DataFrame, source: str = "tripadvisor", min_date: str = MIN_DATE,
    tiebreak: Sequence[str] = (), typed: bool = False,
) -> DataFrame:
    """Parse dates, keep the newest copy of each review, then filter source and date.

    The newest copy is chosen before the source filter: a newer copy from another source removes
    the review. `tiebreak` columns decide between copies of the same date. The date is text in ISO form or,
    with `typed`, a date, on which later filters reach the scan of the stored table.
    """
    dated = df.withColumn("date", parse_mixed(F.col("date")))
    order = [F.col(c) for c in tiebreak] or [F.col(f"`{c}`") for c in df.columns if c != "date"]
    latest = keep_latest(dated, "review_unique_id", "date", order)
    day = F.to_date("date") if typed else day_text(F.col("date"))
    return since(where_ci(latest, "data_source", source), "date", min_date).withColumn("date", day)


def prep_places(
    df: DataFrame, codes: Mapping[str, str] = PLACE_CODES, min_date: str = MIN_DATE,
) -> DataFrame:
    """Distinct map reviews from `min_date` on, with airport code, a content key and a running number.

    `Review_No` is for display: a review that arrives late shifts the numbers behind it. `Review_Key`,
    a hash of the review's own values, never changes; use it for stores of model answers and phrase ids.

    Duplicates are removed last of the row-wise steps, so only rows that stay are shuffled.
    """
    dated = since(
        computed(df, published_at_datetime_x=parse_utc(F.col("PUBLISHED AT DATETIME"))),
        "published_at_datetime_x", min_date)
    rows = distinct_rows(lookup_inner(dated, "PLACE NAME", codes, "Airport"))
    named = project(
        rows,
        {"SCORE": "score_x", "TEXT": "text", "ORIGINAL TEXT": "original_text", "LANG": "lang",
         "ORIGIN": "origin"},
        ["Airport", "published_at_datetime_x", "text", "score_x", "lang", "original_text",
         "origin"])
    order = ["published_at_datetime_x", "Airport", "text", "original_text", "score_x", "lang",
             "origin"]
    key = F.sha2(F.to_json(F.struct(*[F.col(c) for c in order])), 256)
    return dense_id(named, order, name="Review_No").select("Review_No", key.alias("Review_Key"), *named.columns)


def prep_posts(
    df: DataFrame, rules=KEYWORD_RULES, order: Sequence[str] = ("PUBLISHED AT", "CONTENT"),
) -> DataFrame:
    """One row per post id with its time in UTC and the keyword label."""
    posts = df.select(
        F.col("`INTERNAL UNIQUE ID`").cast("string").alias("INTERNAL UNIQUE ID"),
        "CONTENT", parse_utc(F.col("`PUBLISHED AT`")).alias("PUBLISHED AT"))
    single = keep_first(
        posts, "INTERNAL UNIQUE ID", [F.col(f"`{c}`").asc_nulls_last() for c in order])
    return keyword_classify(single, "CONTENT", rules)


def prep_survey(df: DataFrame) -> DataFrame:
    """Comments of more than five characters with their word and token counts."""
    comments = long_enough(df.select("id", "channel", "comment"), "comment", 5)
    return comments.select(
        "id", "channel", "comment",
        word_count(F.col("comment")).alias("number_of_words"),
        token_count(F.col("comment")).alias("number_of_tokens"))
