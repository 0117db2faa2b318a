"""Dashboard tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from voxtally.constants import (
    AIRLINE_COLUMNS, AIRPORT_COLUMNS, AIRPORT_TOPIC_RENAMES, LANGUAGE_NAMES, MIN_DATE,
)
from voxtally.functions.choose import first_non_empty, map_or_keep, replace_map
from voxtally.functions.dates import day_text, strict_day, utc_day
from voxtally.functions.labels import label_format
from voxtally.operators.filters import since
from voxtally.operators.joins import join_labels, join_metadata
from voxtally.operators.phrases import stack_phrases
from voxtally.sources.files import append_if_exists

LANGUAGE, ORIGINAL, TRANSLATED = (
    "Original Review Language", "Original Review", "Translated Review")
# Number that is shown where the join goes by another key.
SHOWN = "_shown"


@dataclass(frozen=True)
class FinalConfig:
    columns: Sequence[str]
    topic_renames: Mapping[str, str] = field(default_factory=dict)
    min_date: str = MIN_DATE


AIRLINES = FinalConfig(AIRLINE_COLUMNS)
AIRPORTS = FinalConfig(AIRPORT_COLUMNS, AIRPORT_TOPIC_RENAMES)


def review_metadata(reviews: DataFrame) -> DataFrame:
    """Metadata of prepared site reviews under the names of the dashboard table. A typed date is
    taken as it is, so that the date filter reaches the scan.
    """
    typed = dict(reviews.dtypes)["date"] == "date"
    day = F.col("date") if typed else strict_day(F.col("date"))
    return reviews.select(
        F.col("review_unique_id").alias("Review_No"), "data_source", "airline",
        day.alias("date"), F.col("ratings").alias("rating"),
        F.col("review_language").alias(LANGUAGE), F.col("raw_text").alias(ORIGINAL),
        F.col("translated_text").alias(TRANSLATED))


def place_metadata(places: DataFrame, key: str = "Review_No", min_date: str | None = None) -> DataFrame:
    """Metadata of prepared map reviews under the names of the dashboard table.

    `key` is the column by which the phrases name their review. With `Review_Key`, which late reviews do not
    change, `Review_No` is only what the table shows. `min_date` is compared with the bare instant, so the
    filter reaches the scan of a stored table; the day is made of what is left.
    """
    if min_date is not None:
        places = places.where(F.col("published_at_datetime_x") >= F.lit(f"{min_date}T00:00:00Z").cast("timestamp"))
    shown = [] if key == "Review_No" else [F.col("Review_No").cast("string").alias(SHOWN)]
    return places.select(
        F.col(key).cast("string").alias("Review_No"), *shown, "Airport",
        utc_day(F.col("published_at_datetime_x")).alias("date"),
        F.col("score_x").alias("rating"), F.col("origin").alias("data_source"),
        F.col("lang").alias(LANGUAGE),
        first_non_empty(F.col("original_text"), F.col("text")).alias(ORIGINAL),
        F.col("text").alias(TRANSLATED))


def final_table(
    extraction: DataFrame, labels: DataFrame | None, meta: DataFrame, config: FinalConfig,
    posts_path: str | None = None,
) -> DataFrame:
    """Phrases with label and metadata in the columns of `config`.

    `labels` has `id` and `subtopic` per phrase. Without it `extraction` may be a phrase table
    that already carries `subtopic`.
    """
    phrases = stack_phrases(extraction) if "pain_points" in extraction.columns else extraction
    if labels is not None:
        phrases = join_labels(phrases, labels)
    elif "subtopic" not in phrases.columns:
        phrases = phrases.withColumn("subtopic", F.lit(None).cast("string"))
    rows = since(join_metadata(phrases, meta), "date", config.min_date)
    if SHOWN in meta.columns:
        rows = rows.withColumn("Review_No", F.col(SHOWN))
    topic = F.col("topic")
    final = rows.select(*[
        {
            "topic": replace_map(topic, config.topic_renames) if config.topic_renames else topic,
            "date": day_text(F.col("date")),
            LANGUAGE: map_or_keep(F.col(f"`{LANGUAGE}`"), LANGUAGE_NAMES),
            "subtopic": label_format(F.col("subtopic")),
        }.get(name, F.col(f"`{name}`")).alias(name)
        for name in config.columns])
    return append_if_exists(final, posts_path, config.columns) if posts_path else final
