"""Survey comments to labelled phrases."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from voxtally.constants import DELIGHT, PAIN
from voxtally.functions.prompts import render_record
from voxtally.operators.mapping import map_fixed
from voxtally.operators.phrases import explode_phrases
from voxtally.operators.survey import induce_topics
from voxtally.plans.prep import prep_survey


def survey_messages(comments: DataFrame) -> DataFrame:
    """Add the message of each comment."""
    return comments.withColumn("message", render_record(
        ("Comment_id", F.col("id")), ("channel", F.col("channel")),
        ("Comment", F.col("comment"))))


def survey_phrases(extraction: DataFrame) -> DataFrame:
    """Pains and delights of the survey, empty parts kept."""
    rows = extraction.withColumnRenamed("review_id", "id")
    return explode_phrases(rows, "id", "pain_points", PAIN, keep_empty=True).unionByName(
        explode_phrases(rows, "id", "moments_of_delight", DELIGHT, keep_empty=True))


def label_phrases(phrases: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Label phrases from the fixed list. The label depends on the phrase alone and is computed in
    its row, which saves the shuffles of a distinct and a join back.
    """
    return map_fixed(phrases, labels)


def survey_flow(
    df: DataFrame, first: str, following: str, predict: Callable, labels: Sequence[str],
    mapper: Callable[[DataFrame, Sequence[str]], DataFrame] = label_phrases, **topic_options,
) -> DataFrame:
    """Clean comments, find topics, explode phrases and label them.

    `mapper` takes phrases and labels and adds `subtopic`: by rule in the row, or by a model that is asked once per
    distinct phrase, topic and type (`map_fixed_by_model`).
    """
    messages = survey_messages(prep_survey(df))
    extraction = induce_topics(messages, "id", "message", first, following, predict,
                               **topic_options)
    return mapper(survey_phrases(extraction), labels)
