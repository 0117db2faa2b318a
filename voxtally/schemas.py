"""Explicit schemas of the feeds, the taxonomy and the model replies."""

from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, StringType, StructField, StructType,
)


def _strings(*names: str) -> list[StructField]:
    return [StructField(name, StringType()) for name in names]


def _list(name: str, element) -> StructField:
    return StructField(name, ArrayType(element))


RAW_REVIEWS = StructType(
    _strings("review_unique_id", "data_source", "airline", "date", "review_language",
             "raw_text", "translated_text")
    + [StructField("ratings", DoubleType())]
)
RAW_PLACES = StructType(
    _strings("PUBLISHED AT DATETIME", "PLACE NAME")
    + [StructField("SCORE", DoubleType())]
    + _strings("TEXT", "ORIGINAL TEXT", "LANG", "ORIGIN")
)
RAW_POSTS = StructType(_strings("INTERNAL UNIQUE ID", "CONTENT", "PUBLISHED AT"))
SURVEY_COMMENTS = StructType(_strings("id", "channel", "comment"))
TAXONOMY = StructType(
    _strings("type", "topic", "root_subtopic", "negative_mods", "positive_mods"))
SUBTOPIC_LABELS = StructType(_strings("id", "subtopic"))

_TOPIC = StructType(
    _strings("topic")
    + [_list("pain_points", StringType()), _list("moments_of_delight", StringType())])
_RECORD = StructType(_strings("id", "sentiment") + [_list("topics", _TOPIC)])

REPLY_REVIEWS = StructType([_list("reviews", _RECORD)])
REPLY_COMMENTS = StructType([_list("comments", _RECORD)])
REPLY_SUBTOPICS = StructType([_list("reviews", StructType(_strings("id", "subtopic")))])
REPLY_SURVEY_PAINS = StructType(
    [_list("reviews", StructType(_strings("pain_point", "topic", "subtopic")))])
REPLY_SURVEY_DELIGHTS = StructType(
    [_list("reviews", StructType(_strings("mod", "topic", "subtopic")))])
REPLY_CLASSES = StructType([_list("tweets", StructType(_strings("id", "label", "main_entity")))])


def reply_taxonomy(service: str = "service") -> StructType:
    """Reply to a seed category; `service` is the name the prompt gives the category field."""
    return StructType(
        _strings("type", service)
        + [_list("subtopics", StructType(
            _strings("root_subtopic")
            + [_list("positive_mods", StringType()), _list("negative_mods", StringType())]))])


def reply_clean_labels(service: str = "service") -> StructType:
    """Reply to a label clean-up batch; `service` as above."""
    return StructType([_list("Subtopics", StructType(
        _strings("type", service, "cleaned_subtopic", "old_subtopic")))])


EXTRACTION = StructType(
    _strings("review_id", "sentiment", "topic")
    + [_list("pain_points", StringType()), _list("moments_of_delight", StringType())])

# Answers that a run log keeps, each with the key of its record.
EXTRACTED = StructType([*EXTRACTION.fields, StructField("topic_pos", IntegerType())])
TRANSLATIONS = StructType(_strings("text_key", "translated"))
POST_CLASSES = StructType(_strings("id", "label", "main_entity"))
SEED_LABELS = StructType(_strings("id", "type", "topic", "root_subtopic", "negative_mods", "positive_mods"))
CLEANED_LABELS = StructType(_strings("id", "type", "service", "old_subtopic", "cleaned_subtopic"))
