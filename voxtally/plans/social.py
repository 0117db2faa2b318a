"""Social posts to dashboard rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from voxtally.functions.dates import day_text, utc_day
from voxtally.functions.staging import settle
from voxtally.operators.extract import Entry, rule_extract
from voxtally.operators.language import enrich_language
from voxtally.operators.mapping import map_by_overlap
from voxtally.operators.phrases import stack_phrases
from voxtally.plans.final import TRANSLATED, FinalConfig


def social_final(
    posts: DataFrame, label: str, lexicon: Sequence[Entry], labels: DataFrame,
    config: FinalConfig, entity_column: str, translator=None, source: str = "X",
    extract: Callable[[DataFrame], DataFrame] | None = None,
    mapper: Callable[[DataFrame, DataFrame], DataFrame] = map_by_overlap,
) -> DataFrame:
    """Posts of one label as rows of the dashboard table of that label. Posts have no rating.

    By rule, language, extraction and labels are all decided inside the row and the post's columns travel
    along, so nothing is joined back and no text is shuffled.

    `extract` takes rows with `post` and `Original Review` and gives extraction rows by `review_id` (`model_extract`);
    a text that several posts have is asked once, under the least of their ids. `mapper` takes phrases and labels
    and adds `subtopic` (`map_by_model`).
    """
    meta = enrich_language(
        posts.where(F.col("label") == label).select(
            F.col("`INTERNAL UNIQUE ID`").alias("post"),
            F.col("main_entity").alias(entity_column),
            day_text(utc_day(F.col("`PUBLISHED AT`"))).alias("date"),
            F.lit(None).cast("double").alias("rating"),
            F.lit(source).alias("data_source"),
            F.col("CONTENT").alias("Original Review")),
        translator=translator)
    keep = [c for c in meta.columns if c != "post"]
    if extract is None:
        extraction = rule_extract(meta, "post", "Original Review", lexicon, keep=keep)
    else:
        # Without a translator both texts of a post are one, which is written and shuffled once.
        held = meta if translator else meta.drop(TRANSLATED)
        held = settle(held.withColumn("_text", F.sha2(F.coalesce("Original Review", F.lit("")), 256)), "posts")
        # The first post of a text is found by the digest, and the texts of first posts are picked then.
        first = settle(held.groupBy("_text").agg(F.min(F.struct("post")).alias("r")).select("_text", "r.post"), "first")
        asked = held.select("post", "_text", "Original Review").join(first, ["post", "_text"], "left_semi")
        asked = asked.groupBy("post", "_text").agg(F.min(F.struct("Original Review")).alias("r")).select("post", "r.*")
        answers = extract(asked).withColumnRenamed("review_id", "_first")
        told = first.select("_text", F.col("post").alias("_first")).join(answers, "_first").drop("_first")
        extraction = held.withColumnRenamed("post", "review_id").join(told, "_text").drop("_text")
        extraction = extraction if translator else extraction.withColumn(TRANSLATED, F.col("Original Review"))
    phrases = mapper(stack_phrases(extraction, keep=keep), labels)
    return phrases.select(*[f"`{c}`" for c in config.columns])
