"""Explode phrase lists into one row per phrase."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.constants import DELIGHT, PAIN
from voxtally.functions.text import normalise, strip
from voxtally.operators.keys import phrase_key


def _as_list(df: DataFrame, value: str) -> Column:
    return F.split(value, ",") if dict(df.dtypes)[value] == "string" else F.col(value)


def explode_phrases(
    df: DataFrame, id_col: str, value_col: str, type_label: str, keep_empty: bool = False,
) -> DataFrame:
    """One normalised phrase per row from a comma-joined text or a list.

    Empty parts drop. With `keep_empty` (survey form) they stay, rows with NULL sentiment or topic
    drop instead, and there is no phrase id.
    """
    if keep_empty:
        return (
            df.select(F.col(id_col).alias("Review_No"), "sentiment", "topic", value_col).na.drop()
            .select("Review_No", "sentiment", "topic",
                    F.explode(_as_list(df, value_col)).alias("pp_mod"))
            .withColumn("pp_mod", normalise(F.col("pp_mod")))
            .withColumn("type", F.lit(type_label)))
    topic_pos = F.col("topic_pos") if "topic_pos" in df.columns else F.lit(0)
    return (
        df.select(F.col(id_col).cast("string").alias("Review_No"), "sentiment", "topic",
                  topic_pos.alias("topic_pos"),
                  F.posexplode(_as_list(df, value_col)).alias("phrase_pos", "pp_mod"))
        .where(strip(F.col("pp_mod")) != "")
        .withColumn("pp_mod", normalise(F.col("pp_mod")))
        .withColumn("type", F.lit(type_label))
        .withColumn("phrase_id", phrase_key(
            F.col("Review_No"), F.col("topic_pos"), F.col("type"), F.col("phrase_pos")))
        .drop("topic_pos", "phrase_pos"))


def stack_phrases(
    df: DataFrame, id_col: str = "review_id", keep: Sequence[str] = (),
) -> DataFrame:
    """Pain points and moments of delight as rows, in a single pass over the extraction."""
    kept = [F.col(f"`{name}`") for name in keep]
    topic_pos = F.col("topic_pos") if "topic_pos" in df.columns else F.lit(0)

    def tagged(value: str, label: str) -> Column:
        return F.transform(
            F.coalesce(_as_list(df, value), F.array().cast("array<string>")),
            lambda phrase, pos: F.struct(
                phrase.alias("pp_mod"), pos.alias("phrase_pos"), F.lit(label).alias("type")))

    both = F.concat(tagged("pain_points", PAIN), tagged("moments_of_delight", DELIGHT))
    return (
        df.select(F.col(id_col).cast("string").alias("Review_No"), "sentiment", "topic",
                  *kept, topic_pos.alias("topic_pos"), F.inline(both))
        .where(strip(F.col("pp_mod")) != "")
        .withColumn("pp_mod", normalise(F.col("pp_mod")))
        .withColumn("phrase_id", phrase_key(
            F.col("Review_No"), F.col("topic_pos"), F.col("type"), F.col("phrase_pos")))
        .drop("topic_pos", "phrase_pos"))
