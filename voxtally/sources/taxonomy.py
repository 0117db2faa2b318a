"""Taxonomy table: entity type, topic, root subtopic and its modifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voxtally.constants import DELIGHT, GENERIC_MODIFIERS, OTHERS, PAIN
from voxtally.functions.text import concat_label, strip, title_case
from voxtally.schemas import TAXONOMY
from voxtally.sources.files import read_many


def read_taxonomy(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Taxonomy with `type` in upper case, so that `Airline` and `AIRLINE` are one type."""
    return upper_type(read_many(spark, [path], TAXONOMY, fmt=fmt))


def upper_type(taxonomy: DataFrame) -> DataFrame:
    return taxonomy.withColumn("type", F.upper(strip(F.col("type"))))


def taxonomy_labels(taxonomy: DataFrame, entity_type: str) -> DataFrame:
    """One row per topic, phrase type and label; generic modifiers give no label."""
    sides = F.array(
        F.struct(F.lit(PAIN).alias("type"), F.col("negative_mods").alias("mods")),
        F.struct(F.lit(DELIGHT).alias("type"), F.col("positive_mods").alias("mods")))
    return (
        taxonomy.where(F.col("type") == entity_type)
        .select("topic", "root_subtopic", F.inline(sides))
        .select("topic", "type", "root_subtopic", F.explode(F.split("mods", ",")).alias("mod"))
        .withColumn("mod", strip(F.col("mod")))
        .where(~F.lower("mod").isin(*GENERIC_MODIFIERS))
        .select("topic", "type",
                concat_label(title_case(F.col("mod")), F.col("root_subtopic")).alias("subtopic"))
        .na.drop(subset=["subtopic"])
    )


def valid_topics(taxonomy: DataFrame, entity_type: str) -> DataFrame:
    """Distinct topics of an entity type and `Others`."""
    topics = taxonomy.where(F.col("type") == entity_type).select("topic").na.drop()
    others = taxonomy.sparkSession.range(1).select(F.lit(OTHERS).alias("topic"))
    return topics.unionByName(others).distinct()


def topic_list(taxonomy: DataFrame, entity_type: str) -> DataFrame:
    """The topics of an entity type as one line for a prompt, `Others` last."""
    return (
        taxonomy.where(F.col("type") == entity_type)
        .agg(F.array_sort(F.collect_set("topic")).alias("topics"))
        .select(F.array_join(
            F.concat(F.array_remove("topics", OTHERS), F.array(F.lit(OTHERS))), ", ")
            .alias("topics"))
    )
