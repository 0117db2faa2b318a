"""One-off taxonomy jobs: expand seed categories, clean labels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from voxtally.constants import CLEANUP_BATCH
from voxtally.functions.labels import clean_label
from voxtally.functions.prompts import render_record
from voxtally.functions.replies import parse_reply
from voxtally.functions.text import concat_label, join_or_null
from voxtally.operators.infer import infer_batches
from voxtally.operators.runlog import open_log
from voxtally.schemas import CLEANED_LABELS, SEED_LABELS, reply_clean_labels, reply_taxonomy


def expand_seed(
    df: DataFrame, instruction: str, predict: Callable, service: str = "service", store: str | None = None,
    slice_rows: int | None = None, **infer_options,
) -> DataFrame:
    """Distinct (CATEGORY_NAME, TYPE) to taxonomy rows, one model call per pair. `service` names the
    category in message and reply. Answers are kept in `store` by pair.
    """
    pairs = df.select("CATEGORY_NAME", "TYPE").na.drop().distinct()
    messages = pairs.select(
        F.concat_ws("|", "TYPE", "CATEGORY_NAME").alias("id"),
        render_record(("type", F.col("TYPE")), (service, F.col("CATEGORY_NAME")))
        .alias("message"))
    log = open_log(df.sparkSession, store, "seed", "id", SEED_LABELS)

    def ask(part: DataFrame) -> DataFrame:
        return infer_batches(part, "id", "message", predict, instruction, size=1, **infer_options)

    def read(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, rejects = parse_reply(replies.where("ok"), "reply", reply_taxonomy(service))
        rows = good.select(F.col("record_ids")[0].alias("id"), "type", F.col(service).alias("topic"), F.inline("subtopics"))
        return rows.select(
            "id", "type", "topic", "root_subtopic", join_or_null(F.col("negative_mods")).alias("negative_mods"),
            join_or_null(F.col("positive_mods")).alias("positive_mods")), rejects

    answers = log.run(messages, ask, read, slice_rows)
    return answers.join(messages.select("id"), "id", "left_semi").drop("id")


def combined_label(df: DataFrame) -> DataFrame:
    """Add `subtopic` = `Mod - root_subtopic` where the input has the two parts."""
    if "subtopic" in df.columns:
        return df
    return df.withColumn("subtopic", concat_label(F.col("Mod"), F.col("root_subtopic"), " - "))


def clean_labels(
    df: DataFrame, predict: Callable | None = None, instruction: str = "",
    size: int = CLEANUP_BATCH, service: str = "service", store: str | None = None, slice_rows: int | None = None,
    **infer_options,
) -> DataFrame:
    """`type, topic, subtopic` to readable labels: by rule, or by a model when one is given.

    The model names a label by what it was asked, so an answer that rewords it is ignored and the label stays
    open (see `RunLog.failures`). Answers are kept in `store` by label.
    """
    rows = combined_label(df)
    if predict is None:
        return rows.select(
            "type", F.col("topic").alias("service"), F.col("subtopic").alias("old_subtopic"),
            clean_label(F.col("subtopic")).alias("cleaned_subtopic"))
    name = F.concat_ws("|", "type", "topic", "subtopic")
    messages = rows.select("type", "topic", "subtopic").distinct().select(
        name.alias("id"), render_record(("type", F.col("type")), (service, F.col("topic")),
                                        ("subtopic", F.col("subtopic"))).alias("message"))
    log = open_log(df.sparkSession, store, "clean", "id", CLEANED_LABELS)

    def ask(part: DataFrame) -> DataFrame:
        return infer_batches(part, "id", "message", predict, instruction, size=size, **infer_options)

    def read(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, rejects = parse_reply(replies.where("ok"), "reply", reply_clean_labels(service))
        given = good.select("record_ids", F.inline("Subtopics")).withColumn(
            "id", F.concat_ws("|", "type", service, "old_subtopic"))
        first = given.where(F.array_contains("record_ids", F.col("id"))).groupBy("id", "type", service, "old_subtopic").agg(
            F.min("cleaned_subtopic").alias("cleaned_subtopic"))
        return first.withColumnRenamed(service, "service"), rejects

    answers = log.run(messages, ask, read, slice_rows)
    return answers.join(messages.select("id"), "id", "left_semi").drop("id")
