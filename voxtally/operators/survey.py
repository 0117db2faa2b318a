"""Survey topics that a model finds as it goes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from voxtally.constants import SURVEY_BATCH
from voxtally.operators.extract import model_extract
from voxtally.operators.keys import batch_id
from voxtally.operators.runlog import RunLog
from voxtally.schemas import EXTRACTED, EXTRACTION, REPLY_COMMENTS
from voxtally.session import shared_path


def known_topics(results: DataFrame, max_topics: int | None = None) -> list[str]:
    """Sorted topic vocabulary. It becomes part of a prompt; with `max_topics` more are an error."""
    found = results.select("topic").na.drop().distinct()
    topics = sorted(row.topic for row in (found if max_topics is None else found.limit(max_topics + 1)).collect())
    if max_topics is not None and len(topics) > max_topics:
        raise ValueError(f"more than {max_topics} topics")
    return topics


def induce_topics(
    df: DataFrame, id_col: str, message_col: str, first: str, following: str, predict: Callable,
    size: int = SURVEY_BATCH, growth: int = 1, store: str | None = None, max_topics: int | None = None,
    **infer_options,
) -> DataFrame:
    """Extraction with topics that grow over rounds.

    Every round sees the sorted topics of all answers before it in the `{topics}` of `following`;
    a round without any known topic gets `first`. With `growth` 1 a round is one batch, the fully
    sequential form. With a growth of 2 or more, round sizes are 1, 2, 4, … batches that run in
    parallel, so the number of rounds is the logarithm of the number of batches.

    Answers are kept by record id in `store`. A later run asks only for records that have none
    there, in batches of their own: records added anywhere and records of a failed batch are asked,
    and no answer is ever taken over by position. The result has the answers of the records in `df`.
    """
    spark = df.sparkSession
    store = store or shared_path(spark, "topics")
    key = F.col(f"`{id_col}`").cast("string")
    log = RunLog(spark, store, "review_id", EXTRACTED)
    # Only these columns are asked for and travel through the rounds.
    records, topics = df.select(*[f"`{name}`" for name in dict.fromkeys((id_col, message_col))]), []
    if log.ended():
        done = log.answers().select(F.col("review_id").alias("_done")).distinct()
        records, topics = records.join(done, key == F.col("_done"), "left_anti"), known_topics(log.answers(), max_topics)
    batches = batch_id(records, [id_col], size, "batch_no")
    number = F.col("batch_no")
    level = number if growth == 1 else F.floor(
        F.log(number * (growth - 1) + 1 - F.lit(0.5)) / F.log(F.lit(float(growth)))) + 1
    input_path = shared_path(spark, "rounds")
    schema = batches.withColumn("round_no", level.cast("int")).schema
    batches.withColumn("round_no", level.cast("int")).write.partitionBy("round_no").parquet(input_path)
    rounds = spark.read.schema(schema).parquet(input_path)
    last = rounds.agg(F.max("round_no")).collect()[0][0] or 0
    for number in range(1, last + 1):
        instruction = following.replace("{topics}", ", ".join(topics)) if topics else first
        before = log.ended()
        model_extract(
            rounds.where(F.col("round_no") == number), id_col, message_col, instruction, predict,
            size=size, records="comments", schema=REPLY_COMMENTS, store=store, group_cols=["batch_no"], **infer_options)
        # What was answered before is known already, so a round reads the slices it wrote.
        if log.ended() - before:
            topics = sorted(set(topics) | set(known_topics(log.answers(before), max_topics)))
    asked = df.select(key.alias("_asked")).distinct()
    everything = log.answers().select(*EXTRACTION.names)
    return everything.join(asked, F.col("review_id") == F.col("_asked"), "left_semi")
