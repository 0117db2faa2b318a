"""Sentiment, topics, pain points and moments of delight per record."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.constants import EXTRACTION_BATCH, EXTRACTION_LIMIT, OTHERS, SENTIMENTS
from voxtally.functions.choose import coerce_to_set
from voxtally.functions.replies import by_record, judge_reply
from voxtally.operators.infer import infer_batches
from voxtally.operators.runlog import open_log
from voxtally.schemas import EXTRACTED, REPLY_REVIEWS

Entry = tuple[str, str, str]  # phrase, "pain" or "delight", topic


def rule_extract(
    df: DataFrame, id_col: str, text_col: str, lexicon: Sequence[Entry], limit: int = EXTRACTION_LIMIT,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Deterministic extraction by a phrase lexicon, column expressions only.

    Per topic at most `limit` pains and delights in lexicon order; a record without a hit is one
    neutral row of topic `Others`. It has the shape of a model's result, not its quality. Columns in
    `keep` travel along, which saves a join back on the record id.
    """
    topics = list(dict.fromkeys(topic for _, _, topic in lexicon))
    lowered = df.withColumn("_lower", F.lower(f"`{text_col}`"))

    def found(topic: str, polarity: str) -> Column:
        phrases = [p for p, kind, t in lexicon if t == topic and kind == polarity]
        if not phrases:
            return F.array().cast("array<string>")
        hits = F.array(*[F.when(F.col("_lower").contains(p.lower()), F.lit(p)) for p in phrases])
        return F.slice(F.array_compact(hits), 1, limit)

    columns = {}
    for i, topic in enumerate(topics):
        columns[f"_pain{i}"] = found(topic, "pain")
        columns[f"_delight{i}"] = found(topic, "delight")
    kept = [F.col(f"`{name}`") for name in keep]
    hits = lowered.select(
        F.col(f"`{id_col}`").cast("string").alias("review_id"), "_lower", *kept).select(
        "review_id", *kept, *[col.alias(name) for name, col in columns.items()])

    def total(prefix: str) -> Column:
        sizes = [F.size(f"{prefix}{i}") for i in range(len(topics))]
        return sum(sizes[1:], sizes[0])

    empty = F.array().cast("array<string>")
    details = F.filter(
        F.array(*[
            F.struct(F.lit(topic).alias("topic"), F.col(f"_pain{i}").alias("pain_points"),
                     F.col(f"_delight{i}").alias("moments_of_delight"))
            for i, topic in enumerate(topics)]),
        lambda d: (F.size(d["pain_points"]) > 0) | (F.size(d["moments_of_delight"]) > 0))
    none = F.array(F.struct(
        F.lit(OTHERS).alias("topic"), empty.alias("pain_points"),
        empty.alias("moments_of_delight")))
    balance = total("_delight") - total("_pain")
    return (
        hits.select(
            "review_id", *kept,
            F.when(balance > 0, "positive").when(balance < 0, "negative").otherwise("neutral")
            .alias("sentiment"),
            details.alias("_details"))
        .select("review_id", *kept, "sentiment", F.posexplode(
            F.when(F.size("_details") > 0, F.col("_details")).otherwise(none))
            .alias("topic_pos", "_detail"))
        .select("review_id", *kept, "sentiment", "topic_pos", "_detail.*"))


def model_extract(
    df: DataFrame, id_col: str, message_col: str, instruction: str, predict: Callable,
    topics: Sequence[str] | None = None, size: int = EXTRACTION_BATCH, records: str = "reviews",
    schema=REPLY_REVIEWS, store: str | None = None, slice_rows: int | None = None,
    limit: int = EXTRACTION_LIMIT, **infer_options,
) -> DataFrame:
    """Extraction by a model: batches out, typed rows back.

    A topic outside `topics` becomes `Others`, and of pains and delights the first `limit` of a topic count.
    Answers for ids that were not asked are ignored, of a repeated id the first answer counts, an unanswered id has
    no row and stays open for the next run. An answered record without topics has one row with NULL topic.
    Answers are kept in `store` (a run log) by record; the result has those of the records in `df`.
    """
    key = F.col(f"`{id_col}`").cast("string")
    groups = list(infer_options.get("group_cols", ()))
    messages = df.select(*groups, key.alias("review_id"), F.col(f"`{message_col}`").alias("_message"))
    log = open_log(df.sparkSession, store, "extraction", "review_id", EXTRACTED)

    def ask(part: DataFrame) -> DataFrame:
        return infer_batches(part, "review_id", "_message", predict, instruction, size=size, **infer_options)

    answers = log.run(messages, ask, lambda replies: _read_extraction(replies, topics, records, schema, limit), slice_rows)
    columns = ["review_id", "sentiment", "topic", "topic_pos", "pain_points", "moments_of_delight"]
    if store is None:
        return answers.select(columns)
    asked = df.select(key.alias("review_id")).distinct()
    return answers.join(asked, "review_id", "left_semi").select(columns)


def _read_extraction(
    replies: DataFrame, topics: Sequence[str] | None, records: str, schema, limit: int,
) -> DataFrame:
    told = by_record(judge_reply(replies, "reply", schema, {"sentiment": SENTIMENTS}), F.col(records))
    # A record without topics, or without an answer, keeps one row with NULL topic.
    flat = told.select(
        F.col("id").alias("review_id"), F.col("given.sentiment").alias("sentiment"), "reason", "error", "attempts",
        F.posexplode_outer("given.topics").alias("topic_pos", "detail"))
    topic = F.col("detail.topic")
    if topics is not None:
        topic = F.when(topic.isNotNull(), coerce_to_set(topic, topics, OTHERS))

    def first(name: str) -> Column:
        return F.slice(F.coalesce(f"detail.{name}", F.array().cast("array<string>")), 1, limit).alias(name)

    return flat.select(
        "review_id", "sentiment", topic.alias("topic"), F.coalesce("topic_pos", F.lit(0)).alias("topic_pos"),
        first("pain_points"), first("moments_of_delight"), "reason", "error", "attempts")
