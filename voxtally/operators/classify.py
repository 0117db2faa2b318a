"""Keyword rules for social posts and the model fallback."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.constants import KEYWORD_RULES, NO_RULE, POST_ENTITIES, POST_LABELS
from voxtally.functions.prompts import render_record
from voxtally.functions.replies import parse_reply
from voxtally.functions.staging import computed
from voxtally.operators.infer import infer_batches
from voxtally.operators.runlog import open_log
from voxtally.schemas import POST_CLASSES, REPLY_CLASSES

Rule = tuple[str, str, Sequence[str]]


def _hits(text: Column, keywords: Sequence[str], word_boundary: bool) -> Column:
    lowered = [k.lower() for k in keywords]
    # A keyword that contains another one of the same rule can add no hit.
    needed = [k for k in lowered if word_boundary or not any(o != k and o in k for o in lowered)]
    if word_boundary:
        inner = "|".join(re.escape(k) for k in needed)
        return text.rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{inner})(?![\p{{L}}\p{{N}}])")
    plain = [k for k in needed if k[0].isascii()]
    other = [k for k in needed if not k[0].isascii()]
    found = F.lit(False)
    for keyword in plain:
        found = found | text.contains(keyword)
    if other:
        hit = F.lit(False)
        for keyword in other:
            hit = hit | text.contains(keyword)
        found = found | (F.col("_foreign") & hit)
    return found


def _initial_range(rules: Sequence[Rule]) -> str | None:
    """Character range around the first letters of all keywords outside ASCII."""
    letters = [k.lower()[0] for _, _, keywords in rules for k in keywords
               if not k.lower()[0].isascii()]
    return f"[{min(letters)}-{max(letters)}]" if letters else None


def keyword_classify(
    df: DataFrame, text_col: str, rules: Sequence[Rule] = KEYWORD_RULES,
    word_boundary: bool = False,
) -> DataFrame:
    """Add `label` and `main_entity` of the first rule with a keyword in the lower-cased text.

    No hit gives OTHER/Unknown, NULL text gives NULLs. The rule table is one CASE expression: no
    shuffle, no Python, and later rules are not looked at after a hit.
    """
    lowered = df.withColumn("_lower", F.lower(f"`{text_col}`"))
    text = F.col("_lower")
    # One scan for the initials of the keywords in other scripts spares most texts their scans.
    initials = _initial_range(rules)
    lowered = lowered.withColumn("_foreign", text.rlike(initials) if initials else F.lit(False))
    rule = F.when(text.isNull(), F.lit(None).cast("int"))
    for i, (_, _, keywords) in enumerate(rules):
        rule = rule.when(_hits(text, keywords, word_boundary), i + 1)
    rule = rule.otherwise(len(rules) + 1)
    outcomes = [(label, entity) for label, entity, _ in rules] + [NO_RULE]
    labels = F.array(*[F.lit(label) for label, _ in outcomes])
    entities = F.array(*[F.lit(entity) for _, entity in outcomes])
    return (
        computed(lowered, _rule=rule)
        .withColumn("label", F.try_element_at(labels, F.col("_rule")))
        .withColumn("main_entity", F.try_element_at(entities, F.col("_rule")))
        .drop("_lower", "_foreign", "_rule"))


def classify_fallback(
    df: DataFrame, id_col: str, text_col: str, instruction: str, predict, store: str | None = None,
    slice_rows: int | None = None, **infer_options,
) -> DataFrame:
    """Let a model decide the posts that no rule or only a generic rule decided.

    `df` has `label` and `main_entity`; a post the model does not answer keeps what it has. Decided
    posts pass by; only the open ones are joined with the answers, which are kept in `store` by post.
    """
    key = F.col(f"`{id_col}`")
    is_open = F.coalesce((F.col("label") == "OTHER") | (F.col("main_entity") == "Unknown"), F.lit(False))
    open_posts = df.where(is_open).select(
        key.cast("string").alias("id"),
        render_record(("id", key), ("Tweet", F.col(f"`{text_col}`"))).alias("_message"))
    log = open_log(df.sparkSession, store, "classes", "id", POST_CLASSES)

    def ask(part: DataFrame) -> DataFrame:
        return infer_batches(part, "id", "_message", predict, instruction, **infer_options)

    def read(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, rejects = parse_reply(replies.where("ok"), "reply", REPLY_CLASSES,
                                    {"label": POST_LABELS, "main_entity": POST_ENTITIES})
        given = good.select("record_ids", F.inline("tweets")).where(F.array_contains("record_ids", F.col("id")))
        return given.groupBy("id").agg(F.min(F.struct("label", "main_entity")).alias("a")).select("id", "a.*"), rejects

    answers = log.run(open_posts, ask, read, slice_rows).select(
        F.col("id").alias("_id"), F.struct("label", "main_entity").alias("_answer"))
    decided = (
        df.where(is_open).withColumn("_id", key.cast("string")).join(answers, "_id", "left")
        .withColumn("label", F.coalesce("_answer.label", "label"))
        .withColumn("main_entity", F.coalesce("_answer.main_entity", "main_entity"))
        .drop("_id", "_answer"))
    return df.where(~is_open).unionByName(decided)
