"""Map free-text phrases to the fixed labels of a taxonomy."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.constants import DELIGHT, OTHERS, PAIN, SUBTOPIC_BATCH, SURVEY_BATCH
from voxtally.functions.choose import coerce_to_set
from voxtally.functions.prompts import inject, render_record
from voxtally.functions.replies import by_record, judge_reply
from voxtally.functions.staging import settle
from voxtally.functions.text import let, words
from voxtally.operators.infer import infer_batches
from voxtally.operators.joins import MAX_BROADCAST_BYTES, join_bounded, measured_bytes
from voxtally.operators.runlog import RunLog
from voxtally.schemas import (
    REPLY_SUBTOPICS, REPLY_SURVEY_DELIGHTS, REPLY_SURVEY_PAINS, SUBTOPIC_LABELS,
)


#: Labels of a topic that share a word until it counts as common.
COMMON_LABELS = 100


def _closest(candidates: Column, tokens: Column, default: str) -> Column:
    """Label with most words in common; ties go to the first label in order."""
    scored = F.transform(candidates, lambda c: F.struct(
        (-F.size(F.array_intersect(c["tokens"], tokens))).alias("score"),
        c["label"].alias("label")))
    return let(F.array_min(scored), lambda best: F.when(best["score"] < 0, best["label"]).when(
        best.isNotNull(), F.lit(default)))


def map_by_overlap(
    phrases: DataFrame, labels: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add `subtopic`: the label of the phrase's topic and type that shares most words with it.

    No shared word gives `Others`, a topic without labels gives NULL. While the measured labels stay
    below `max_bytes`, those of a topic travel as one list: a phrase is decided inside its row, and
    phrases are neither shuffled nor multiplied. A larger label table is joined by word.
    """
    entries = labels.select("topic", "type", "subtopic").distinct().withColumn(
        "tokens", words(F.col("subtopic")))
    if measured_bytes(entries) > max_bytes:
        return _overlap_by_word(phrases, settle(entries, "labels"))
    lists = entries.groupBy("topic", "type").agg(F.collect_list(
        F.struct(F.col("subtopic").alias("label"), "tokens")).alias("_candidates"))
    return (
        join_bounded(phrases, lists, ["topic", "type"], "left")
        .withColumn("_tokens", words(F.col("pp_mod")))
        .withColumn("subtopic", _closest(F.col("_candidates"), F.col("_tokens"), OTHERS))
        .drop("_candidates", "_tokens"))


def _overlap_by_word(phrases: DataFrame, entries: DataFrame, common: int = COMMON_LABELS) -> DataFrame:
    """The same labels from an index of words, for any number of labels.

    A word that more than `common` labels of a topic have is common. Rare words find few labels, and for those all
    words are counted. A label that shares only common words is looked for once per distinct set of
    common words and not per phrase, so such a word does not join all its labels with all its phrases.
    """
    keys, place = ["topic", "type", "pp_mod"], ["topic", "type"]
    by_word = entries.select(*place, "subtopic", F.explode(F.array_distinct("tokens")).alias("word"))
    sizes = by_word.groupBy(*place, "word").agg((F.count("*") > common).alias("_common"))
    distinct = phrases.select(*keys).distinct()
    asked = distinct.select(*keys, F.explode(F.array_distinct(words(F.col("pp_mod")))).alias("word"))
    known = settle(join_bounded(asked, sizes, [*place, "word"]), "words")
    # The common words of a phrase are one text, as sets of words are equal when their sorted texts are.
    sets = known.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("_common"), F.col("word")))), " ").alias("_set"))
    single = settle(sets, "sets")

    rare = join_bounded(known.where("NOT _common").select(*keys, "word"), by_word, [*place, "word"])
    found = rare.groupBy(*keys, "subtopic").agg(F.count("*").alias("n")).join(single, keys)
    tokens = entries.select(*place, "subtopic", "tokens")
    shared = F.size(F.array_intersect(F.array_distinct("tokens"), F.split("_set", " ")))
    by_rare = found.join(tokens, [*place, "subtopic"]).select(*keys, (F.col("n") + shared).alias("n"), "subtopic")

    combined = single.where("_set <> ''").select(*place, "_set").distinct()
    parts = combined.select(*place, "_set", F.explode(F.split("_set", " ")).alias("word"))
    scores = join_bounded(parts, by_word, [*place, "word"]).groupBy(*place, "_set", "subtopic").agg(F.count("*").alias("n"))
    top = scores.groupBy(*place, "_set").agg(F.min(F.struct(-F.col("n"), "subtopic")).alias("_top"))
    by_common = single.join(top, [*place, "_set"]).select(*keys, (-F.col("_top.col1")).alias("n"), F.col("_top.subtopic"))

    best = by_rare.unionByName(by_common).groupBy(*keys).agg(F.min(F.struct(-F.col("n"), "subtopic"))["subtopic"].alias("_best"))
    default = entries.select(*place, F.lit(OTHERS).alias("_default")).distinct()
    same = [phrases[k].eqNullSafe(best[k]) for k in keys]
    joined = phrases.join(best, same, "left").select(phrases["*"], "_best")
    return (join_bounded(joined, default, place, "left")
            .withColumn("subtopic", F.coalesce("_best", "_default")).drop("_best", "_default"))


def map_fixed(phrases: DataFrame, labels: Sequence[str], default: str = "Other") -> DataFrame:
    """Add `subtopic` from one fixed label list for all topics (survey form)."""
    entries = F.array(*[
        F.struct(F.lit(label).alias("label"), words(F.lit(label)).alias("tokens"))
        for label in labels])
    # One pass keeps the words that any label has, so that each label is compared with few words.
    known = F.array_distinct(F.flatten(F.array(*[words(F.lit(label)) for label in labels])))
    return (
        phrases.withColumn("_tokens", F.array_intersect(words(F.col("pp_mod")), known))
        .withColumn("subtopic", _closest(entries, F.col("_tokens"), default))
        .drop("_tokens"))


def _distinct_phrases(phrases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The phrases with their `_key`, and each distinct one (id, topic, type, pp_mod) once."""
    key = F.sha2(F.concat_ws("\u0001", "topic", "type", "pp_mod"), 256)
    distinct = phrases.select("topic", "type", "pp_mod").distinct()
    return phrases.withColumn("_key", key), distinct.select(key.alias("id"), "topic", "type", "pp_mod")


def map_by_model(
    phrases: DataFrame, labels: DataFrame, template: str, predict: Callable, store: str,
    size: int = SUBTOPIC_BATCH, slice_rows: int | None = None, **infer_options,
) -> DataFrame:
    """Add `subtopic` by a model that picks from the labels of the phrase's topic.

    Each distinct (topic, type, phrase) is asked once and joined back, so repeated phrases cost one
    call. Answers are kept in `store` and reused. An answer outside the allowed labels is `Others`.
    """
    keyed, distinct = _distinct_phrases(phrases)
    # Made once: every slice reads them.
    lists = settle(labels.groupBy("topic", "type").agg(F.array_sort(F.collect_set("subtopic")).alias("candidates")), "candidates")
    prompt = inject(template, type=F.lower("type"), subtopics=F.array_join("candidates", ", "))
    by_topic = lists.select("topic", "type", prompt.alias("prompt"))
    # One prompt per topic goes to the tasks apart from the phrases, unless there are too many.
    prompts = None
    if measured_bytes(by_topic) <= MAX_BROADCAST_BYTES:
        prompts = {(row.topic, row.type): row.prompt for row in by_topic.collect()}

    def ask(part: DataFrame) -> DataFrame:
        message = render_record(("id", F.col("id")), ("phrase", F.col("pp_mod"))).alias("message")
        asked = part if prompts is not None else join_bounded(part, by_topic, ["topic", "type"])
        messages = asked.select("topic", "type", "id", message, *([] if prompts is not None else ["prompt"]))
        return infer_batches(messages, "id", "message", predict, F.col("prompt") if prompts is None else prompts,
                             ["topic", "type"], size, **infer_options)

    def read(replies: DataFrame) -> DataFrame:
        # Sorted, so that of several answers for an id the least label counts.
        told = by_record(judge_reply(replies, "reply", REPLY_SUBTOPICS), F.array_sort("reviews"), "topic", "type")
        listed = join_bounded(told, lists, ["topic", "type"], "left")
        subtopic, known = F.col("given.subtopic"), F.col("candidates").isNotNull()
        return listed.select(
            "id", F.when(F.array_contains("candidates", subtopic), subtopic).otherwise(OTHERS).alias("subtopic"),
            F.when(known | F.col("reason").isNotNull(), F.col("reason")).otherwise("unanswered").alias("reason"), "error", "attempts")

    answers = RunLog(phrases.sparkSession, store, "id", SUBTOPIC_LABELS).run(distinct, ask, read, slice_rows)
    return keyed.join(answers.withColumnRenamed("id", "_key"), "_key", "left").drop("_key")


def map_fixed_by_model(
    phrases: DataFrame, labels: Sequence[str], template: str, predict: Callable, store: str,
    default: str = "Other", size: int = SURVEY_BATCH, slice_rows: int | None = None, **infer_options,
) -> DataFrame:
    """Add `subtopic` by a model that picks from one fixed label list (survey form).

    The reply names a phrase by its text and topic, not by an id. Each distinct (topic, type,
    phrase) is asked once and joined back; an answer outside the list is `default`, a phrase the
    model rewords stays open for the next run.
    """
    keyed, distinct = _distinct_phrases(phrases)
    sides = ((PAIN, "pain_point", REPLY_SURVEY_PAINS), (DELIGHT, "mod", REPLY_SURVEY_DELIGHTS))
    prompts = {
        (kind,): template.replace("{item_singular}", kind.lower()).replace("{subtopics}", ", ".join(labels))
        for kind, _, _ in sides}

    def ask(part: DataFrame) -> DataFrame:
        item = F.when(F.col("type") == PAIN, render_record((PAIN, F.col("pp_mod")))).otherwise(
            render_record((DELIGHT, F.col("pp_mod"))))
        message = F.concat_ws("\n", item, render_record(("Current_Topic", F.col("topic"))))
        return infer_batches(part.select("type", "id", message.alias("message")), "id", "message", predict, prompts,
                             ["type"], size, **infer_options)

    def read(replies: DataFrame) -> DataFrame:
        def named(kind: str, field: str) -> Column:
            return F.transform("reviews", lambda r: F.struct(
                F.sha2(F.concat_ws("\u0001", r["topic"], F.lit(kind), r[field]), 256).alias("id"), r["subtopic"].alias("subtopic")))

        # Sorted, so that of several answers for a phrase the least label counts.
        told = [
            by_record(judge_reply(replies.where(F.col("type") == kind), "reply", schema), F.array_sort(named(kind, field)))
            for kind, field, schema in sides]
        return told[0].unionByName(told[1]).select(
            "id", coerce_to_set(F.col("given.subtopic"), labels, default).alias("subtopic"), "reason", "error", "attempts")

    answers = RunLog(phrases.sparkSession, store, "id", SUBTOPIC_LABELS).run(distinct, ask, read, slice_rows)
    return keyed.join(answers.withColumnRenamed("id", "_key"), "_key", "left").drop("_key")
