"""Language detection, translation and the language columns of the dashboard tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.constants import LANGUAGE_NAMES, STOP_WORDS, TRANSLATION_BATCH
from voxtally.functions.choose import literal_map
from voxtally.functions.prompts import one_line
from voxtally.functions.replies import parse_numbered
from voxtally.functions.staging import computed
from voxtally.functions.text import let, words
from voxtally.operators.infer import infer_batches
from voxtally.operators.runlog import open_log
from voxtally.schemas import TRANSLATIONS
from voxtally.session import shared_path

# Language by script; the script with most letters decides.
SCRIPTS = (
    ("ja", r"[\p{IsHiragana}\p{IsKatakana}]"),
    ("ko", r"\p{IsHangul}"),
    ("zh", r"\p{IsHan}"),
    ("th", r"\p{IsThai}"),
    ("hi", r"\p{IsDevanagari}"),
    ("bn", r"\p{IsBengali}"),
    ("el", r"\p{IsGreek}"),
    ("iw", r"\p{IsHebrew}"),
    ("ru", r"\p{IsCyrillic}"),
    ("ar", r"\p{IsArabic}"),
)
# Languages that share a script are told apart by the share of their own letters in it.
KANA_SHARE = 0.2
OWN_LETTERS = (("ur", "[ٹڈڑںھےہ]"), ("fa", "[پچژگی]"))
OWN_SHARE = 0.05
UNKNOWN = "unknown"
LANGUAGE_COLUMNS = ("Original Review Language", "Translated Review")


def _member(vocabulary: list[str]):
    return lambda token: token.isin(*vocabulary)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _by_script(text: Column) -> Column:
    """Language of a text that is mostly not Latin, NULL without letters of a known script."""
    counted = F.array(*[
        F.struct((-_count(text, pattern)).alias("n"), F.lit(i).alias("i"), F.lit(code).alias("code"))
        for i, (code, pattern) in enumerate(SCRIPTS)])

    def decide(top: Column) -> Column:
        kana, han = _count(text, SCRIPTS[0][1]), _count(text, SCRIPTS[2][1])
        chosen = F.when(top["n"] == 0, F.lit(None).cast("string"))
        chosen = chosen.when(top["code"].isin("zh", "ja"), F.when(kana >= KANA_SHARE * (kana + han), "ja").otherwise("zh"))
        for code, own in OWN_LETTERS:
            chosen = chosen.when((top["code"] == "ar") & (_count(text, own) >= OWN_SHARE * -top["n"]), code)
        return chosen.otherwise(top["code"])

    return let(F.array_min(counted), decide)


def detect_language(
    df: DataFrame, text_col: str, profiles: Mapping[str, str] = STOP_WORDS,
) -> DataFrame:
    """Add `lang_code` and `lang_name`.

    Where at least half of the letters are not Latin, the script with most letters decides: Japanese
    from a fifth of kana among kana and Han, Urdu and Persian from a share of their own letters in
    Arabic script. Else it is the language with most function words; ties go to the earlier
    profile. No evidence is `unknown`.
    """
    text = F.col(f"`{text_col}`")
    latin = F.length(F.regexp_replace(text, r"[^\p{IsLatin}]+", ""))
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    # Up to U+024F all letters are Latin: one cheap scan settles most texts.
    script = F.when(text.isNull() | ~text.rlike(r"[^\x00-\u024F]"), F.lit(None).cast("string")).when(
        latin * 2 > letters, F.lit(None).cast("string")).otherwise(_by_script(text))
    # One pass keeps the words of any profile, the passes per language then see few words.
    known = sorted({word for vocabulary in profiles.values() for word in vocabulary.split()})
    ranked = F.array(*[
        F.struct((-F.size(F.filter("_known", _member(vocabulary.split())))).alias("score"),
                 F.lit(i).alias("rank"), F.lit(code).alias("code"))
        for i, (code, vocabulary) in enumerate(profiles.items())])
    code = F.coalesce(
        F.col("_script"), F.when(F.col("_best.score") < 0, F.col("_best.code")), F.lit(UNKNOWN))
    scored = (
        df.withColumn("_script", script)
        .withColumn("_known", F.filter(words(text), _member(known)))
        .withColumn("_best", F.array_min(ranked)))
    # A later filter on the language reads the column and does not score the text again.
    return computed(scored, lang_code=code).withColumn("lang_name", language_name(F.col("lang_code"))).drop(
        "_script", "_known", "_best")


def language_name(code: Column) -> Column:
    names = {**LANGUAGE_NAMES, UNKNOWN: "Unknown"}
    return F.coalesce(F.try_element_at(literal_map(names), code), code)


def translate(
    df: DataFrame, id_col: str, text_col: str, predict: Callable, instruction: str,
    size: int = TRANSLATION_BATCH, store: str | None = None, slice_rows: int | None = None, **infer_options,
) -> DataFrame:
    """Add `translated`. Each distinct text is sent once, in numbered batches; a line the reply
    lacks and a failed batch leave NULL.

    Answers are kept by text in `store` (a run log; of its own without one) before the result is returned, so
    using the result twice asks once, and a later run asks only for what has no answer. Rows without a text
    pass by; only rows with one are joined, by a key that is never NULL.
    """
    text = F.col(f"`{text_col}`")
    spoken = df.where(text.isNotNull()).withColumn("_key", F.sha2(text, 256))
    lines = spoken.select(F.col("_key").alias("text_key"), one_line(text).alias("_line")).distinct()
    log = open_log(df.sparkSession, store, "translations", "text_key", TRANSLATIONS)

    def numbered(prompt, texts):
        return predict(prompt, ["\n".join(f"{i}. {line}" for i, line in enumerate(texts, 1))])

    def ask(part: DataFrame) -> DataFrame:
        return infer_batches(part, "text_key", "_line", numbered, instruction, size=size, json_reply=False, **infer_options)

    def read(replies: DataFrame) -> DataFrame:
        texts = F.when(F.col("ok"), parse_numbered(F.col("reply"), F.size("record_ids")))
        rows = replies.select("ok", "error", "attempts", F.inline(F.arrays_zip(
            F.col("record_ids").alias("text_key"), texts.alias("translated"))))
        reason = F.when(~F.col("ok"), "call").when(F.col("translated").isNull(), "unanswered")
        return rows.withColumn("reason", reason)

    answers = log.run(lines, ask, read, slice_rows).withColumnRenamed("text_key", "_key")
    silent = df.where(text.isNull()).withColumn("translated", F.lit(None).cast("string"))
    return spoken.join(answers, "_key", "left").drop("_key").unionByName(silent)


def enrich_language(
    df: DataFrame, text_col: str = "Original Review",
    translator: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `Original Review Language` and `Translated Review`.

    English rows copy their text and pass in a union, without a shuffle. Other rows are written once,
    with their text in `_foreign`, and get the column `translated` that `translator` adds to them; without a
    translator they copy their text as well.
    """
    tagged = detect_language(df, text_col)
    text = F.col(f"`{text_col}`")
    if translator is None:
        done = tagged.withColumn("Translated Review", text)
    else:
        path = shared_path(df.sparkSession, "foreign")
        # The text is written once, as `_foreign`, and named back.
        foreign = tagged.where(F.col("lang_code") != "en").withColumnRenamed(text_col, "_foreign")
        foreign.write.parquet(path)
        held = df.sparkSession.read.schema(foreign.schema).parquet(path).select(
            *[F.col("_foreign" if c == text_col else f"`{c}`").alias(c) for c in tagged.columns], "_foreign")
        translated = translator(held).withColumn("Translated Review", F.col("translated")).drop("_foreign", "translated")
        english = tagged.where(F.col("lang_code") == "en").withColumn("Translated Review", text)
        done = english.unionByName(translated)
    return done.withColumn("Original Review Language", F.col("lang_name")).drop(
        "lang_code", "lang_name")
