"""What the rounds of a survey carry and read, and words of fixed labels."""

import json

from pyspark.sql import functions as F

from voxtally.operators import survey
from voxtally.operators.keys import batch_id
from voxtally.operators.mapping import map_fixed
from voxtally.session import shared_path


def test_rounds_carry_what_is_asked_and_read_their_own_slices(spark, monkeypatch):
    carried, read = [], []

    def numbered(df, *args):
        carried.append(df.columns)
        return batch_id(df, *args)

    def topics_of(results, most=None):
        read.append(results.count())
        return known(results, most)

    known = survey.known_topics
    monkeypatch.setattr(survey, "batch_id", numbered)
    monkeypatch.setattr(survey, "known_topics", topics_of)

    def predict(instruction, messages):
        return json.dumps({"comments": [
            {"id": m[1:], "sentiment": "neutral", "topics": [{"topic": "T" + m[1], "pain_points": [], "moments_of_delight": []}]} for m in messages]})

    rows = spark.range(10, 80).select(F.col("id").cast("string"), F.concat(F.lit("m"), "id").alias("m"), F.repeat(F.lit("x"), 99).alias("more"))
    store = shared_path(spark, "topics")
    assert survey.induce_topics(rows, "id", "m", "first", "{topics}", predict, size=10, growth=2, store=store).count() == 70
    assert carried == [["id", "m"]] and read == [10, 20, 40]


def test_words_of_no_label_are_left_out_early(spark):
    phrases = spark.createDataFrame([("the slow Desk",), ("desk of the desk",), ("gate",), ("",), (None,)], "pp_mod string")
    mapped = map_fixed(phrases, ["Slow Desk", "Desk Staff"])
    assert {r.pp_mod: r.subtopic for r in mapped.collect()} == {
        "the slow Desk": "Slow Desk", "desk of the desk": "Desk Staff", "gate": "Other", "": "Other", None: "Other"}
    assert "array_intersect(array_remove" in mapped._jdf.queryExecution().optimizedPlan().toString()
