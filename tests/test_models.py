"""Model operators with stand-in models."""

import json

import pytest
from pyspark.sql import functions as F

from voxtally.operators.classify import classify_fallback
from voxtally.operators.extract import model_extract
from voxtally.operators.infer import infer_batches, infer_resumable
from voxtally.operators.language import enrich_language, translate
from voxtally.operators.mapping import map_by_model
from voxtally.operators.survey import induce_topics
from voxtally.operators.taxonomy_jobs import clean_labels
from voxtally.schemas import EXTRACTION
from voxtally.session import shared_path


def messages(spark, n, parts=3):
    return spark.range(n).select(F.col("id").cast("string"), F.concat(F.lit("m"), "id").alias("m")).repartition(parts)


def test_batches_cover_all_records(spark):
    def predict(instruction, texts):
        import json

        return json.dumps([instruction, texts])

    rows = infer_batches(messages(spark, 100), "id", "m", predict, "go", size=7).collect()
    assert sorted(i for r in rows for i in r.record_ids) == sorted(map(str, range(100)))
    for row in rows:
        prompt, texts = json.loads(row.reply)
        assert prompt == "go" and len(texts) <= 7 and texts == [f"m{i}" for i in row.record_ids]
        assert row.ok and row.attempts == 1


def test_groups_are_not_mixed_and_hot_groups_are_split(spark):
    df = messages(spark, 900).withColumn("g", F.when(F.col("id") < "5", "hot").otherwise(F.col("id").substr(1, 1)))
    rows = infer_batches(df, "id", "m", lambda p, t: "{}", F.col("g"), ["g"], size=10).collect()
    assert sum(len(r.record_ids) for r in rows) == 900
    assert max(len(r.record_ids) for r in rows) == 10
    ids = [r.record_ids for r in rows if r.g == "hot"]
    assert len(ids) >= sum(map(len, ids)) / 10


def test_retries_and_failures(spark):
    def factory():
        calls = {}

        def predict(instruction, texts):
            key = texts[0]
            calls[key] = calls.get(key, 0) + 1
            if key == "m0":
                raise ValueError("down")
            if key == "m1" and calls[key] < 3:
                return '{"cut": [1, 2'
            if key == "m2" and calls[key] < 2:
                raise OSError("once")
            return '{"fine": "x"}' if key != "m3" else '{"bad" 1}'

        return predict

    rows = infer_batches(messages(spark, 4, 1), "id", "m", factory, size=1, backoff=0.0, factory=True).collect()
    got = {r.record_ids[0]: (r.ok, r.attempts, r.error) for r in rows}
    assert got == {"0": (False, 3, "ValueError: down"), "1": (True, 3, None), "2": (True, 2, None), "3": (True, 1, None)}


def answer(records):
    return json.dumps({"reviews": records})


def test_model_extract_checks_answers(spark):
    def predict(instruction, texts):
        import json

        records = [{"id": t.split(":")[0], "sentiment": "neutral",
                    "topics": [{"topic": "T"}, {"topic": "Made Up", "pain_points": ["p"]}]} for t in texts
                   if not t.startswith("2")]
        records.append({"id": "99", "sentiment": "neutral", "topics": []})
        records.append({**records[0], "sentiment": "positive"})
        records.append({"id": "3", "sentiment": "negative", "topics": []})
        return json.dumps({"reviews": records})

    df = spark.range(3).select("id", F.concat("id", F.lit(":x")).alias("m")).coalesce(1)
    got = {(r.review_id, r.sentiment, r.topic, r.topic_pos) for r in model_extract(
        df, "id", "m", "go", predict, ["T", "Others"]).collect()}
    assert got == {(i, "neutral", t, n) for i in "01" for n, t in enumerate(["T", "Others"])}


def test_answered_record_without_topics_is_done(spark):
    df = spark.range(1).select("id", F.lit("x").alias("m"))
    row = model_extract(df, "id", "m", "go", lambda p, t: '{"reviews":[{"id":"0","sentiment":"neutral","topics":[]}]}').head()
    assert row.review_id == "0" and row.topic is None


def test_resume_asks_only_for_what_is_missing(spark):
    store = shared_path(spark, "test")
    asked = spark.sparkContext.accumulator(0)

    def infer(part):
        def rows(batches):
            for pdf in batches:
                asked.add(len(pdf))
                yield pdf[pdf.review_id != "7"].assign(
                    sentiment="neutral", topic="T", pain_points=None, moments_of_delight=None)

        return part.select("review_id").mapInPandas(rows, EXTRACTION)

    def records(ids):
        return spark.createDataFrame([(str(i),) for i in ids], "review_id string")

    assert infer_resumable(records(range(0, 20, 2)), "review_id", infer, store, EXTRACTION, 3).count() == 10
    assert asked.value == 10
    done = infer_resumable(records(range(20)), "review_id", infer, store, EXTRACTION)
    assert asked.value == 20 and done.count() == 19 and done.columns == EXTRACTION.names
    infer_resumable(records(range(20)), "review_id", infer, store, EXTRACTION)
    assert asked.value == 21  # 7 had no answer and is asked again


def test_translate(spark):
    def predict(instruction, texts):
        lines = texts[0].split("\n")
        return "\n".join([f"{line} EN" for line in lines[:-1]] + [""])

    df = spark.createDataFrame([(1, "a\nb"), (2, "c"), (3, "a\nb"), (4, None), (5, "d")], "id int, t string").coalesce(1)
    got = {r.id: r.translated for r in translate(df, "id", "t", predict, "go", parallelism=1).collect()}
    assert got[1] == got[3] and got[4] is None
    assert sum(v is None for k, v in got.items()) >= 2  # the last line of the batch is missing

    def broken(instruction, texts):
        raise RuntimeError

    got = translate(df, "id", "t", broken, "go", backoff=0.0).collect()
    assert len(got) == 5 and all(r.translated is None for r in got)


def test_enrich_language(spark):
    df = spark.createDataFrame([(1, "the plane was late and we were not told"), (2, "der Flug ist nicht für mich")],
                               "id int, `Original Review` string")
    got = {r["id"]: (r["Original Review Language"], r["Translated Review"]) for r in enrich_language(
        df, translator=lambda rows: rows.withColumn("translated", F.upper("_foreign"))).collect()}
    assert got == {1: ("English", "the plane was late and we were not told"), 2: ("German", "DER FLUG IST NICHT FÜR MICH")}


def test_map_by_model_asks_each_phrase_once(spark):
    asked = spark.sparkContext.accumulator(0)

    def predict(instruction, texts):
        import json

        asked.add(len(texts))
        return json.dumps({"reviews": [{"id": t.split("\n")[0][4:], "subtopic": "Slow Desk" if "slow" in t else "Odd"}
                                       for t in texts]})

    phrases = spark.createDataFrame(
        [(str(i), "T", "Pain Point", "slow" if i % 3 else "fast") for i in range(30)] + [("x", "V", "Pain Point", "slow")],
        "phrase_id string, topic string, type string, pp_mod string")
    labels = spark.createDataFrame([("T", "Pain Point", "Slow Desk")], "topic string, type string, subtopic string")
    store = shared_path(spark, "test")
    for _ in range(2):
        got = map_by_model(phrases, labels, "{type}: {subtopics}", predict, store)
        assert {(r.pp_mod, r.topic, r.subtopic) for r in got.collect()} == {
            ("slow", "T", "Slow Desk"), ("fast", "T", "Others"), ("slow", "V", None)}
        assert got.count() == 31
    assert asked.value == 2


@pytest.mark.parametrize("growth", [1, 2])
def test_topics_grow_from_round_to_round(spark, growth):
    def predict(instruction, texts):
        import json

        known = instruction.split(": ", 1)[1].split(", ") if ": " in instruction else []
        return json.dumps({"comments": [
            {"id": t, "sentiment": "neutral", "topics": [{"topic": f"T{len(known)}"}]} for t in texts]})

    df = spark.range(10, 70).select(F.col("id").cast("string"), F.col("id").cast("string").alias("m"))
    store = shared_path(spark, "test")
    rows = induce_topics(df, "id", "m", "first", "known: {topics}", predict, size=10, growth=growth, store=store).collect()
    assert len(rows) == 60
    topics = {int(r.review_id) // 10: r.topic for r in rows}
    if growth == 1:  # six batches of ten, one per round
        assert topics == {n: f"T{n - 1}" for n in range(1, 7)}
    else:  # rounds of 1, 2 and 3 batches
        assert topics == {1: "T0", 2: "T1", 3: "T1", 4: "T2", 5: "T2", 6: "T2"}

    def never(instruction, texts):
        raise AssertionError

    again = induce_topics(df, "id", "m", "first", "known: {topics}", never, size=10, growth=growth, store=store)
    assert again.count() == 60


def test_classify_fallback_keeps_unanswered(spark):
    df = spark.createDataFrame([(1, "a", "OTHER", "Unknown"), (2, "b", "AIRLINE", "Unknown"), (3, "c", "AIRPORT", "RUH")],
                               "id int, t string, label string, main_entity string")
    reply = '{"tweets":[{"id":"1","label":"AIRPORT","main_entity":"JED"},{"id":"3","label":"OTHER","main_entity":"Unknown"}]}'
    got = {r.id: (r.label, r.main_entity) for r in classify_fallback(
        df.coalesce(1), "id", "t", "go", lambda p, t: reply).collect()}
    assert got == {1: ("AIRPORT", "JED"), 2: ("AIRLINE", "Unknown"), 3: ("AIRPORT", "RUH")}


def test_clean_labels_by_model(spark):
    df = spark.createDataFrame([("Airline", "Cargo", "dirty", "Lounge")], "type string, topic string, Mod string, root_subtopic string")
    reply = ('{"Subtopics":[{"type":"Airline","service":"Cargo","cleaned_subtopic":"Dirty Lounge",'
             '"old_subtopic":"dirty - Lounge"}]}')
    assert clean_labels(df, lambda p, t: reply).head().cleaned_subtopic == "Dirty Lounge"
    assert clean_labels(df).head().asDict() == {
        "type": "Airline", "service": "Cargo", "old_subtopic": "dirty - Lounge", "cleaned_subtopic": "Dirty Lounge"}


def test_topics_are_resumed_by_record(spark):
    import json

    def model(broken):
        def predict(instruction, texts):
            if any(t in broken for t in texts):
                raise RuntimeError("down")
            return json.dumps({"comments": [{"id": t, "sentiment": "neutral", "topics": [{"topic": "T" + t}]} for t in texts]})

        return predict

    def records(*ids):
        return spark.createDataFrame([(i, i) for i in ids], "id string, m string")

    store = shared_path(spark, "test")
    options = dict(size=2, store=store, retries=1, backoff=0)
    part = induce_topics(records("02", "03", "04", "05"), "id", "m", "first", "known: {topics}", model({"04"}), **options)
    assert {r.review_id for r in part.collect()} == {"02", "03"}
    whole = induce_topics(records("01", "02", "03", "04", "05", "06"), "id", "m", "first", "known: {topics}", model(set()), **options)
    assert sorted((r.review_id, r.topic) for r in whole.collect()) == [(f"0{i}", f"T0{i}") for i in range(1, 7)]
    few = induce_topics(records("03"), "id", "m", "first", "known: {topics}", model({"03"}), **options)
    assert [r.review_id for r in few.collect()] == ["03"]


def test_translations_land_on_their_text(spark):
    def predict(instruction, messages):
        lines = messages[0].split("\n")
        return "\n".join(line.replace(". ", ". EN ") for line in reversed(lines) if "skip" not in line) + "\n77. unasked\n\n1. again"

    df = spark.createDataFrame([(i, t) for i, t in enumerate(["eins", "skip me", "drei", "vier", "eins", None])], "id int, t string").coalesce(1)
    got = {r.id: r.translated for r in translate(df, "id", "t", predict, "go").collect()}
    assert got == {0: "EN eins", 1: None, 2: "EN drei", 3: "EN vier", 4: "EN eins", 5: None}


def test_prompts_do_not_travel_with_rows(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("c", "3", "z")], "g string, id string, m string")
    plans = {}
    for name, instruction in (("text", "go"), ("groups", {("a",): "for a", ("b",): "for b"})):
        asked = infer_batches(df, "id", "m", lambda p, t: f"{p}:{t[0]}", instruction, ["g"], json_reply=False)
        plans[name] = asked._jdf.queryExecution().executedPlan().toString()
        assert "_prompt" not in plans[name]
        want = {"text": {"go:x", "go:y", "go:z"}, "groups": {"for a:x", "for b:y"}}[name]
        assert {r.reply for r in asked.collect()} == want
