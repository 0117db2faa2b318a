"""Run logs and id stores: what is asked, kept, skipped and read."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxtally.constants import PAIN
from voxtally.functions.replies import parse_numbered
from voxtally.operators.extract import model_extract
from voxtally.operators.idstore import IdStore
from voxtally.operators.infer import infer_batches, infer_resumable
from voxtally.operators.language import enrich_language, translate
from voxtally.operators.mapping import map_by_model, map_fixed_by_model
from voxtally.operators.runlog import RunLog
from voxtally.operators.taxonomy_jobs import clean_labels, expand_seed
from voxtally.schemas import EXTRACTED, EXTRACTION, RAW_POSTS, TRANSLATIONS
from voxtally.session import shared_path
from voxtally.streaming.inference import start_inference
from voxtally.streaming.ingest import start_ingest

PAIR = StructType().add("id", "string").add("value", "string")


def records(spark, n):
    return spark.range(n).select(F.col("id").cast("string"), F.concat(F.lit("m"), "id").alias("m"))


def upper_case(asked):
    def ask(part):
        def predict(instruction, messages):
            asked.add(len(messages))
            return json.dumps([m.upper() for m in messages])

        return infer_batches(part, "id", "m", predict, size=5)

    def read(replies):
        values = F.from_json("reply", "array<string>")
        rows = replies.where("ok").select(F.inline(F.arrays_zip(F.col("record_ids").alias("id"), values.alias("value"))))
        return rows, replies.where("false").withColumn("reject_reason", F.lit(""))

    return ask, read


def test_a_crash_loses_one_slice_and_no_reply(spark):
    asked = spark.sparkContext.accumulator(0)
    ask, read = upper_case(asked)
    store = shared_path(spark, "test")
    calls = []

    def dies(step, at):
        def run(df):
            calls.append(step)
            if calls.count(step) == at:
                raise RuntimeError("killed")
            return ask(df) if step == "ask" else read(df)

        return run

    def log():
        return RunLog(spark, store, "id", PAIR)

    with pytest.raises(RuntimeError):  # dies before the third slice is asked
        log().run(records(spark, 100), dies("ask", 3), read, slice_rows=20)
    first = log().answers().count()
    assert first == asked.value and 0 < first < 100
    with pytest.raises(RuntimeError):  # dies between the replies and the outcomes of a slice
        log().run(records(spark, 100), ask, dies("read", 2), slice_rows=20)
    paid = asked.value
    assert log().answers().count() < paid < 100
    assert log().run(records(spark, 100), ask, read, slice_rows=20).count() == 100
    assert asked.value == 100  # nothing is asked twice
    assert {(r.id, r.value) for r in log().answers().collect()} == {(str(i), f"M{i}") for i in range(100)}
    assert log().failures().count() == 0


def test_slices_stay_few_and_hold_every_record(spark, monkeypatch):
    from voxtally.operators import runlog

    monkeypatch.setattr(runlog, "SLICE_ROWS", 4)
    ask, read = upper_case(spark.sparkContext.accumulator(0))
    slices = []
    got = RunLog(spark, shared_path(spark, "test"), "id", PAIR).run(
        records(spark, 400), lambda part: slices.append(part.count()) or ask(part), read).collect()
    assert sorted(r.id for r in got) == sorted(str(i) for i in range(400))
    assert sum(slices) == 400 and len(slices) <= runlog.SLICES + 1


def test_outcomes_are_read_without_a_broadcast(spark):
    def predict(instruction, messages):
        ids = [m.split("\n")[0].split(": ")[1] for m in messages]
        return json.dumps({"reviews": [{"id": i, "subtopic": label} for i in ids for label in ("z", "b", "a")]})

    plans = []
    settled = RunLog._settle

    def watched(log, name, read):
        def seen(replies):
            found = read(replies)
            plans.extend(f._jdf.queryExecution().executedPlan().toString() for f in (found if isinstance(found, tuple) else (found,)))
            return found

        settled(log, name, seen)

    phrases = spark.createDataFrame([("T", PAIN, f"p{i}") for i in range(20)] + [("none", PAIN, "p")], "topic string, type string, pp_mod string")
    labels = spark.createDataFrame([("T", PAIN, "b"), ("T", PAIN, "z")], "topic string, type string, subtopic string")
    RunLog._settle = watched
    try:
        store = shared_path(spark, "test")
        got = map_by_model(phrases, labels, "go {subtopics}", predict, store).collect()
        fixed = map_fixed_by_model(
            phrases, ["b", "z"], "go", lambda i, m: json.dumps({"reviews": [
                {"pain_point": x.split("\n")[0].split(": ")[1], "topic": "T", "subtopic": s} for x in m for s in ("z", "b")]}),
            shared_path(spark, "test")).collect()
    finally:
        RunLog._settle = settled
    # The least of several answers counts; it is `a` here, which is no label.
    assert {(r.topic, r.subtopic) for r in got} == {("T", "Others"), ("none", None)}
    assert {(r.topic, r.subtopic) for r in fixed} == {("T", "b"), ("none", None)}
    assert plans and not any("left_anti" in p.lower() or "LeftAnti" in p or "SortAggregate" in p for p in plans)
    assert "Broadcast" not in plans[-1]


def test_failures_name_their_reason_and_go_when_answered(spark):
    def model(broken):
        def predict(instruction, messages):
            ids = [m.split(":")[0] for m in messages]
            if broken and "0" in ids:
                raise ValueError("down")
            if broken and "1" in ids:
                return '{"reviews":[}]}'
            if broken and "2" in ids:
                return json.dumps({"reviews": [{"id": i, "sentiment": "angry", "topics": []} for i in ids]})
            return json.dumps({"reviews": [{"id": i, "sentiment": "neutral", "topics": [
                {"topic": "T", "pain_points": list("abcde"), "moments_of_delight": []}]} for i in ids if not (broken and i == "3")]})

        return predict

    df = spark.range(6).select("id", F.concat("id", F.lit(":x")).alias("m")).coalesce(1)
    store = shared_path(spark, "test")
    log = RunLog(spark, store, "review_id", EXTRACTED)
    options = dict(size=1, retries=2, backoff=0.0, store=store)
    got = model_extract(df, "id", "m", "go", model(True), **options)
    assert {r.review_id for r in got.collect()} == {"4", "5"}
    assert {(r.review_id, r.reason, r.error, r.attempts) for r in log.failures().collect()} == {
        ("0", "call", "ValueError: down", 2), ("1", "malformed", None, 1), ("2", "invalid", None, 1), ("3", "unanswered", None, 1)}
    again = model_extract(df, "id", "m", "go", model(False), **options)
    assert sorted((r.review_id, tuple(r.pain_points)) for r in again.collect()) == [(str(i), ("a", "b", "c")) for i in range(6)]
    assert log.failures().count() == 0 and log.replies().count() == 10
    few = model_extract(df.where("id = 3"), "id", "m", "go", model(True), **options)
    assert [r.review_id for r in few.collect()] == ["3"]


def test_two_actions_ask_once(spark):
    asked = spark.sparkContext.accumulator(0)

    def lines(instruction, messages):
        asked.add(1)
        return messages[0]

    def labels(instruction, messages):
        asked.add(1)
        return json.dumps({"Subtopics": [{"type": "A", "service": "B", "old_subtopic": "c - D", "cleaned_subtopic": "C D"}]})

    def seeds(instruction, messages):
        asked.add(1)
        return json.dumps({"type": "A", "service": "B", "subtopics": [{"root_subtopic": "r", "positive_mods": [], "negative_mods": ["n"]}]})

    texts = spark.createDataFrame([(1, "eins"), (2, "eins"), (3, None)], "id int, t string")
    old = spark.createDataFrame([("A", "B", "c - D")], "type string, topic string, subtopic string")
    seed = spark.createDataFrame([("B", "A")], "CATEGORY_NAME string, TYPE string")
    for result, rows in ((translate(texts, "id", "t", lines, "go"), 3), (clean_labels(old, labels), 1), (expand_seed(seed, "go", seeds), 1)):
        before = asked.value
        assert result.count() == rows and len(result.collect()) == rows
        assert before == asked.value
    assert asked.value == 3


def test_english_rows_are_not_shuffled_and_no_key_is_null(spark):
    df = spark.createDataFrame([(i, "the plane was late and we were not told") for i in range(50)]
                               + [(90, "der Flug ist nicht für mich"), (91, None)], "id int, `Original Review` string")
    got = enrich_language(df, translator=lambda rows: translate(rows, "id", "_foreign", lambda p, m: m[0].upper(), "go"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = plan[plan.index("Join "):]
    english = plan[: plan.index("Join ")]
    assert plan.startswith("Union") and "Exchange" not in english and "sha2" not in english
    assert "isnotnull(_foreign" in join
    rows = {r.id: (r["Original Review Language"], r["Translated Review"]) for r in got.collect()}
    assert len(rows) == 52 and rows[90] == ("German", "DER FLUG IST NICHT FÜR MICH") and rows[91] == ("Unknown", None)
    assert rows[0] == ("English", "the plane was late and we were not told")


def test_translations_are_kept_by_text(spark):
    store = shared_path(spark, "test")
    df = spark.createDataFrame([(i, f"Text {i}") for i in range(6)], "id int, t string")

    def model(instruction, messages):
        return "\n".join(line + "\n  and on" for line in messages[0].split("\n") if "Text 3" not in line)

    got = {r.id: r.translated for r in translate(df, "id", "t", model, "go", store=store, parallelism=1).collect()}
    assert got[2] == "Text 2 and on" and sum(v is None for v in got.values()) >= 1
    log = RunLog(spark, store, "text_key", TRANSLATIONS)
    assert {r.reason for r in log.failures().collect()} == {"unanswered"}
    again = {r.id: r.translated for r in translate(df, "id", "t", lambda p, m: "1. rest", "go", size=1, store=store).collect()}
    assert all(again[i] == v for i, v in got.items() if v) and "rest" in again.values() and None not in again.values()


def test_wrapped_and_bracketed_numbers(spark):
    def lines(reply, count=3):
        return spark.createDataFrame([(reply,)], "r string").select(parse_numbered(F.col("r"), count)).head()[0]

    assert lines("Here you are:\n1. a\n   goes on\n\n2) b\n3.5 is part of b\n3. c") == ["a goes on", "b 3.5 is part of b", "c"]
    assert lines("1) a\r\n2) b\r\n3) c") == ["a", "b", "c"]
    assert lines("2. b\n2. again\n0. none\n7. seven") == [None, "b", None]
    assert lines("1.\n2. b") == ["", "b", None]
    assert lines(None) is None or lines(None) == [None, None, None]
    assert lines("", 0) == [] and lines("x", 1) == ["x"]
    many = "\n".join(f"{i}. t{i}\nmore" for i in range(20_000, 0, -1))
    assert lines(many, 20_000) == [f"t{i} more" for i in range(1, 20_001)]


# --- ids -----------------------------------------------------------------------------------------

def id_frame(spark, values):
    return spark.createDataFrame([(v, f"row {v}") for v in values], "id long, t string")


def test_ids_are_found_exactly_after_the_filter(spark):
    store = IdStore(spark, shared_path(spark, "test"), "id", "bigint", buckets=8, blocks=2)
    assert store.unseen(id_frame(spark, [1, None])).count() == 2
    store.add(id_frame(spark, range(0, 4000, 2)), "a")
    store.add(id_frame(spark, [None, 1]), "b")
    asked = id_frame(spark, [*range(5000), None])
    new = {r.id for r in store.unseen(asked).collect()}
    assert new == set(range(5000)) - set(range(0, 4000, 2)) - {1}
    assert store.unseen(asked, without="b").where("id = 1 OR id IS NULL").count() == 2
    store.add(id_frame(spark, [3]), "b")  # the batch again, with other rows
    assert store.unseen(id_frame(spark, [1, 3, None])).count() == 2
    passed = store.maybe_known(id_frame(spark, range(100_000, 110_000)).select(F.col("id").cast("string"))).count()
    assert passed < 500  # of 10,000 ids that are new
    assert store.merge(folders=2) is False and store.merge(folders=1) is True
    assert store.batches() == {"a", "b"} and store.unseen(id_frame(spark, [0, 3, 5])).count() == 1
    store.add(id_frame(spark, [5]), "c")
    assert store.unseen(id_frame(spark, [0, 3, 5, 7])).count() == 1 and store.batches() == {"a", "b", "c"}


def test_long_ids_are_kept_as_digests(spark):
    path, long = shared_path(spark, "test"), "x" * 5000
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "id string")
    store = IdStore(spark, path, "id", "string")
    store.add(frame([f"{long}{i}" for i in range(20)] + ["short", "ü" * 36]), "a")
    stored = [r.id for r in spark.read.parquet(f"{path}/32x64/ids").collect()]
    assert len(stored) == 22 and "short" in stored and max(len(v.encode()) for v in stored) == 71
    asked = frame([f"{long}{i}" for i in range(25)] + ["short", "ü" * 36, None])
    new = {f"{long}{i}" for i in range(20, 25)}
    assert {r.id for r in store.unseen(asked).collect()} == new | {None}
    assert {r.id for r in store.known(asked).collect()} == {f"{long}{i}" for i in range(20)} | {"short", "ü" * 36}
    store.add(frame([None]), "b")
    assert store.merge(folders=1) and {r.id for r in store.unseen(asked).collect()} == new


def test_only_touched_buckets_are_read(spark):
    path = shared_path(spark, "test")
    store = IdStore(spark, path, "id", "bigint", buckets=32)
    store.add(id_frame(spark, range(2000)), "a")
    asked = id_frame(spark, [5, 17, 10_000_000])
    touched = {r.bucket for r in store.maybe_known(asked.select(F.col("id").cast("string"))).collect()}
    assert 0 < len(touched) <= 3
    plan = store.known(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan[plan.index("PartitionFilters"):]
    for folder in Path(path).glob("32x64/ids/gen=0/batch=a/bucket=*"):
        if int(folder.name.split("=")[1]) not in touched:
            for file in folder.glob("part-*"):
                file.write_bytes(b"not parquet")  # would fail if it were read
    assert {r.id for r in store.unseen(asked).collect()} == {10_000_000}


def test_resumed_runs_read_only_the_keys_they_meet(spark):
    store = shared_path(spark, "test")
    asked = spark.sparkContext.accumulator(0)

    def infer(part):
        def rows(batches):
            for pdf in batches:
                asked.add(len(pdf))
                yield pdf.assign(sentiment="neutral", topic="T", pain_points=None, moments_of_delight=None)

        return part.select("review_id").mapInPandas(rows, EXTRACTION)

    keys = lambda n: spark.range(n).select(F.col("id").cast("string").alias("review_id"))
    assert infer_resumable(keys(30), "review_id", infer, store, EXTRACTION, 3).count() == 30
    # A run that died before it kept its ids: the answers are there, the store is caught up.
    keys(40).where("review_id >= 30").select("review_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in EXTRACTION.fields[1:]]).write.parquet(f"{store}/run=died-0")
    assert infer_resumable(keys(45), "review_id", infer, store, EXTRACTION).count() == 45
    assert asked.value == 35


# --- streams -------------------------------------------------------------------------------------

HEADER = "INTERNAL UNIQUE ID,CONTENT,PUBLISHED AT\n"


def test_ingest_detects_and_translates_new_posts_only(spark, tmp_path):
    source, sink, store = tmp_path / "in", f"{tmp_path}/sink", f"{tmp_path}/translations"
    source.mkdir()
    asked = spark.sparkContext.accumulator(0)

    def model(instruction, messages):
        asked.add(len(messages[0].split("\n")))
        return messages[0].upper()

    def run(checkpoint):
        start_ingest(spark, str(source), sink, f"{tmp_path}/{checkpoint}", RAW_POSTS, "INTERNAL UNIQUE ID", "CONTENT", fmt="csv", header=True,
                     translator=lambda rows: translate(rows, "INTERNAL UNIQUE ID", "_foreign", model, "go", store=store)).awaitTermination()
        rows = spark.read.parquet(sink).collect()
        return {r["INTERNAL UNIQUE ID"]: (r.label, r["Original Review Language"], r["Translated Review"]) for r in rows}, len(rows)

    (source / "a.csv").write_text(HEADER + "1,the flight was late and we were not told,2025-11-01\n2,der Flug ist nicht für mich,2025-11-01\n")
    want = {"1": ("AIRLINE", "English", "the flight was late and we were not told"), "2": ("OTHER", "German", "DER FLUG IST NICHT FÜR MICH")}
    got, n = run("one")
    assert n == 2 and {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()} and asked.value == 1
    (source / "b.csv").write_text(HEADER + "2,der Flug ist nicht für mich,2025-11-02\n3,der Flug ist nicht für mich,2025-11-02\n")
    got, n = run("one")
    assert n == 3 and got["3"][1:] == want["2"][1:] and asked.value == 1  # the text is known by then
    assert run("two")[1] == 3  # a lost checkpoint


def test_inference_takes_the_first_of_copies(spark, tmp_path):
    rows = [("1", "b"), ("1", "a"), ("2", None), ("2", "z")]
    spark.createDataFrame(rows, "id string, t string").repartition(4).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, t string").parquet(f"{tmp_path}/in")

    def infer(part):
        none = F.lit(None).cast("array<string>")
        return part.select("review_id", F.lit("neutral").alias("sentiment"), F.col("t").alias("topic"), none.alias("pain_points"), none.alias("moments_of_delight"))

    start_inference(stream, "id", infer, f"{tmp_path}/store", f"{tmp_path}/c").awaitTermination()
    got = spark.read.schema(EXTRACTION).parquet(f"{tmp_path}/store").collect()
    assert sorted((r.review_id, r.topic) for r in got) == [("1", "a"), ("2", "z")]
