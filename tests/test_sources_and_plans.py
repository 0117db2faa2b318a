import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from voxtally.constants import AIRLINE_COLUMNS, AIRPORT_COLUMNS
from voxtally.plans.final import AIRLINES, AIRPORTS, final_table, place_metadata, review_metadata
from voxtally.plans.prep import prep_places, prep_posts, prep_reviews, prep_survey
from voxtally.schemas import RAW_PLACES, RAW_POSTS, RAW_REVIEWS, SURVEY_COMMENTS
from voxtally.sources.files import (
    append_if_exists, contiguous_batches, read_folder_or_empty, read_many, write_table,
)
from voxtally.streaming.ingest import start_ingest
from voxtally.streaming.vocabulary import start_vocabulary

POSTS = "INTERNAL UNIQUE ID,CONTENT,PUBLISHED AT\n"


def test_read_many_csv(spark, tmp_path):
    (tmp_path / "a1.csv").write_text('﻿' + POSTS + '1,"two\nlines, ""quoted""",2025-11-01\n')
    (tmp_path / "a2.csv").write_text(POSTS + "2,NA,\n")
    df = read_many(spark, [f"{tmp_path}/a*.csv", f"{tmp_path}/none*.csv"], RAW_POSTS)
    got = {r["INTERNAL UNIQUE ID"]: r.CONTENT for r in df.collect()}
    assert got == {"1": 'two\nlines, "quoted"', "2": "NA"}
    assert read_many(spark, [f"{tmp_path}/none*.csv"], RAW_POSTS).count() == 0


def test_read_many_drifted_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("CONTENT,EXTRA,INTERNAL UNIQUE ID\nhello,x,1\n")
    (tmp_path / "2.csv").write_text(POSTS + "2,bye,2025-11-01\n")
    df = read_many(spark, [f"{tmp_path}/*.csv"], RAW_POSTS, columns=["`INTERNAL UNIQUE ID`", "CONTENT"], per_file=True)
    assert {tuple(r) for r in df.collect()} == {("1", "hello"), ("2", "bye")}
    with pytest.raises(Exception):  # wrong order must not pass silently
        read_many(spark, [f"{tmp_path}/1.csv"], RAW_POSTS).collect()


def test_files_of_one_header_share_a_reader(spark, tmp_path):
    heads = (["CONTENT", "INTERNAL UNIQUE ID"], ["INTERNAL UNIQUE ID", "CONTENT", "PUBLISHED AT"], ["EXTRA", "INTERNAL UNIQUE ID"])
    for i in range(300):
        head = heads[i % 3]
        (tmp_path / f"{i} ä.csv").write_text(",".join(head) + "\n" + ",".join(f"{name[0]}{i}" for name in head) + "\n")
    (tmp_path / "empty.csv").write_text("")
    df = read_many(spark, [f"{tmp_path}/*.csv"], RAW_POSTS, per_file=True)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 3
    got = {r["INTERNAL UNIQUE ID"]: (r.CONTENT, r["PUBLISHED AT"]) for r in df.collect()}
    assert got == {f"I{i}": ((f"C{i}", None), (f"C{i}", f"P{i}"), (None, None))[i % 3] for i in range(300)}


def test_folders(spark, tmp_path):
    schema = StructType().add("a", "long").add("b", "string")
    df = spark.createDataFrame([(1, "x"), (2, None)], schema)
    assert read_folder_or_empty(spark, f"{tmp_path}/absent", schema).count() == 0
    (tmp_path / "empty").mkdir()
    assert read_folder_or_empty(spark, f"{tmp_path}/empty", schema).count() == 0
    write_table(df.withColumn("l", F.array("b", "b")), f"{tmp_path}/csv", "csv")
    assert read_folder_or_empty(spark, f"{tmp_path}/csv", StructType(list(schema.fields)).add("l", "string"), "csv").count() == 2
    write_table(df, f"{tmp_path}/part", partition_by=["a"])
    assert read_folder_or_empty(spark, f"{tmp_path}/part", schema).orderBy("a").collect() == df.collect()
    assert append_if_exists(df, f"{tmp_path}/absent", ["b", "a"]).columns == ["b", "a"]


def test_contiguous_batches(spark):
    df = spark.createDataFrame([(n, n * 10) for n in (1, 2, 2, 4, 5)], "b long, v int")
    assert sorted(r.v for r in contiguous_batches(df, "b", 6).collect()) == [10, 20, 20]
    assert sorted(r.v for r in contiguous_batches(df, "b", 2).collect()) == [10]
    assert contiguous_batches(df.where("b > 1"), "b", 6).count() == 0


def test_prep_reviews(spark):
    rows = [("1", "TripAdvisor", "a", "03/11/2025"), ("1", "TripAdvisor", "a", None), ("1", "tripadvisor", "b", "2025-11-09"),
            ("2", "TRIPADVISOR", "c", "2025-12-01"), ("2", "other", "c", "2025-12-02"),
            ("3", "tripadvisor", "d", "Oct 31, 2025"), ("4", "tripadvisor", "d", "garbage")]
    df = spark.createDataFrame([(*r, "en", "t", "t", 1.0) for r in rows], RAW_REVIEWS.fieldNames()).select(
        *[F.col(f.name).cast(f.dataType) for f in RAW_REVIEWS.fields])
    # The newer copy of review 2 comes from another source, so the review is gone.
    assert [(r.review_unique_id, r.airline, r.date) for r in prep_reviews(df).collect()] == [("1", "b", "2025-11-09")]


def places(spark):
    rows = [("2025-11-01T01:00:00+03:00", "King Khalid International Airport", 1.0, "early", None, "ar", "g"),
            ("2025-11-02T01:00:00Z", "King Khalid International Airport", 5.0, "good", "طيب", "ar ", "g"),
            ("2025-11-02T01:00:00Z", "King Khalid International Airport", 5.0, "good", "طيب", "ar ", "g"),
            ("2025-11-03T01:00:00Z", "King Fahd International Airport", 2.0, "bad", "", "xx", "g"),
            ("2025-11-03T01:00:00Z", "Elsewhere", 2.0, "bad", "", "xx", "g"), ("soon", "King Fahd International Airport", 2.0, "bad", "", "xx", "g")]
    return prep_places(spark.createDataFrame(rows, RAW_PLACES))


def test_prep_places(spark):
    assert [(r.Review_No, r.Airport, r.text) for r in places(spark).orderBy("Review_No").collect()] == [
        (1, "RUH", "good"), (2, "DMM", "bad")]


def test_prep_posts_and_survey(spark):
    posts = spark.createDataFrame([("1", "late flight", "2025-11-02"), ("1", "first", "2025-11-01"), ("2", None, "x")], RAW_POSTS)
    got = {r["INTERNAL UNIQUE ID"]: (r.CONTENT, r.label) for r in prep_posts(posts).collect()}
    assert got == {"1": ("first", "OTHER"), "2": (None, None)}
    survey = spark.createDataFrame([("1", "web", "short"), ("2", "web", "long enough!"), ("3", "web", None)], SURVEY_COMMENTS)
    assert [(r.id, r.number_of_words, r.number_of_tokens) for r in prep_survey(survey).collect()] == [("2", 2, 3)]


def test_final_airports(spark, tmp_path):
    extraction = spark.createDataFrame(
        [("1", "positive", "Baggage", [], ["fast belt"]), ("2", "negative", "Lounge", ["dirty"], []), ("9", "negative", "Lounge", ["x"], [])],
        "review_id string, sentiment string, topic string, pain_points array<string>, moments_of_delight array<string>")
    labels = spark.createDataFrame([("1-0-d-0", "quick-Belt")], "id string, subtopic string")
    got = final_table(extraction, labels, place_metadata(places(spark)), AIRPORTS)
    assert got.columns == list(AIRPORT_COLUMNS)
    rows = {r.Review_No: r for r in got.collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].topic == "Baggage Services" and rows["1"].subtopic == "Quick Belt"
    assert rows["1"]["Original Review"] == "طيب" and rows["1"]["Original Review Language"] == "Arabic"
    assert rows["2"]["Original Review"] == "bad" and rows["2"].subtopic is None and rows["2"].date == "2025-11-03"
    stored = f"{tmp_path}/posts"
    write_table(got.limit(1), stored)
    assert final_table(extraction, None, place_metadata(places(spark)), AIRPORTS, stored).count() == 3


def test_final_airports_by_key_and_pushed_instant(spark, tmp_path):
    write_table(places(spark), f"{tmp_path}/places")
    stored = spark.read.parquet(f"{tmp_path}/places")
    keys = {r.Review_No: r.Review_Key for r in stored.collect()}
    extraction = spark.createDataFrame(
        [(keys[1], "positive", "Baggage", [], ["fast belt"]), (keys[2], "negative", "Lounge", ["dirty"], [])],
        "review_id string, sentiment string, topic string, pain_points array<string>, moments_of_delight array<string>")
    got = final_table(extraction, None, place_metadata(stored, "Review_Key", AIRPORTS.min_date), AIRPORTS)
    assert got.columns == list(AIRPORT_COLUMNS)
    assert {(r.Review_No, r.Airport, r.date) for r in got.collect()} == {("1", "RUH", "2025-11-02"), ("2", "DMM", "2025-11-03")}
    assert "GreaterThanOrEqual(published_at_datetime_x" in got._jdf.queryExecution().executedPlan().toString()
    late = place_metadata(stored, "Review_Key", "2025-11-03")
    assert [r.Review_No for r in late.collect()] == [keys[2]]


def test_typed_dates_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([("1", "tripadvisor", "a", "03/11/2025", "en", "t", "t", 1.0)], RAW_REVIEWS)
    write_table(prep_reviews(df, typed=True), f"{tmp_path}/reviews")
    meta = review_metadata(spark.read.parquet(f"{tmp_path}/reviews"))
    extraction = spark.createDataFrame(
        [("1", "negative", "Flights", ["late"], [])],
        "review_id string, sentiment string, topic string, pain_points array<string>, moments_of_delight array<string>")
    got = final_table(extraction, None, meta, AIRLINES)
    assert [r.date for r in got.collect()] == ["2025-11-03"]
    assert "GreaterThanOrEqual(date" in got._jdf.queryExecution().executedPlan().toString()


def test_final_airlines_filters_on_the_metadata_side(spark, tmp_path):
    reviews = spark.createDataFrame([("1", "s", "a", "2025-11-03", "en", "t", "t", 1.0)], RAW_REVIEWS)
    write_table(reviews.withColumn("date", F.to_date("date")), f"{tmp_path}/reviews")
    extraction = spark.createDataFrame(
        [("1", "negative", "Flights", ["late"], [])],
        "review_id string, sentiment string, topic string, pain_points array<string>, moments_of_delight array<string>")
    got = final_table(extraction, None, review_metadata(spark.read.parquet(f"{tmp_path}/reviews")), AIRLINES)
    assert got.columns == list(AIRLINE_COLUMNS) and got.count() == 1
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" not in text and "GreaterThanOrEqual(date" in text


def test_ingest_restarts_and_new_checkpoints_keep_one_row_per_id(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    sink = f"{tmp_path}/sink"

    def run(checkpoint):
        start_ingest(spark, str(source), sink, f"{tmp_path}/{checkpoint}", RAW_POSTS, "INTERNAL UNIQUE ID", "CONTENT",
                     fmt="csv", header=True).awaitTermination()
        return sorted((r["INTERNAL UNIQUE ID"], r.label) for r in spark.read.parquet(sink).collect())

    (source / "a.csv").write_text(POSTS + "1,flight,2025-11-01\n1,flight,2025-11-02\n2,airport,2025-11-01\n")
    assert run("one") == [("1", "AIRLINE"), ("2", "AIRPORT")]
    (source / "b.csv").write_text(POSTS + "2,airport,2025-11-01\n3,x,2025-11-01\n")
    want = [("1", "AIRLINE"), ("2", "AIRPORT"), ("3", "OTHER")]
    assert run("one") == want and run("one") == want and run("two") == want


def test_vocabulary_stream(spark, tmp_path):
    schema = StructType().add("topic", "string")
    for n, values in enumerate((["a", "b", None], ["b", "c"])):
        spark.createDataFrame([(v,) for v in values], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        start_vocabulary(stream, "topic", f"{tmp_path}/v", f"{tmp_path}/c").awaitTermination()
    assert sorted(r.topic for r in spark.read.parquet(f"{tmp_path}/v").collect()) == ["a", "b", "c"]
