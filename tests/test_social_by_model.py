"""What is written of posts that a model reads."""

from pyspark.sql import functions as F

from voxtally.functions.staging import settle
from voxtally.plans import social
from voxtally.plans.final import AIRLINES


def test_posts_are_written_with_one_text(spark, monkeypatch):
    written = {}

    def kept(df, label):
        written[label] = df.columns
        return settle(df, label)

    def extract(rows):
        return rows.select(
            F.col("post").alias("review_id"), F.lit("negative").alias("sentiment"), F.col("Original Review").alias("topic"),
            F.lit(0).alias("topic_pos"), F.array(F.lit("slow")).alias("pain_points"), F.array().cast("array<string>").alias("moments_of_delight"))

    monkeypatch.setattr(social, "settle", kept)
    rows = [("b", "one"), ("a", "one"), ("c", "two"), ("d", None), ("e", "")]
    posts = spark.createDataFrame([(i, t, "X", "line") for i, t in rows], "post string, text string, label string, main_entity string").select(
        F.col("post").alias("INTERNAL UNIQUE ID"), F.col("text").alias("CONTENT"), F.lit("2025-01-01").cast("timestamp").alias("PUBLISHED AT"), "label", "main_entity")
    final = social.social_final(
        posts, "X", [], None, AIRLINES, "airline", extract=extract, mapper=lambda phrases, labels: phrases.withColumn("subtopic", F.lit("s")))
    got = sorted((r["Review_No"], r.topic, r["Original Review"], r["Translated Review"]) for r in final.where("`Original Review` <> ''").collect())
    assert got == [("a", "one", "one", "one"), ("b", "one", "one", "one"), ("c", "two", "two", "two")]
    assert final.where("coalesce(`Original Review`, '') = ''").count() == 2
    assert "Translated Review" not in written["posts"] and written["first"] == ["_text", "post"]
