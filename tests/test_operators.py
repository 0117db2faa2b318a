import random

import pytest
from pyspark.sql import functions as F

from voxtally.constants import KEYWORD_RULES
from voxtally.operators.classify import keyword_classify
from voxtally.operators.dedup import keep_first, keep_latest
from voxtally.operators.extract import rule_extract
from voxtally.operators.joins import join_bounded, join_labels, lookup_inner, new_only, unmapped
from voxtally.operators.keys import batch_id, batch_id_within, dense_id, dense_id_within
from voxtally.operators.language import detect_language
from voxtally.operators.mapping import map_by_overlap, map_fixed
from voxtally.operators.phrases import explode_phrases, stack_phrases
from voxtally.operators.rollup import StepCounts, label_distribution, string_agg_list, vocabulary
from voxtally.sources.taxonomy import taxonomy_labels, topic_list, upper_type, valid_topics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_latest(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", "2025-01-02", 2), ("a", "2025-01-01", 3), ("b", "2025-01-01", 5),
         ("b", "2025-01-01", 4), (None, None, 6), (None, "2025-01-01", 7)], "id string, d string, n int")
    got = {(r.id, r.n) for r in keep_latest(df, "id", "d", [F.col("n")]).collect()}
    assert got == {("a", 2), ("b", 4), (None, 7)}
    shuffled = df.orderBy(F.desc("n"))
    assert {(r.id, r.n) for r in keep_latest(shuffled, "id", "d", [F.col("n")]).collect()} == got


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(keep_first(df, "k", [F.col("id")]))
    assert text.index("WindowGroupLimit", text.index("Exchange")) > text.index("Exchange")
    assert text.count("WindowGroupLimit") == 2


def skewed(spark, n=5000):
    """A third of the rows share one group."""
    rng = random.Random(7)
    rows = [(i, "hot" if i % 3 == 0 else f"g{rng.randrange(40)}" if i % 50 else None) for i in range(n)]
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "id long, grp string").repartition(6)


def test_dense_id_against_brute_force(spark):
    rows, df = skewed(spark)
    want = {i: n for n, (i, _) in enumerate(sorted(rows), 1)}
    assert {r.id: r.row_id for r in dense_id(df, ["id"]).collect()} == want
    got = {r.id: r.batch for r in batch_id(df, ["id"], 50).collect()}
    assert got == {i: (n - 1) // 50 + 1 for i, n in want.items()}


def test_dense_id_within_against_brute_force(spark):
    rows, df = skewed(spark)
    want, seen = {}, {}
    for i, group in sorted(rows):
        seen[group] = seen.get(group, 0) + 1
        want[i] = seen[group]
    assert {r.id: r.row_id for r in dense_id_within(df, "grp", ["id"]).collect()} == want
    assert {r.id: r.batch for r in batch_id_within(df, "grp", ["id"], 7).collect()} == {
        i: (n - 1) // 7 for i, n in want.items()}


def test_dense_id_needs_no_single_partition_window(spark):
    _, df = skewed(spark, 100)
    text = plan(dense_id(df, ["id"]))
    assert "SinglePartition" not in text and "Window" not in text


def test_dense_id_of_nothing(spark):
    assert dense_id(spark.createDataFrame([], "id long"), ["id"]).count() == 0


def test_join_bounded_ways_agree(spark):
    _, df = skewed(spark)
    table = spark.createDataFrame([("hot", 1), ("g1", 2), ("g2", 3)], "grp string, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        small = join_bounded(df, table, ["grp"], how)
        large = join_bounded(df, table, ["grp"], how, max_bytes=0)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))
    assert "BroadcastHashJoin" in plan(join_bounded(df, table, ["grp"]))
    assert "_salt" in plan(join_bounded(df, table, ["grp"], max_bytes=0))


def test_labels_do_not_multiply_phrases(spark):
    phrases = spark.createDataFrame([("1", "a"), ("2", "b")], "phrase_id string, pp_mod string")
    labels = spark.createDataFrame([("1", "y"), ("1", "x"), (None, "z"), ("9", "q")], "id string, subtopic string")
    assert {(r.phrase_id, r.subtopic) for r in join_labels(phrases, labels).collect()} == {("1", "x"), ("2", None)}
    assert {r.subtopic for r in join_labels(phrases, labels.limit(0)).collect()} == {None}


def test_lookups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "p string")
    table = spark.createDataFrame([("a", "X"), ("a", "Y")], "p string, code string")
    assert [r.code for r in lookup_inner(df, "p", {"a": "X"}, "code").collect()] == ["X"]
    assert lookup_inner(df, "p", table, "code").count() == 1
    assert {r.p for r in unmapped(df, "p", {"a": "X"}).collect()} == {"b", None}
    assert {r.p for r in unmapped(df, "p", table).collect()} == {"b", None}
    assert {r.p for r in new_only(df, df.where("p is null or p = 'b'"), "p").collect()} == {"a"}


def brute_classify(text, rules=KEYWORD_RULES):
    if text is None:
        return None, None
    for label, entity, keywords in rules:
        if any(k.lower() in text.lower() for k in keywords):
            return label, entity
    return "OTHER", "Unknown"


def test_keyword_classify(spark):
    texts = ["RIYADH airport", "my Saudia flight from Jeddah", "وصلت إلى مطار الرياض", "flynas was late",
             "طيران ناس", "the gate", "class", "nothing here", "", None, "Terminal 4", "terminal 5",
             "@KKIA", "é only", "أديل", "svelte", "chair"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: (r.label, r.main_entity) for r in keyword_classify(df, "t").collect()}
    assert got == {t: brute_classify(t) for t in texts}
    whole = {r.t: r.main_entity for r in keyword_classify(df, "t", word_boundary=True).collect()}
    assert whole["svelte"] == "Unknown" and whole["flynas was late"] == "flynas"
    text = plan(keyword_classify(df, "t"))
    assert not any(word in text for word in ("NestedLoop", "Python", "Exchange"))


def test_explode_phrases(spark):
    df = spark.createDataFrame(
        [("1", "neutral", "T", "a,, B C ,"), ("2", "neutral", "T", ""), ("3", "neutral", "T", "  "),
         ("4", "neutral", "T", None), ("5", None, "T", "\tx\n, y")],
        "id string, sentiment string, topic string, p string")
    got = explode_phrases(df, "id", "p", "Pain Point").collect()
    assert {(r.phrase_id, r.pp_mod) for r in got} == {
        ("1-0-p-0", "a"), ("1-0-p-2", "b c"), ("5-0-p-0", "x"), ("5-0-p-1", "y")}
    raw = explode_phrases(df, "id", "p", "Pain Point", keep_empty=True).collect()
    assert sorted((r.Review_No, r.pp_mod) for r in raw) == [
        ("1", ""), ("1", ""), ("1", "a"), ("1", "b c"), ("2", ""), ("3", "")]


def test_stack_keeps_commas_of_lists(spark):
    df = spark.createDataFrame(
        [("1", "neutral", "T", ["slow, really slow"], None), ("2", "neutral", "T", [], ["Good "])],
        "review_id string, sentiment string, topic string, pain_points array<string>, moments_of_delight array<string>")
    got = {(r.phrase_id, r.pp_mod, r.type) for r in stack_phrases(df).collect()}
    assert got == {("1-0-p-0", "slow, really slow", "Pain Point"), ("2-0-d-0", "good", "Moment of Delight")}


def test_rule_extract(spark):
    lexicon = [(w, "pain", "A") for w in ("p1", "p2", "p3", "p4")] + [("d1", "delight", "B")]
    df = spark.createDataFrame([(1, "P4 p3 p2 p1"), (2, "d1"), (3, "p1 d1"), (4, "none"), (5, None)], "id int, t string")
    got = {(r.review_id, r.sentiment, r.topic, tuple(r.pain_points), tuple(r.moments_of_delight))
           for r in rule_extract(df, "id", "t", lexicon).collect()}
    assert got == {
        ("1", "negative", "A", ("p1", "p2", "p3"), ()), ("2", "positive", "B", (), ("d1",)),
        ("3", "neutral", "A", ("p1",), ()), ("3", "neutral", "B", (), ("d1",)),
        ("4", "neutral", "Others", (), ()), ("5", "neutral", "Others", (), ())}


LABELS = [("T", "Pain Point", "Slow Service Desk"), ("T", "Pain Point", "Dirty Desk"),
          ("T", "Pain Point", "Clean Hall"), ("U", "Pain Point", "Late Bus")]


def test_map_by_overlap_both_ways(spark):
    phrases = spark.createDataFrame(
        [("1", "T", "Pain Point", "slow desk"), ("2", "T", "Pain Point", "desk"), ("3", "T", "Pain Point", "zzz"),
         ("4", "V", "Pain Point", "desk"), ("5", "U", "Pain Point", "bus, late LATE"),
         ("6", "T", "Pain Point", "desk")],
        "phrase_id string, topic string, type string, pp_mod string")
    labels = spark.createDataFrame(LABELS, "topic string, type string, subtopic string")
    want = {"1": "Slow Service Desk", "2": "Dirty Desk", "3": "Others", "4": None, "5": "Late Bus", "6": "Dirty Desk"}
    assert {r.phrase_id: r.subtopic for r in map_by_overlap(phrases, labels).collect()} == want
    by_word = map_by_overlap(phrases, labels, max_bytes=0)
    assert {r.phrase_id: r.subtopic for r in by_word.collect()} == want
    fixed = map_fixed(phrases, [label for _, _, label in LABELS])
    assert {r.phrase_id: r.subtopic for r in fixed.collect()}["4"] == "Dirty Desk"
    assert "Exchange hashpartitioning(topic" not in plan(map_by_overlap(phrases, labels)).split("BroadcastExchange")[0]


def test_detect_language(spark):
    texts = {
        "the plane was late and we were not told": "en", "le vol est dans une heure pour nous": "fr",
        "der Flug ist nicht für mich und die Crew": "de", "el vuelo es muy tarde para los niños": "es",
        "الرحلة متأخرة جدا": "ar", "рейс задержан": "ru", "飛行機は遅れた": "ja", "航班延误": "zh",
        "비행기가 늦었다": "ko", "เครื่องบินล่าช้า": "th", "η πτήση": "el", "הטיסה": "iw", "1234 !!": "unknown", "": "unknown",
        "پرواز دیر شد": "fa",
    }
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r.t: r.lang_code for r in detect_language(df, "t").collect()}
    assert got == {**texts, None: "unknown"}


def test_language_accuracy_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    right = detect_language(docs, "text").agg(F.avg((F.col("lang_code") == F.col("lang")).cast("int"))).head()[0]
    assert right > 0.97


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (None, "x")], "k string, v string")
    got = {(r.field, r.value, r.n) for r in label_distribution(df, "k", "v").collect()}
    assert got == {("k", "a", 2), ("v", "x", 2)}
    assert [r.k for r in vocabulary("k", df, spark.createDataFrame([("0",)], "k string")).collect()] == ["0", "a"]
    with pytest.raises(Exception, match="more than 1 values"):
        string_agg_list(spark.createDataFrame([("g", "a"), ("g", "b")], "g string, v string"), ["g"], "v", "l", 1).collect()


def test_step_counts(spark):
    counts = StepCounts()
    df = counts.step(counts.step(spark.range(10), "all").where("id > 6"), "kept")
    df.write.format("noop").mode("overwrite").save()
    assert counts.rows() == [(1, "all", 10), (2, "kept", 3)]


def test_taxonomy(spark):
    rows = [("Airline", "T", "Desk", "slow, well-worn, Poor Experience with", "fast"),
            ("AIRLINE", "U", "Bus", "poor experience with", None), ("AIRPORT", "V", "Hall", "x", "y")]
    table = upper_type(spark.createDataFrame(
        rows, "type string, topic string, root_subtopic string, negative_mods string, positive_mods string"))
    got = {(r.topic, r.type, r.subtopic) for r in taxonomy_labels(table, "AIRLINE").collect()}
    assert got == {("T", "Pain Point", "Slow Desk"), ("T", "Pain Point", "Well-Worn Desk"),
                   ("T", "Moment of Delight", "Fast Desk")}
    assert {r.topic for r in valid_topics(table, "AIRLINE").collect()} == {"T", "U", "Others"}
    assert topic_list(table, "AIRLINE").head().topics == "T, U, Others"


def test_scripts_by_majority(spark):
    cases = {
        "Все было очень хорошо 中国 спасибо": "ru", "الخدمة كانت جيدة جدا والموظفون لطفاء پ وشكرا لكم على كل شيء": "ar", "서비스가 정말 좋았어요 の 감사합니다": "ko",
        "خدمات خیلی خوب بود و کارکنان مهربان بودند": "fa", "سروس بہت اچھی تھی اور عملہ بہت اچھا تھا": "ur", "サービスはとても良かったです": "ja", "服务非常好，谢谢": "zh"}
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    assert {r.want: r.lang_code for r in detect_language(df, "t").collect()} == {c: c for c in cases.values()}


def test_label_index_equals_the_lists(spark):
    import random

    from voxtally.functions.text import words
    from voxtally.operators.mapping import _overlap_by_word

    draw = random.Random(4)
    names = ["".join(draw.choice("abcdefghij") for _ in range(4)) for _ in range(60)]
    weighted = lambda: names[int(60 * draw.random() ** 3)]  # noqa: E731  (some words stand in most labels)
    labels = {(t, k, " ".join(weighted() for _ in range(draw.randrange(1, 5)))) for t in "TU" for k in "pd" for _ in range(300)}
    rows = [(str(i), draw.choice(["T", "U", "V", None]), draw.choice("pd"), " ".join(weighted() for _ in range(draw.randrange(0, 7)))) for i in range(600)]
    rows += [("x", "T", "p", None), ("y", "T", "p", "unheard of"), ("z", "T", "p", "")]
    phrases = spark.createDataFrame(rows, "phrase_id string, topic string, type string, pp_mod string")
    table = spark.createDataFrame(sorted(labels), "topic string, type string, subtopic string")
    want = {r.phrase_id: r.subtopic for r in map_by_overlap(phrases, table).collect()}
    entries = table.withColumn("tokens", words(F.col("subtopic")))
    for common in (0, 5, 40, 10_000):
        got = _overlap_by_word(phrases, entries, common).collect()
        assert len(got) == len(rows) and {r.phrase_id: r.subtopic for r in got} == want, common


def test_many_labels_are_read_once(spark, tmp_path):
    n = 100_000
    spark.range(n).select(F.lit("T").alias("topic"), F.lit("p").alias("type"), F.concat(F.lit("desk w"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("subtopic")).write.parquet(f"{tmp_path}/labels")
    labels = spark.read.parquet(f"{tmp_path}/labels")
    phrases = spark.createDataFrame([("1", "T", "p", "the desk wbcd"), ("2", "T", "p", "desk"), ("3", "T", "p", "none")],
                                    "phrase_id string, topic string, type string, pp_mod string")
    got = map_by_overlap(phrases, labels, max_bytes=1000)
    assert {r.phrase_id: r.subtopic for r in got.collect()} == {"1": "desk wbcd", "2": "desk wa", "3": "Others"}
    assert f"{tmp_path}/labels" not in plan(got)  # only the written entries are read


def test_long_value_lists_come_in_chunks(spark):
    from voxtally.operators.rollup import string_agg_chunks

    df = spark.range(5000).select(F.when(F.col("id") % 10 > 2, "hot").when(F.col("id") % 10 > 0, "b").alias("g"), F.lit(1).alias("h"),
                                  (F.col("id") % 900).cast("string").alias("v")).union(spark.sql("SELECT 'n', 1, CAST(NULL AS string)"))
    got = string_agg_chunks(df, ["g", "h"], "v", "line", 100).collect()
    want = {}
    for r in df.where("v IS NOT NULL").distinct().collect():
        want.setdefault(r.g, []).append(r.v)
    assert {g for g, *_ in got} == {"hot", "b", None}
    for g, values in want.items():
        lines = [r.line for r in sorted((r for r in got if r.g == g), key=lambda r: r.chunk)]
        assert ", ".join(lines).split(", ") == sorted(values) and all(len(line.split(", ")) == 100 for line in lines[:-1])
