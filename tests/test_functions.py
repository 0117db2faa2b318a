import datetime as dt

import pytest
from pyspark.sql import functions as F

from voxtally.constants import LANGUAGE_NAMES, SENTIMENTS
from voxtally.functions.choose import (
    coerce_to_set, first_non_empty, map_or_keep, replace_map, update_where,
)
from voxtally.functions.dates import parse_mixed, parse_utc, strict_day, utc_day
from voxtally.functions.labels import clean_label, label_format
from voxtally.functions.prompts import inject, numbered_prompt, render_record
from voxtally.functions.replies import flatten_reply, parse_numbered, parse_reply, strip_fence
from voxtally.functions.text import (
    concat_label, join_or_null, normalise, title_case, token_count, word_count, words,
)
from voxtally.schemas import REPLY_REVIEWS, REPLY_SUBTOPICS, reply_taxonomy


def column(spark, values, fn, kind="string"):
    """`fn` over a column of values, results in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [row.r for row in rows]


def test_parse_mixed(spark):
    cases = {
        "2025-11-03": dt.datetime(2025, 11, 3),
        "2025-11-03 14:05:06": dt.datetime(2025, 11, 3, 14, 5, 6),
        "03/11/2025": dt.datetime(2025, 11, 3),
        "3/11/2025 9:05": dt.datetime(2025, 11, 3, 9, 5),
        "13-12-2025": dt.datetime(2025, 12, 13),
        "12/25/2025": dt.datetime(2025, 12, 25),
        "13.12.2025": dt.datetime(2025, 12, 13),
        "03/11/25": dt.datetime(2025, 11, 3),
        "Nov 5, 2025": dt.datetime(2025, 11, 5),
        "november 5, 2025": dt.datetime(2025, 11, 5),
        "5 Nov 2025": dt.datetime(2025, 11, 5),
        " 2025/11/03 ": dt.datetime(2025, 11, 3),
        "31/02/2025": None, "13/13/2025": None, "garbage": None, "Abc 5, 2025": None, "": None,
    }
    got = column(spark, [*cases, None], parse_mixed)
    assert got == [*cases.values(), None]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Riyadh", "America/New_York"])
def test_parse_utc_in_any_session_zone(spark, zone):
    cases = {
        "2025-11-01T01:00:00+03:00": "2025-10-31", "2025-10-31T23:59:59Z": "2025-10-31",
        "2025-11-01": "2025-11-01", "2025-11-01 23:30:00": "2025-11-01",
        "11/01/2025 23:30": "2025-11-01", "garbage": None,
    }
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = column(spark, cases, lambda c: utc_day(parse_utc(c)).cast("string"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == list(cases.values())


def test_strict_day(spark):
    assert column(spark, ["2025-11-03", "3/11/2025", "2025-13-40", None], strict_day) == [
        dt.date(2025, 11, 3), None, None, None]


def test_text_follows_python(spark):
    samples = ["  Well-Maintained \t\n", "don't WAIT", "24h gate", "مطار الرياض", " x ", "",
               "a\tb  c\nd", None]
    present = [s for s in samples if s is not None]
    assert column(spark, samples, normalise) == [s.lower().strip() for s in present] + [None]
    assert column(spark, present[:4], title_case) == [s.title() for s in present[:4]]
    assert column(spark, present, word_count) == [
        len(s.replace(" ", "_").replace(" ", "_").split()) for s in present]
    assert column(spark, ["Hi, it's 5pm!"], token_count) == [8]
    assert column(spark, ["Hi, it's"], words) == [["hi", "it", "s"]]


def test_lists_and_labels(spark):
    assert column(spark, [["a", "b"], [], None], join_or_null, "array<string>") == ["a, b", None, None]
    assert column(spark, ["x", None], lambda c: concat_label(c, F.lit("root"), " - ")) == ["x - root", None]
    cases = {
        "modifier-Root": "Modifier Root", "quick-Check-in Process": "Quick Check-in Process",
        "Check-in Process": "Check in Process", "Poor Experience with-Boarding": "Boarding",
        "great experience with - Lounge": "Lounge", " plain ": "plain", "": "", "  ": "  ",
    }
    assert column(spark, [*cases, None], label_format) == [*cases.values(), None]


def test_clean_label(spark):
    cases = {
        "Damaged - Cargo": "Damaged Cargo", "Late - Boarding": "Late Boarding",
        "Great Experience with - Boarding": "Great Boarding Experience",
        "slow – Check-in": "Slow Check-In", "plain label": "Plain Label",
    }
    assert column(spark, [*cases, None], clean_label) == [*cases.values(), None]


def test_choices(spark):
    assert column(spark, ["A", "b", None], lambda c: coerce_to_set(c, ["A"], "Others")) == ["A", "Others", "Others"]
    assert column(spark, ["Baggage", "x", None], lambda c: replace_map(c, {"Baggage": "Bags"})) == ["Bags", "x", None]
    assert column(spark, ["EN ", "xx", None, "zh-Hant"], lambda c: map_or_keep(c, LANGUAGE_NAMES)) == [
        "English", "xx", None, "Chinese (Traditional)"]
    assert column(spark, ["a", "", None], lambda c: first_non_empty(c, F.lit("f"))) == ["a", "f", "f"]
    assert column(spark, ["a", "b"], lambda c: update_where(c, c == "a", F.lit("z"))) == ["z", "b"]


def test_strip_fence_and_numbered(spark):
    cases = {"```json\n{}\n```": "{}", "```\nx\n```": "x", " {} ": "{}", "a ``` b": "a ``` b"}
    assert column(spark, cases, strip_fence) == list(cases.values())
    reply = "1. one\n\n 2.  two \n3. 4. four\n4. more"
    assert column(spark, [reply], lambda c: parse_numbered(c, 3)) == [["one", "two", "4. four"]]


def test_parse_reply_reasons(spark):
    good = '{"reviews":[{"id":"1","sentiment":"neutral","topics":[{"topic":"T"}]}]}'
    rows = {
        "good": good, "fenced": f"```json\n{good}\n```",
        "empty list": '{"reviews":[]}',
        "truncated": good[:-5], "in string": good[:20], "malformed": '{"reviews":[}]}',
        "enum": good.replace("neutral", "angry"), "no id": good.replace('"id":"1",', ""),
        "no list": "{}", "null": None, "blank": " ",
    }
    df = spark.createDataFrame(list(rows.items()), "name string, reply string")
    ok, rejects = parse_reply(df, "reply", REPLY_REVIEWS, {"sentiment": SENTIMENTS})
    assert {r.name for r in ok.collect()} == {"good", "fenced", "empty list"}
    assert {r.name: r.reject_reason for r in rejects.collect()} == {
        "truncated": "truncated", "in string": "truncated", "malformed": "malformed",
        "enum": "invalid", "no id": "missing", "no list": "missing", "null": "missing",
        "blank": "missing"}
    flat = flatten_reply(ok, "reviews", "name").collect()
    assert {(r.name, r.id, r.topic, tuple(r.pain_points)) for r in flat} == {
        ("good", "1", "T", ()), ("fenced", "1", "T", ())}


def test_parse_reply_of_flat_records(spark):
    df = spark.createDataFrame(
        [('{"reviews":[{"id":"a","subtopic":"s"},{"id":"b"}]}',), ('{"reviews":[{"id":"a","subtopic":"s"}]}',)],
        "reply string")
    ok, rejects = parse_reply(df, "reply", REPLY_SUBTOPICS)
    assert ok.count() == 1 and [r.reject_reason for r in rejects.collect()] == ["missing"]


def test_prompts(spark):
    df = spark.createDataFrame([(1, 1, "a\nb"), (1, 2, "c"), (2, 3, None)], "batch int, pos int, text string")
    got = {r.batch: r.prompt for r in numbered_prompt(df, "batch", "pos", "text").collect()}
    assert got == {1: "1. a b\n2. c", 2: "1. "}
    row = df.where("pos = 2").select(
        render_record(("Id", F.col("pos")), ("Text", F.col("text"))).alias("m"),
        inject('{"k": {v}, "o": {other}}', v=F.col("text")).alias("p")).head()
    assert row.m == "Id: 2\nText: c" and row.p == '{"k": c, "o": {other}}'


def test_dates_of_real_exports(spark):
    day = dt.datetime(2025, 11, 5)
    cases = {
        "November 2025": dt.datetime(2025, 11, 1), "Nov 2025": dt.datetime(2025, 11, 1), "5-Nov-2025": day, "5 Nov 2025 3:15 PM": day.replace(hour=15, minute=15),
        "05/11/2025 03:15 PM": day.replace(hour=15, minute=15), "Wednesday, November 5, 2025": day, "5th November 2025": day,
        "05/11/25 10:00": day.replace(hour=10), "5/11/2025T10:00": day.replace(hour=10), "05/11/2025 10:00:00.5": day.replace(hour=10, microsecond=500_000),
        "20251105": day, "2025-11": dt.datetime(2025, 11, 1), "03/11/2025 10:00": dt.datetime(2025, 11, 3, 10), "11/25/2025": dt.datetime(2025, 11, 25),
        "05-11-2025": day, "5.11.2025": day, "Sept 5, 2025": dt.datetime(2025, 9, 5), "12:15": None, "soon": None, "": None}
    assert column(spark, list(cases), parse_mixed) == list(cases.values())


def test_utc_reads_month_first_and_offsets(spark):
    cases = {
        "03/11/2025 10:00": "2025-03-11 10:00:00", "25/11/2025 10:00": "2025-11-25 10:00:00", "Wed Nov 05 10:00:00 +0000 2025": "2025-11-05 10:00:00",
        "Wed Nov 05 10:00:00 +0300 2025": "2025-11-05 07:00:00", "11/05/2025 10:00:00 PM": "2025-11-05 22:00:00", "11/05/2025 10:00 -05:00": "2025-11-05 15:00:00",
        "05-11-2025": "2025-05-11 00:00:00", "2025-11-05T10:00:00+03:00": "2025-11-05 07:00:00", "Nov 5, 2025 10:00:00 UTC": "2025-11-05 10:00:00", "x": None}
    assert column(spark, list(cases), lambda c: F.date_format(parse_utc(c), "yyyy-MM-dd HH:mm:ss")) == list(cases.values())


def test_dates_in_mail_and_half_day_form(spark):
    noon = dt.datetime(2025, 11, 5, 12)
    cases = {
        "2025-11-05 03:15 PM": noon.replace(hour=15, minute=15), "2025-11-05 12:00 am": noon.replace(hour=0), "5-Nov-25": noon.replace(hour=0),
        "Wed, 05 Nov 2025 12:00:00 GMT": noon, "2025/11/05 12:00": noon, "Nov 5 2025 at 12:00 p.m.": noon, "2025-11-05 13:00 PM": None,
        "2025-11-05 0:30 am": None, "31/04/2025": None, "2025-13-01": None, "1/2/3": None, "november 5": None, "2025-11-05 x": None, "32/13/2025": None}
    assert column(spark, list(cases), parse_mixed) == list(cases.values())
    instants = {
        "2025/11/05 10:00": "10:00", "2025-11-05 10:00 +03:00": "07:00", "2025-11-05 03:15 PM": "15:15", "5-Nov-25": "00:00",
        "Wed, 05 Nov 2025 10:00:00 -0430": "14:30", "2025-11-05T10:00:00.1234567Z": "10:00", "5 Nov 2025 10:00 utc": "10:00"}
    got = column(spark, list(instants), lambda c: F.date_format(parse_utc(c), "yyyy-MM-dd HH:mm"))
    assert got == [f"2025-11-05 {clock}" for clock in instants.values()]


def test_numbered_lines_keep_their_place(spark):
    for reply, want in {
        "1. a\n3. c": ["a", None, "c"], "3. c\n1. a\n1. again\n9. x": ["a", None, "c"], "a\nb\n\nc": ["a", "b", "c"], "a\nb": [None, None, None],
        "1. a\n\n2. \n3. c": ["a", "", "c"], "99999999999. big\n2. b": [None, "b", None]}.items():
        assert column(spark, [reply], lambda c: parse_numbered(c, 3)) == [want], reply


def test_replies_lack_nested_fields(spark):
    rows = {
        "no topics": '{"reviews":[{"id":"1","sentiment":"neutral"}]}',
        "no topic": '{"reviews":[{"id":"1","sentiment":"neutral","topics":[{"pain_points":["x"]}]}]}',
        "good": '{"reviews":[{"id":"1","sentiment":"neutral","topics":[{"topic":"T"}]}]}'}
    ok, rejects = parse_reply(spark.createDataFrame(list(rows.items()), "name string, reply string"), "reply", REPLY_REVIEWS)
    assert [r.name for r in ok.collect()] == ["good"] and {r.reject_reason for r in rejects.collect()} == {"missing"}
    seeds = {"whole": '{"type":"A","service":"B","subtopics":[{"root_subtopic":"r","positive_mods":[],"negative_mods":["n"]}]}',
             "no type": '{"service":"B","subtopics":[]}'}
    ok, _ = parse_reply(spark.createDataFrame(list(seeds.items()), "name string, reply string"), "reply", reply_taxonomy())
    assert [r.name for r in ok.collect()] == ["whole"]
