"""Model replies: fences, numbered lines, typed JSON, flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from voxtally.constants import FENCE
from voxtally.functions.staging import computed
from voxtally.functions.text import let, strip, unwrapped


# A line that starts with `7.` or `7)`, but not with a decimal such as `7.5`.
_NUMBER = r"^\s*(\d{1,9})[.)](?!\d)\s*"
_BEFORE_NUMBER = r"(?m)^(?=[^\S\r\n]*\d{1,9}[.)](?!\d))"


def strip_fence(reply: Column) -> Column:
    """Trim, then drop the code fence around the text."""
    text = strip(reply)
    bare = strip(F.regexp_replace(text, FENCE, ""))
    return F.when(text.startswith("```"), bare).otherwise(text)


def numbered_texts(reply: Column) -> Column:
    """The numbered texts of a reply in their order, as array<struct<number, place, text>>.

    The reply is cut before each line that starts with a number, so a text that wraps keeps its further
    lines, joined by a blank. What stands before the first number is left out.
    """
    parts = F.split(reply, _BEFORE_NUMBER)
    # Without the number, which is cut off by its length, and the white space around it.
    bare = lambda part: strip(F.substr(part, F.length(F.regexp_extract(part, _NUMBER, 0)) + 1))
    flat = lambda part: let(bare(part), unwrapped)
    read = F.transform(parts, lambda part, i: F.struct(
        F.regexp_extract(part, _NUMBER, 1).try_cast("int").alias("number"), i.alias("place"), flat(part).alias("text")))
    return F.filter(read, lambda part: part["number"].isNotNull())


def parse_numbered(reply: Column, count: Column | int) -> Column:
    """A list of `count` texts; the n-th is that behind the number `n.` or `n)`, NULL where there is none.

    The first text of a number counts, numbers that were not asked are ignored, wrapped lines belong to
    the number above them. A reply without any number is taken line by line, blank ones left out, when it
    has exactly `count` of them. The reply is read once, whatever the count.
    """
    limit = (F.lit(count) if isinstance(count, int) else count).cast("int")
    wanted = F.when(limit > 0, F.sequence(F.lit(1), limit)).otherwise(F.array().cast("array<int>"))

    def placed(texts: Column) -> Column:
        # An empty place for each wanted number sorts behind its texts; the first entry of a number stays.
        empty = F.transform(wanted, lambda n: F.struct(
            n.alias("number"), F.lit(2**31 - 1).alias("place"), F.lit(None).cast("string").alias("text")))
        asked = F.filter(texts, lambda t: (t["number"] >= 1) & (t["number"] <= limit))
        return let(F.sort_array(F.concat(asked, empty)), lambda row: F.transform(
            F.filter(row, lambda t, i: (i == 0) | (F.get(row, i - 1)["number"] != t["number"])), lambda t: t["text"]))

    lines = F.filter(F.transform(F.split(reply, r"\r\n|\n|\r"), strip), lambda line: line != "")
    return let(numbered_texts(reply), lambda texts: F.when(F.size(texts) > 0, placed(texts)).otherwise(
        let(lines, lambda plain: F.when(F.size(plain) == limit, plain).otherwise(placed(texts)))))


def parse_reply(
    df: DataFrame, reply: str, schema: StructType, enums: dict[str, tuple[str, ...]] | None = None,
    optional: tuple[str, ...] = ("pain_points", "moments_of_delight"),
) -> tuple[DataFrame, DataFrame]:
    """Typed replies and rejects, the rows of `judge_reply` with and without a reason."""
    judged = judge_reply(df, reply, schema, enums, optional)
    good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    rejects = judged.where(F.col("reject_reason").isNotNull()).select(*df.columns, "reject_reason")
    return good, rejects


def judge_reply(
    df: DataFrame, reply: str, schema: StructType, enums: dict[str, tuple[str, ...]] | None = None,
    optional: tuple[str, ...] = ("pain_points", "moments_of_delight"),
) -> DataFrame:
    """Add the columns of `schema`, read from the reply, and `reject_reason`, NULL for a good reply.

    `schema` holds lists of records and plain fields. Every string and list is required, at any
    depth, but for those in `optional`; `enums` restricts some strings of a record. The reasons are truncated, malformed,
    missing or invalid.
    """
    enums = enums or {}
    corrupt = "_corrupt"
    typed = StructType([*schema.fields, StructField(corrupt, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    bare = computed(df, _text=strip_fence(F.col(reply)))
    parsed = computed(bare, _reply=F.from_json("_text", typed, options))

    lists = [f for f in schema.fields if isinstance(f.dataType, ArrayType)]
    missing = _lacks(F.col("_reply"), schema, optional)
    invalid = F.lit(False)
    for field in lists:
        rows = F.col(f"_reply.{field.name}")
        record = field.dataType.elementType
        required = [f.name for f in record.fields if isinstance(f.dataType, StringType)] if isinstance(
            record, StructType) else []
        for name, allowed in enums.items():
            if name in required:
                invalid = invalid | F.exists(rows, _outside(name, allowed))
    reason = (
        F.when(F.col(reply).isNull() | (F.col("_text") == ""), "missing")
        .when(F.col(f"_reply.{corrupt}").isNotNull() & _cut_off(F.col("_text")), "truncated")
        .when(F.col(f"_reply.{corrupt}").isNotNull() | F.col("_reply").isNull(), "malformed")
        .when(F.coalesce(missing, F.lit(True)), "missing")
        .when(F.coalesce(invalid, F.lit(True)), "invalid")
    )
    return computed(parsed, reject_reason=reason).select(
        *df.columns, *[F.col(f"_reply.{f.name}").alias(f.name) for f in schema.fields], "reject_reason")


def by_record(judged: DataFrame, given: Column, *keep: str) -> DataFrame:
    """A row per record of a batch that was asked: id, given, reason, error, attempts and the columns `keep`.

    `given` are the answers of a reply, structs with an `id`, of which the first with the id of a record counts; others are
    ignored. `reason` is NULL for an answer, else `call`, the `reject_reason` of the reply or `unanswered`. All is
    decided inside the row of the batch, without a join.
    """
    good = F.col("ok") & F.col("reject_reason").isNull()
    listed = computed(judged, _given=F.when(good, given))
    named = computed(listed, _ids=F.transform("_given", lambda g: g["id"]))
    rows = F.transform(F.array_distinct("record_ids"), lambda i: F.struct(
        i.alias("id"), F.get("_given", F.array_position("_ids", i) - 1).alias("given")))
    reason = F.when(~F.col("ok"), "call").when(F.col("given").isNull(), F.coalesce("reject_reason", F.lit("unanswered")))
    return named.select(*keep, "ok", "reject_reason", "error", "attempts", F.inline(rows)).select(
        *keep, "id", "given", reason.alias("reason"), "error", "attempts")


def _cut_off(text: Column) -> Column:
    """JSON text that ends inside a string or before its brackets are closed."""
    bare = F.regexp_replace(text, r'"[^"\\]*+(?:\\.[^"\\]*+)*+"', "")
    opened = F.length(F.regexp_replace(bare, r"[^\[{]", ""))
    closed = F.length(F.regexp_replace(bare, r"[^\]}]", ""))
    return bare.contains('"') | (opened > closed)


def _lacks(value: Column, kind: DataType, optional: tuple[str, ...]) -> Column:
    """Whether the value, or anything required inside it, is NULL."""
    found = value.isNull()
    if isinstance(kind, ArrayType) and isinstance(kind.elementType, (StructType, ArrayType)):
        return found | F.exists(value, lambda item: _lacks(item, kind.elementType, optional))
    if isinstance(kind, StructType):
        for field in kind.fields:
            if field.name not in optional:
                found = found | _lacks(value[field.name], field.dataType, optional)
    return found


def _outside(name: str, allowed: tuple[str, ...]):
    return lambda row: ~row[name].isin(*allowed)


def flatten_reply(df: DataFrame, records: str, *keep: str) -> DataFrame:
    """Records × topics as flat rows; a record without topics keeps one row with NULL topic."""
    return (
        df.select(*keep, F.posexplode(records).alias("record_pos", "record"))
        .select(*keep, "record_pos", "record.id", "record.sentiment",
                F.posexplode_outer("record.topics").alias("topic_pos", "detail"))
        .select(*keep, "record_pos", "topic_pos", "id", "sentiment", "detail.topic",
                F.coalesce("detail.pain_points", F.array().cast("array<string>"))
                .alias("pain_points"),
                F.coalesce("detail.moments_of_delight", F.array().cast("array<string>"))
                .alias("moments_of_delight"))
    )
