"""Exact duplicates by distributed radix partitioning, most significant bytes first."""

from __future__ import annotations

from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.llm.common import settle

#: Bytes of the first digit; the next digit starts behind it and is WIDEN times as wide as it, and so on.
HEAD = 64
WIDEN = 8
#: Heads of more than one document are broadcast up to this size.
MAX_BROADCAST_BYTES = 32 << 20
#: A head counts as hot when it has more than one of this many rows, so there are fewer hot heads than that.
HOT_SHARE = 1000

# A blank alone stands for itself; every other run of white space becomes one blank.
_SPACES = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normal_text(text: Column) -> Column:
    """The text with each run of white space as one blank; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACES, " ")


def _with_head_groups(rows: DataFrame, max_bytes: int) -> DataFrame:
    """Add `_group`, a number for each head that several rows have; null where a head is alone.

    The heads of several rows are broadcast while they are few. Beyond that the rows are shuffled by
    head, but for those of hot heads: these are looked up in a broadcast of fewer than HOT_SHARE heads
    and go anywhere.
    """
    counts = rows.groupBy("_head").agg(F.count("*").alias("_n"))
    several = settle(counts.where("_n > 1").withColumn("_group", F.monotonically_increasing_id()), "heads")
    total, size = several.agg(F.sum("_n"), F.sum(F.octet_length("_head") + F.lit(24))).first()
    if (size or 0) <= max_bytes:
        return rows.join(F.broadcast(several.select("_head", "_group")), "_head", "left")
    # The rows of heads that are alone are left out of `total`, so no more than HOT_SHARE heads pass.
    hot = several.where(F.col("_n") > F.lit(total / HOT_SHARE)).selectExpr("_head", "_group _hot")
    found = rows.join(F.broadcast(hot), "_head", "left")
    # Longer than any head: rows that have their group already meet nothing and spread over all tasks.
    aside = F.concat(F.lit(bytes(HEAD + 1)), F.monotonically_increasing_id().cast("string").cast("binary"))
    found = found.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("_head")).otherwise(aside))
    rest = several.where(F.col("_n") <= F.lit(total / HOT_SHARE)).selectExpr("_head _key", "_group _cold")
    return found.join(rest, "_key", "left").withColumn("_group", F.coalesce("_hot", "_cold")).drop("_key", "_hot", "_cold")


def _split(active: DataFrame, start: int, width: int, salts: int) -> DataFrame:
    """One level of the recursion: the rows of each group part by the `width` bytes from `start`.

    Counts and the row to keep are made per (group, digit, salt) first, joined with those of the whole
    (group, digit) and brought back to the rows by all three, so a group of any size is spread over
    `salts` keys. A digit shorter than `width` has reached the end of the text.
    """
    rows = (active.withColumn("_digit", F.expr(f"substring(_text, {start + 1}, {width})"))
                  .withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts))))
    part = rows.groupBy("_group", "_digit", "_salt").agg(
        F.count("*").alias("_n"), F.min(F.struct(F.col("_id").isNull().alias("late"), "_id", "_row")).alias("_first"))
    whole = part.groupBy("_group", "_digit").agg(F.sum("_n").alias("_size"), F.min("_first").alias("_keep")).where("_size > 1")
    found = part.drop("_n", "_first").join(whole, ["_group", "_digit"])
    split = rows.join(found, ["_group", "_digit", "_salt"], "left")
    done = F.col("_size").isNull() | (F.octet_length("_digit") < width)
    return split.select(
        "_row", "_id", "_sha", F.col("_keep._row").alias("_group"), F.col("_keep._id").alias("_keep_id"), "_size",
        done.alias("_done"), F.when(~done, F.col("_text")).alias("_text"))


def exact_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when all their bytes are, each run of white space taken as one blank. Documents
    are parted by the first HEAD bytes, and groups of several again by the following bytes, in digits
    that grow WIDEN-fold, until a group has one document or its texts have ended; the bytes
    themselves are compared and no digest. Documents alone in their group leave at once, so only
    texts that share all bytes so far are read on, and the number of levels is the logarithm of the
    longest shared stretch.

    Of equal texts the row with the smallest id stays. Null and empty texts are equal to each other.
    Rows without an id lose against those with one; of rows with the same id, or only such without,
    one stays. Every row is returned, repeated ones too. Other columns are not read. An empty table
    gives an empty result.

    A group with a third of all rows is counted map-side and spread over as many keys as the root of
    the number of rows still open; no group is gathered in a task.
    """
    normal = normal_text(F.col(f"`{text}`"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), normal.alias("_normal"))
    rows = rows.withColumn("_head", F.expr(f"substring(CAST(_normal AS binary), 1, {HEAD})"))
    grouped = _with_head_groups(rows.select("_head", "_id", "_normal"), max_bytes)
    opened = settle(grouped.select(
        F.monotonically_increasing_id().alias("_row"), "_id", F.sha2("_normal", 256).alias("_sha"), "_group",
        F.when(F.col("_group").isNotNull(), F.col("_normal").cast("binary")).alias("_text")), "rows")
    columns = [
        F.col("_id").alias(doc_id), F.coalesce("_keep_id", F.when(F.col("_size").isNull(), F.col("_id"))).alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("bigint").alias("group_size"),
        (F.col("_size").isNull() | (F.col("_row") == F.col("_group"))).alias("kept"), F.col("_sha").alias("text_sha256")]
    alone = opened.where("_group IS NULL").withColumns(
        {"_keep_id": F.lit(None).cast("bigint"), "_size": F.lit(None).cast("bigint")})
    results, active = [alone.select(columns)], opened.where("_group IS NOT NULL")
    start, width = HEAD, HEAD * WIDEN
    while left := active.count():
        split = settle(_split(active, start, width, 1 + isqrt(left)), "digits")
        results.append(split.where("_done").select(columns))
        active = split.where("NOT _done").select("_row", "_id", "_sha", "_group", "_text")
        start, width = start + width, width * WIDEN
    return reduce(DataFrame.unionAll, results)


def drop_exact_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with all their columns. The ids of `docs` must be unique and not null."""
    gone = exact_duplicates(docs, doc_id=doc_id, text=text).where("NOT kept").select(F.col(doc_id).alias("_gone"))
    return docs.join(gone, F.col(f"`{doc_id}`") == F.col("_gone"), "left_anti")
