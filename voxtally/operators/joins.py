"""Lookups and joins.

Joins on record or phrase ids carry no hint: Spark picks the strategy from measured sizes, and
adaptive execution splits hot partitions. Joins on a topic have few and hot keys; they go through
`join_bounded`, which measures the small side first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from voxtally.functions.choose import literal_map


MAX_BROADCAST_BYTES = 32 << 20
SALTS = 64


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as JSON text, a measure for what a broadcast of it holds."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return df.agg(size).collect()[0][0] or 0


def join_bounded(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join a large table to a lookup table on few, possibly hot keys.

    The lookup side is measured. Up to `max_bytes` it is broadcast. Beyond that it is repeated per
    salt and the rows of the large side go round the salts, so that a key that holds a third of the
    rows, or rows that are all equal, still fan out over many tasks. Both ways give the same rows; `how`
    must keep the left side whole or filter it (inner, left, left_semi, left_anti).
    """
    if measured_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), list(on), how)
    salted = left.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(
        repeated.withColumn("_salt", F.col("_salt").cast("bigint")), [*on, "_salt"], how
    ).drop("_salt")


def join_labels(phrases: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `subtopic` by `phrase_id`; a phrase without label keeps NULL. Repeated labels of an id
    do not multiply the phrase: the smallest one counts.
    """
    single = (labels.where(F.col("id").isNotNull())
              .groupBy(F.col("id").alias("phrase_id")).agg(F.min("subtopic").alias("subtopic")))
    return phrases.join(single, "phrase_id", "left")


def join_metadata(phrases: DataFrame, meta: DataFrame, key: str = "Review_No") -> DataFrame:
    """Left join on the record id as text. A later date filter on the metadata side makes Spark
    plan it as an inner join with the filter below it.
    """
    typed = meta.withColumn(key, F.col(key).cast("string"))
    return phrases.withColumn(key, F.col(key).cast("string")).join(typed, key, "left")


def lookup_inner(
    df: DataFrame, col: str, table: Mapping[str, str] | DataFrame, target: str,
) -> DataFrame:
    """Exact lookup into `target`, unmapped rows dropped.

    A dict becomes a literal map, no join. A table has the columns `col` and `target`.
    """
    if isinstance(table, DataFrame):
        return join_bounded(df, table.select(col, target).dropDuplicates([col]), [col])
    return df.withColumn(target, F.try_element_at(literal_map(table), F.col(f"`{col}`"))).where(
        F.col(target).isNotNull())


def unmapped(df: DataFrame, col: str, table: Mapping[str, str] | DataFrame) -> DataFrame:
    """Distinct values of `col` that the lookup table lacks, NULL included."""
    value = F.col(f"`{col}`")
    if isinstance(table, DataFrame):
        return df.select(value.alias(col)).distinct().join(table.select(col), col, "left_anti")
    return df.where(value.isNull() | ~value.isin(*table)).select(value.alias(col)).distinct()


def topic_candidates(phrases: DataFrame, labels: DataFrame) -> DataFrame:
    """Add `candidates`, the sorted labels of the phrase's topic and type; phrases whose topic has
    no labels drop out. Lists are made per topic and type, however many topics there are.
    """
    lists = labels.groupBy("topic", "type").agg(
        F.array_sort(F.collect_set("subtopic")).alias("candidates"))
    return join_bounded(phrases, lists, ["topic", "type"])


def new_only(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in `seen`; NULL counts as a key like any other."""
    known = seen.select(F.col(f"`{key}`").alias("_seen")).distinct()
    return df.join(known, F.col(f"`{key}`").eqNullSafe(F.col("_seen")), "left_anti")


def in_topics(df: DataFrame, topics: DataFrame) -> DataFrame:
    """Rows whose topic is in the table of valid topics."""
    return join_bounded(df, topics.select("topic"), ["topic"], "left_semi")
