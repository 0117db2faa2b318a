"""Counts, ranges, vocabularies and step metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from voxtally.operators.keys import dense_id_within


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows per key, largest first; NULL keys do not count."""
    return (df.na.drop(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), *keys))


def label_distribution(df: DataFrame, *columns: str) -> DataFrame:
    """Value counts of several columns from one pass: the joint counts are small, the margins are
    taken from them.
    """
    joint = df.groupBy(*columns).agg(F.count("*").alias("n"))
    cells = F.explode(F.array(*[
        F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns]))
    return (joint.select(cells.alias("cell"), "n").select("cell.*", "n")
            .where(F.col("value").isNotNull())
            .groupBy("field", "value").agg(F.sum("n").alias("n")))


def date_range(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.min(col).alias("first"), F.max(col).alias("last"))


def null_count(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def distinct_count(df: DataFrame, col: str) -> DataFrame:
    """Rows and distinct values of `col`, both exact."""
    return df.agg(F.count("*").alias("rows"), F.count_distinct(col).alias("distinct_values"))


def lang_split_counts(df: DataFrame, code: str) -> DataFrame:
    """English rows against all others; a NULL code is not English."""
    return df.agg(
        F.count_if(F.col(code) == "en").alias("english"),
        F.count_if(F.coalesce(F.col(code) != "en", F.lit(True))).alias("non_english"))


def vocabulary(col: str, *frames: DataFrame) -> DataFrame:
    """Sorted distinct non-NULL values of `col` over all frames. Each frame is reduced to its own
    distinct values before they meet.
    """
    parts = [df.select(col).na.drop().distinct() for df in frames]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.distinct().orderBy(col)


def string_agg_list(
    df: DataFrame, group: Sequence[str], col: str, name: str, max_values: int | None,
) -> DataFrame:
    """Distinct values per group as one `, ` line, for vocabularies that go into a prompt.

    With `max_values` a group that has more is an error; it is found out before more than that are
    gathered. With None every line is made, however long.
    """
    if max_values is None:
        lines = df.select(*group, col).na.drop(subset=[col]).groupBy(*group)
        return lines.agg(F.array_join(F.array_sort(F.collect_set(col)), ", ").alias(name))
    order = Window.partitionBy(*group).orderBy(col)
    values = (df.select(*group, col).na.drop(subset=[col]).distinct()
              .withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= max_values + 1))
    lists = values.groupBy(*group).agg(F.array_sort(F.collect_list(col)).alias("_values"))
    line = F.when(
        F.size("_values") > max_values,
        F.raise_error(F.lit(f"more than {max_values} values of {col} in a group")).cast("string"),
    ).otherwise(F.array_join("_values", ", "))
    return lists.select(*group, line.alias(name))


def string_agg_chunks(
    df: DataFrame, group: Sequence[str], col: str, name: str, size: int, chunk: str = "chunk",
) -> DataFrame:
    """Distinct values per group as sorted `, ` lines of at most `size` values, numbered from 1.

    For vocabularies of any length: values are numbered by range partitions, also inside a group that has most
    of them, and a task gathers one line at a time. Rows of a group whose `col` is NULL are left out.
    """
    key = F.struct(*[F.col(f"`{g}`") for g in group]).alias("_group")
    values = df.select(key, F.col(f"`{col}`").alias("_value")).where("_value IS NOT NULL").distinct()
    numbered = dense_id_within(values, "_group", ["_value"], "_number")
    lines = numbered.groupBy("_group", (F.floor((F.col("_number") - 1) / size) + 1).alias(chunk)).agg(
        F.array_join(F.array_sort(F.collect_list("_value")), ", ").alias(name))
    return lines.select("_group.*", chunk, name)


def feedback_rollup(final: DataFrame, *keys: str) -> DataFrame:
    """Phrases and distinct records per combination of `keys`.

    Records are first reduced to one row per combination and record, both steps combine map-side.
    """
    per_record = final.groupBy(*keys, "Review_No").agg(F.count("*").alias("n"))
    return per_record.groupBy(*keys).agg(
        F.sum("n").alias("phrases"), F.count("Review_No").alias("records"))


class StepCounts:
    """Row counts after each step, collected while the job runs and not by jobs of their own."""

    def __init__(self) -> None:
        self._steps: list[tuple[str, Observation]] = []

    def step(self, df: DataFrame, name: str, *extra: Column) -> DataFrame:
        seen = Observation(f"step_{len(self._steps)}_{name}")
        self._steps.append((name, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *extra)

    def rows(self) -> list[tuple[int, str, int]]:
        """(position, step, rows); waits for the action that carried the steps."""
        return [(i, name, seen.get["rows"]) for i, (name, seen) in enumerate(self._steps, 1)]
