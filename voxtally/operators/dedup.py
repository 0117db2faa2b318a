"""Duplicate removal.

A rank filter on `row_number() = 1` is planned with a group limit before the shuffle: each map task
passes on one row per key, so a key that holds a third of the table still shuffles few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def keep_first(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in `order`. End `order` with a unique column for a fixed choice."""
    keys = [key] if isinstance(key, str) else list(key)
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, key: str, date: str, tiebreak: Sequence[Column]) -> DataFrame:
    """One row per key, newest date first; a NULL date loses against any date."""
    return keep_first(df, key, [F.col(f"`{date}`").desc_nulls_last(), *tiebreak])


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def distinct_pairs(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.select(f"`{left}`", f"`{right}`").distinct()
