"""Row filters and projections."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def project(df: DataFrame, mapping: Mapping[str, str], columns: Sequence[str]) -> DataFrame:
    """Rename by `mapping` (source name to new name), then keep `columns` in that order."""
    return df.withColumnsRenamed(dict(mapping)).select(*[f"`{c}`" for c in columns])


def since(df: DataFrame, col: str, day: str) -> DataFrame:
    """Rows on or after `day`; NULL dates drop. The column stays bare, so Parquet can skip on it."""
    kind = dict(df.dtypes)[col]
    return df.where(F.col(f"`{col}`") >= F.lit(day).cast(kind))


def where_ci(df: DataFrame, col: str, value: str) -> DataFrame:
    return df.where(F.lower(f"`{col}`") == value.lower())


def where_in(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """Case-sensitive membership."""
    return df.where(F.col(f"`{col}`").isin(*values))


def long_enough(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """Non-NULL text of more than `n` characters."""
    return df.where(F.col(col).isNotNull() & (F.length(col) > n))


def drop_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(columns) if columns else None)
