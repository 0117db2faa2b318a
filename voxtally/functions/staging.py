"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.session import shared_path


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add dear columns so that later filters and columns read them instead of repeating them.

    Spark copies a projected expression into every filter and, up to a point, every column that
    refers to it. A generated row is where that stops.
    """
    row = F.struct(*[col.alias(name) for name, col in columns.items()])
    return df.select("*", F.inline(F.array(row)))


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table once to the shared folder and read it from there, so that several readers share the work."""
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
