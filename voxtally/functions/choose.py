"""Columns that pick between values."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, functions as F

from voxtally.functions.text import normalise


def literal_map(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def coerce_to_set(col: Column, allowed: Iterable[str], default: str) -> Column:
    """The value if it is allowed, else `default`; NULL counts as not allowed."""
    return F.when(col.isin(*allowed), col).otherwise(F.lit(default))


def replace_map(col: Column, values: Mapping[str, str]) -> Column:
    """Exact replacement; other values stay."""
    return F.coalesce(F.try_element_at(literal_map(values), col), col)


def map_or_keep(col: Column, values: Mapping[str, str]) -> Column:
    """Lookup after lower and strip; an unknown value stays as it is, NULL stays NULL."""
    return F.coalesce(F.try_element_at(literal_map(values), normalise(col)), col)


def first_non_empty(*cols: Column) -> Column:
    """First column that is neither NULL nor `''`; the last one is taken as it is."""
    return F.coalesce(*[F.nullif(col, F.lit("")) for col in cols[:-1]], cols[-1])


def update_where(old: Column, predicate: Column, new: Column) -> Column:
    return F.when(predicate, new).otherwise(old)
