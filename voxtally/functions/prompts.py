"""Text that goes to a model: rendered records, templates, numbered lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voxtally.functions.text import unwrapped


def render_record(*parts: tuple[str, Column], sep: str = "\n") -> Column:
    """One message per row, `name: value` joined by `sep`; a NULL value renders as empty text."""
    fields = [
        F.concat(F.lit(f"{name}: "), F.coalesce(col.cast("string"), F.lit("")))
        for name, col in parts
    ]
    return F.concat_ws(sep, *fields)


def inject(template: Column | str, **values: Column) -> Column:
    """Replace each `{name}` by its value; all other braces stay."""
    text = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return text


def numbered_prompt(df: DataFrame, batch: str, position: str, text: str) -> DataFrame:
    """`1. a`, `2. b`, … per batch. Group size is the batch size, so it is bounded."""
    lines = F.array_sort(F.collect_list(F.struct(F.col(position), F.col(text).alias("line"))))
    numbered = F.transform(
        lines, lambda row, i: F.concat((i + 1).cast("string"), F.lit(". "), one_line(row["line"])))
    return df.groupBy(batch).agg(F.array_join(numbered, "\n").alias("prompt"))


def one_line(text: Column) -> Column:
    """Line breaks inside a text would shift the numbering of the reply."""
    return unwrapped(F.coalesce(text, F.lit("")))
