"""Subtopic label clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxtally.constants import GENERIC_MODIFIERS
from voxtally.functions.text import strip, title_case


def label_format(label: Column) -> Column:
    """`modifier-Root` -> `Modifier Root`, cut at the first hyphen.

    A generic modifier is dropped, a label without hyphen is only stripped, NULL and blank stay.
    """
    text = strip(label)
    cut = F.instr(text, "-")
    left = strip(F.substring(text, F.lit(1), cut - 1))
    right = strip(F.substring(text, cut + 1, F.length(text)))
    return (
        F.when(text == "", label)
        .when(cut == 0, text)
        .when(F.lower(left).isin(*GENERIC_MODIFIERS), right)
        .otherwise(F.concat(title_case(left), F.lit(" "), right))
    )


def clean_label(label: Column) -> Column:
    """`Damaged - Cargo` -> `Damaged Cargo`, `Great Experience with - Boarding` -> `Great Boarding
    Experience`: the rule form of the label clean-up. A spaced dash is the separator where there
    is one, so that `Slow - Check-in` keeps its compound.
    """
    text = strip(label)
    spaced = r"^(.*?)\s+[-–]\s+(.*)$"
    tight = r"^([^-–]*)[-–](.*)$"

    def part(group: int) -> Column:
        return title_case(strip(F.when(text.rlike(spaced), F.regexp_extract(text, spaced, group))
                                .otherwise(F.regexp_extract(text, tight, group))))

    left, right = part(1), part(2)
    mood = F.regexp_extract(left, "^(Great|Poor) Experience With$", 1)
    return (
        F.when(text.isNull(), F.lit(None).cast("string"))
        .when(~text.rlike("[-–]"), title_case(text))
        .when(left == "", right)
        .when(mood != "", F.concat_ws(" ", mood, right, F.lit("Experience")))
        .otherwise(F.concat_ws(" ", left, right))
    )
