"""Date columns: lenient parsing of mixed formats, UTC instants, calendar days."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voxtally.functions.text import let, strip

# Slots of a written date, in the order in which the reader hands them on.
_SLOTS = ("year", "month", "day", "first", "second", "name", "hour", "minute", "seconds", "half", "offset")
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_MARK = "\u0001"
_YEAR = r"\d{4}|\d{2}(?!\d)"
_NAME = "(" + "|".join(_MONTHS.split()) + r")[a-z]*\.?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_GAP = r"[\s,./-]+"


def _reader() -> tuple[str, str]:
    """Pattern of all known ways to write a date, and the replacement that puts its groups into slots."""
    shapes = (
        (r"(\d{4})[-/.](\d{1,2})(?:[-/.](\d{1,2}))?", ("year", "month", "day")),
        (r"(\d{4})(\d{2})(\d{2})", ("year", "month", "day")),
        (rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.]({_YEAR})", ("first", "second", "year")),
        (rf"{_DAY}{_GAP}{_NAME}{_GAP}({_YEAR})", ("day", "name", "year")),
        (rf"{_NAME}\s+{_DAY},?\s+({_YEAR})", ("name", "day", "year")),
        (rf"{_NAME}[\s,-]+(\d{{4}})", ("name", "year")),
        (rf"{_NAME}\s+{_DAY}(?=\s+\d{{1,2}}:.*\d{{4}}$)", ("name", "day")),
    )
    clock = (r"(?:(?:t|,?\s+(?:at\s+)?)(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d{1,6})?)\d*)?(?:\s*([ap])\.?m\.?)?"
             r"\s*(z|utc|gmt|[+-]\d{2}:?\d{2})?)?", ("hour", "minute", "seconds", "half", "offset"))
    late = (r"(?:\s+(\d{4}))?", ("year",))
    groups: dict[str, list[int]] = {slot: [] for slot in _SLOTS}
    number = 0
    for _, slots in (*shapes, clock, late):
        for slot in slots:
            number += 1
            groups[slot].append(number)
    pattern = (r"(?i)^(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?(?:" + "|".join(shape for shape, _ in shapes)
               + r")(?!\d)" + clock[0] + late[0] + "$")
    return pattern, _MARK.join("".join(f"${n}" for n in groups[slot]) for slot in _SLOTS)


def _read(text: Column, day_first: bool, zoned: bool) -> Column:
    """Date and time in ISO form, with offset when `zoned`; text of no known form stays what it is not: a date.

    The text is matched once. Java leaves the groups of the ways that were not taken empty, so the
    replacement has each slot filled by one of them.
    """
    pattern, slots = _PATTERN

    def assemble(part: Column) -> Column:
        slot = {name: part[i] for i, name in enumerate(_SLOTS)}
        number = {name: slot[name].try_cast("int") for name in ("first", "second", "hour")}
        one, two = (number["first"], number["second"]) if day_first else (number["second"], number["first"])
        # The usual order unless its month or its day is impossible.
        usual = (two <= 12) & (one <= 31)
        day = F.when(slot["first"] == "", F.when(slot["day"] == "", "1").otherwise(slot["day"])).when(
            usual, one.cast("string")).otherwise(two.cast("string"))
        named = F.ceil(F.instr(F.lit(_MONTHS), F.lower(slot["name"])) / 4)
        month = F.when(slot["first"] != "", F.when(usual, two).otherwise(one).cast("string")).when(
            slot["name"] != "", named.cast("string")).otherwise(slot["month"])
        year = F.when(F.length(slot["year"]) == 2, F.concat(F.lit("20"), slot["year"])).otherwise(slot["year"])
        half_hour = F.when(number["hour"].between(1, 12), number["hour"] % 12 + F.when(F.lower(slot["half"]) == "p", 12).otherwise(0))
        hour = F.when(slot["half"] != "", half_hour.cast("string")).otherwise(slot["hour"])
        seconds = F.when(slot["seconds"] == "", "00").otherwise(slot["seconds"])
        time = F.when(slot["hour"] == "", " 00:00:00").otherwise(
            F.concat(F.lit(" "), hour, F.lit(":"), slot["minute"], F.lit(":"), seconds))
        offset = F.when(slot["offset"].rlike("^[+-]"), slot["offset"]).otherwise("Z") if zoned else F.lit("")
        return F.when(F.size(part) == len(_SLOTS), F.concat(year, F.lit("-"), month, F.lit("-"), day, time, offset))

    return let(F.split(F.regexp_replace(strip(text), pattern, slots), _MARK), assemble)


_PATTERN = _reader()


def parse_mixed(text: Column) -> Column:
    """Timestamp without zone from text in any of the known formats; anything else is NULL.

    Year-first text is read as ISO, other numeric text day first, and month first where day first
    is impossible. A month without a day is its first, two digits are a year after 2000. An offset is left out.
    """
    return _read(text, True, False).try_cast("timestamp_ntz")


def parse_utc(text: Column) -> Column:
    """Instant from text; an offset in the text is honoured, without one the text is UTC.

    Numeric dates are read month first, and day first where month first is impossible.
    """
    return _read(text, False, True).try_cast("timestamp")


def day_text(col: Column) -> Column:
    """`YYYY-MM-DD` text of a date or timestamp."""
    return F.date_format(col, "yyyy-MM-dd")


def strict_day(text: Column) -> Column:
    """Date from `YYYY-MM-DD` text, NULL for every other text."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def utc_day(instant: Column) -> Column:
    """Calendar day of an instant in UTC, whatever the session time zone is."""
    return F.to_date(F.to_utc_timestamp(instant, F.current_timezone()))
